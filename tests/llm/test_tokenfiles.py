import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rill.llm import tokenfiles
from tests_llm_rows import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_word_by_word_as_the_library(text):
    packed = tokenfiles.encoder(PATH).packed([text])[0]
    assert np.frombuffer(packed, "<u2").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 20_000])
def test_perfect_hash(n):
    random.seed(n)
    keys = np.array(sorted({random.getrandbits(63) - 2**62 for _ in range(n)}), dtype=np.int64)
    table = tokenfiles.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(n))  # 63 random bits do not meet here
    assert sum(table.sizes) <= max(64 * len(table.sizes), 5 * n)


def test_files_and_digests(spark, make_docs, tmp_dir):
    random.seed(0)
    rows = ODD + [(i, " ".join(random.choices(["Alpha", "beta", "don't", "3.14", "été"], k=random.randint(0, 90)))) for i in range(-50, 400, 3)]
    manifest = tokenfiles.write(make_docs(rows), tmp_dir, PATH)
    got = sorted(tokenfiles.read(manifest, tmp_dir, tokenfiles.crc32).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    start, keys = 0, []
    left = {}
    for i, t in rows:
        left.setdefault(i, []).append(ids_of(t))
    for r in got:
        assert r.start == start
        start += r.n_tokens
        match = [x for x in left[r.doc_id] if len(x) == r.n_tokens and zlib.crc32(np.array(x, "<u4").tobytes()) == r.value]
        left[r.doc_id].remove(match[0])
        keys.append(r.doc_id)
    real = [k for k in keys if k is not None]
    assert keys[0] is None and real == sorted(real)
    payload = sum(os.path.getsize(f"{tmp_dir}/{f}") for f in os.listdir(tmp_dir) if f.endswith(".ids"))
    assert payload == 2 * start and not [f for f in os.listdir(tmp_dir) if ".tmp" in f]


def test_keyed_lookup(spark, make_docs, tmp_dir):
    rows = [(i * 7, f"text number {i}") for i in range(300)] + [(70, "another of the same key"), (None, "keyless")]
    manifest = tokenfiles.write(make_docs(rows), tmp_dir, PATH)
    asked = [0, 7, 70, 71, -5, 2093, 5000, None]
    got = tokenfiles.lookup(spark.createDataFrame([(k,) for k in asked], "doc_id long"), manifest, tmp_dir).collect()
    want = sorted((i, ids_of(t)) for i, t in rows if i in (0, 7, 70, 2093))
    assert sorted((r.doc_id, r.ids) for r in got) == want


def test_a_second_writing_replaces_whole_files(spark, make_docs, tmp_dir):
    docs = make_docs([(i, "some text " * i) for i in range(50)])
    first = tokenfiles.read(tokenfiles.write(docs, tmp_dir, PATH), tmp_dir, tokenfiles.crc32).collect()
    again = tokenfiles.read(tokenfiles.write(docs, tmp_dir, PATH), tmp_dir, tokenfiles.crc32).collect()
    assert sorted(first) == sorted(again)


def test_empty_table(make_docs, tmp_dir):
    manifest = tokenfiles.write(make_docs([]), tmp_dir, PATH)
    assert tokenfiles.read(manifest, tmp_dir, tokenfiles.crc32).collect() == []


def test_many_rows_of_one_key_are_dealt_to_several_shards(spark, make_docs, tmp_dir):
    """A third without an id, a third of one id, texts partly equal: no shard holds many, keyed access finds all."""
    rows = [(None, f"no id {i % 50}") for i in range(400)] + [(7, f"hot {i % 9}") for i in range(400)] + [(i, f"other {i}") for i in range(100, 500)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        manifest = tokenfiles.write(make_docs(rows), tmp_dir, PATH)
        sizes = [r.n_docs for r in manifest.collect()]
        assert sum(sizes) == len(rows) and len(sizes) >= 10 and max(sizes) <= 200
        got = tokenfiles.read(manifest, tmp_dir, tokenfiles.crc32).orderBy("start").collect()
        ids = [r.doc_id for r in got]
        assert ids[:400] == [None] * 400 and ids[400:] == sorted(ids[400:]) and len(ids) == len(rows)
        found = tokenfiles.lookup(spark.createDataFrame([(7,), (100,)], "doc_id long"), manifest, tmp_dir).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.ids for r in found if r.doc_id == 7) == sorted(ids_of(f"hot {i % 9}") for i in range(400))
    assert sum(r.doc_id == 100 for r in found) == 1
