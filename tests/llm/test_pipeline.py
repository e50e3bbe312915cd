import random

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def write(spark, folder, docs, labels):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in docs]
    spark.createDataFrame(rows, kinds).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stage_decisions_take_effect(spark, tmp_dir):
    random.seed(7)
    vocab = [f"plain{i}" for i in range(800)]
    docs, labels = [], []
    for i in range(400):
        words = random.choices(vocab, k=random.randint(40, 90))
        if i % 4 == 0:
            words[3:3] = ["grubby", "vile"]
        docs.append((i, " ".join(words), "big" if i % 5 else "small"))
        labels.append((i, 1, int(i % 4 == 0)))
    docs += [(1001, docs[1][1], "big"), (1002, docs[2][1].upper(), "small"), (1003, "unlabelled but vile and grubby", "big")]
    docs += [(1004, "text with token=abcdef0123456789 inside it", "big"), (None, "row without an id", None), (1005, None, "big"), (1006, "", "big")]
    write(spark, tmp_dir, docs, labels)
    out = corpus_pipeline.run(spark, tmp_dir).collect()
    ids = {r.doc_id for r in out}
    clean = {i for i, _, _ in docs if i is not None and i < 400 and i % 4}
    assert clean <= ids and not ids & {i for i in range(0, 400, 4)} and not ids & {1001, 1002, 1003}
    assert None in ids and 1004 in ids and {1005, 1006} & ids == {1005}  # both empty: one class
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: library.decode(r.ids, skip_special_tokens=False) for r in out}
    assert text[1] == docs[1][1] and text[1004] == "text with [SECRET] inside it" and text[1005] == ""
    small = [r for r in out if r.doc_id in clean and r.doc_id % 5 == 0]
    assert len(small) > len({r.doc_id for r in small})  # the small source repeats


def test_columns_and_empty_tables(spark, tmp_dir):
    write(spark, tmp_dir, [], [])
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tmp_dir).columns == docs.columns
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_names_and_given_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "bpe"]
    assert corpus_pipeline.run(spark, SF).count() > 150


def test_near_copies_are_judged_by_row(spark, tmp_dir):
    """Repeated ids with different texts, and copies without an id."""
    random.seed(11)
    x, y, z, w = (" ".join(f"{c}{random.randint(0, 999)}" for _ in range(60)) for c in "xyzw")
    docs = [(3, x, "a"), (7, x, "a"), (7, y, "a"), (8, z, "a"), (8, w, "a"), (8, w, "a"), (None, z, "a")]
    docs += [(None, "copied without an id " * 9, "a")] * 5
    write(spark, tmp_dir, docs, [])
    given = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    out = corpus_pipeline.drop_near_copies(spark, given, tmp_dir)
    assert out.columns == given.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(3, x), (7, y), (8, z), (8, w), (None, "copied without an id " * 9)], key=str)


def test_clashing_columns_long_texts_and_repeated_rows(spark, tmp_dir):
    """Columns with the names that the stages use inside stay as they are; whole long texts pass through."""
    random.seed(13)
    long = " ".join(random.choices([f"word{i}" for i in range(500)], k=120_000)) + " token=abcdef0123456789"
    rows = [(1, long, "en", "a", len(long)), (2, "short text of its own", "en", "a", 21), (2, "short text of its own", "en", "a", 21), (3, None, None, None, None)]
    names = ["score", "key", "source_tokens", "llm_row", "component_id", "position"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for n, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(f"mine{n}"))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns, name
        assert all(r[c] == f"mine{n}" for r in out.collect() for n, c in enumerate(names))
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
    got = {r.doc_id: r.text for r in docs.collect()}
    assert got == {1: long.replace("token=abcdef0123456789", "[SECRET]"), 2: "short text of its own", 3: None}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, tmp_dir).collect()) == sorted(r.doc_id for r in docs.collect())
