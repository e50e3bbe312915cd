import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rill.llm import subwords
from rill.llm.queries import op13_subwords
from tests_llm_rows import ODD

SF = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1


def slow_rows(text):
    """Table rows of all features, one feature at a time in Python integers."""
    def row(h, kind):
        h = (h + kind) * subwords.FINISH & MASK
        h ^= h >> 32
        return (h * subwords.FINISH & MASK) >> 40 & (subwords.BUCKETS - 1)

    code = lambda s: sum(ord(c) * pow(subwords.BASE, j, 1 << 64) for j, c in enumerate(s)) & MASK
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    out = [row(code(w), 1) for w in words]
    out += [row(0 if a == b else (code(a) * subwords.FINISH + code(b)) & MASK, 2) for a, b in zip(words, words[1:])]
    line = " " + re.sub(r"[\x09-\x0D]", " ", text or "") + " "
    for n in subwords.GRAMS:
        out += [row(code(line[i:i + n]), n) for i in range(len(line) - n + 1) if " " not in line[i + 1:i + n - 1]]
    return Counter(out)


def odd_texts():
    random.seed(8)
    bits = ["a", "the", "日本語", "🤣", " ", "  ", "\n", "\t", "\x0b", "é", "the the", "\x85", "x" * 30, "."]
    return [t for _, t in ODD if not t or len(t) < 1000] + ["".join(random.choices(bits, k=random.randint(0, 60))) for _ in range(200)]


def fast_rows(text):
    parts = list(subwords.features(text))
    return Counter(np.concatenate(parts).tolist()) if parts else Counter()


def test_features_match_one_at_a_time():
    for t in odd_texts():
        want = slow_rows(t) if (t or "").strip(" \t\n\x0b\x0c\r") else Counter()
        assert fast_rows(t) == want, t
        rows, counts = subwords.bag(t)
        assert dict(zip(rows.tolist(), counts.tolist())) == want


def test_pieces_do_not_change_features(monkeypatch):
    texts = [t for t in odd_texts() if t and max(map(len, t.split() or [""])) < 40]
    want = list(map(fast_rows, texts))
    long = "some words, and some words again\n" * 20_000
    whole = fast_rows(long)
    monkeypatch.setattr(subwords, "PIECE", 100)
    same = 0
    for t, w in zip(texts, want):
        if " " in t and max(map(len, re.split(r"[\x20\x09-\x0D]", t))) < 98:
            assert fast_rows(t) == w
            same += 1
    assert same > 50 and fast_rows(long) == whole
    rows, counts = subwords.bag(long)
    assert dict(zip(rows.tolist(), counts.tolist())) == whole
    assert fast_rows("x" * 1000)  # a run without white space: words of the length of a piece


def test_steps_follow_the_gradient():
    """One step of one document against numeric derivatives of its loss."""
    rng = np.random.default_rng(1)
    bags = [(np.array([3, 9, 700]), np.array([2, 1, 1]))]
    model = subwords.empty()
    model.vectors[:] = rng.normal(size=model.vectors.shape)
    weights = rng.normal(size=(2, subwords.WIDTH)).astype(np.float32)
    share = bags[0][1] / bags[0][1].sum()

    def loss(vectors):
        z = weights @ (vectors * share[:, None]).sum(0)
        return -z[1] + np.log(np.exp(z).sum())

    part = model.vectors[bags[0][0]].astype(np.float64)
    z = weights @ (part * share[:, None]).sum(0)
    p = np.exp(z) / np.exp(z).sum()
    p[1] -= 1
    formula = share[:, None] * (p @ weights)
    numeric = np.zeros_like(part)
    for i in np.ndindex(part.shape):
        up, down = part.copy(), part.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        numeric[i] = (loss(up) - loss(down)) / 2e-6
    assert np.abs(numeric - formula).max() < 1e-6


def made(n=240, seed=2):
    random.seed(seed)
    words = [f"w{k}rd{k % 7}" for k in range(80)]
    rows, labels = [], []
    for i in range(n):
        text = random.choices(words, k=random.randint(8, 30))
        good = i % 4 > 0
        rows.append((i, " ".join(text if good else [w + "$$" for w in text])))
        labels.append((i, int(good), 0))
    return rows, labels


def test_learns_and_scores_the_averaged_vectors(spark, make_docs):
    rows, labels = made()
    docs = make_docs(rows)
    model = subwords.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), use=F.col("doc_id") < 150)
    got = {r.doc_id: r.score for r in subwords.scores(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(q) for i, q, _ in labels)
    for i, t in rows[:20]:  # the long way: average the vectors, then the softmax
        bag, n = subwords.bag(t)
        mean = (model.vectors[bag].astype(np.float64) * (n / n.sum())[:, None]).sum(0)
        z = model.weights.astype(np.float64) @ mean + model.offsets
        assert abs(np.exp(z[1]) / np.exp(z).sum() - got[i]) < 1e-5


def test_sample_is_bounded(spark, make_docs):
    rows, labels = made(60)
    flags = spark.createDataFrame(labels + [(7, 0, 0), (7, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [(5, f"copy {i} of a shared id") for i in range(300)] + [(None, "no id")] * 50)
    one = subwords.sample(docs, flags, F.lit(True), 1000, 10**9).collect()
    assert len(one) == 60 and len({r.doc_id for r in one}) == 60
    few = subwords.sample(docs, flags, F.lit(True), 1000, 800).collect()
    assert 0 < sum(len(r.text) for r in few) <= 800
    assert len(subwords.sample(docs, flags, F.lit(True), 5, 10**9).collect()) < 40


def test_odd_rows(spark, make_docs):
    none = spark.createDataFrame([(1, None, 0), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (make_docs(ODD), make_docs([])):
        model = subwords.fit(docs, none)
        got = subwords.scores(docs, model).collect()
        assert len(got) == docs.count() and all(r.score == 0.5 for r in got)
    rows, labels = made(60)
    model = subwords.fit(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = subwords.scores(make_docs(ODD), model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1 and len({r.score for r in got if r.doc_id in (5, 6)}) == 1


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in op13_subwords(spark, SF).collect()}


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()
    held = [(scored[r.doc_id], r.quality) for r in labels if scored[r.doc_id].held_out]
    assert len(held) > 80 and sum(s.predicted == q for s, q in held) / len(held) > 0.97
    for s in scored.values():
        assert s.held_out == (zlib.crc32(str(s.doc_id).encode()) % 3 == 1)
        assert s.predicted == int(s.score >= 0.5)


def test_held_out_labels_are_not_learned(spark, scored, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{tmp_dir}/labels.parquet")
    got = {r.doc_id: r.score for r in op13_subwords(spark, tmp_dir).collect()}
    assert got == {i: r.score for i, r in scored.items()}
