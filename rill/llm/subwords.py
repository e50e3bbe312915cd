"""Quality classifier over learned subword vectors.

A document is a bag of its words, its word pairs and the character n-grams
inside words, the white space beside a word included; a word that follows
itself makes one pair, whatever the word. Each is hashed to a row of a table of
vectors; the rows of all occurrences are averaged, and a softmax over the
classes is taken of the average. Vectors and softmax weights are learned
together by stochastic gradient descent in numpy, one document a step, on a
bounded sample of labelled rows.

As the average is linear, ``scores`` first turns each row of the table into
its class evidence; averaging that equals the softmax input of the averaged
vector, and a task holds two numbers per row instead of the whole vectors.

Hashes are sums of powers, formed for all places of a text at once from its
code points. A text is read in pieces that end at white space where there is
any, so memory is bounded by ``PIECE`` code points; a longer run without white
space counts as words of that length.

Defined results: null, empty and blank texts have no features and get the
score of the class weights alone; equal texts get equal scores, whatever their
ids; rows with a null id are scored and never have a label; an id with several
labels has the largest, and one of its texts (the smallest hash) is learned
from; without labels of both classes every score is 0.5; an empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rill.llm.common import map_rows, schema

#: Rows of the table of vectors (a power of two), their length, and the lengths of the character n-grams (3 at least).
BUCKETS, WIDTH, GRAMS = 1 << 17, 16, (3, 4)
#: Code points read at a time.
PIECE = 1 << 18
#: Bounds of the sample: labelled rows of each class, and code points of all their texts together.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 3_000, 8_000_000
#: Passes over the sample and the first step length, which falls to zero in equal steps.
EPOCHS, RATE = 8, 4.0
SEED = 13

#: An odd multiplier for the powers and its inverse modulo 2**64, a finishing multiplier, a factor per kind of feature.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
FINISH = 0xD6E8FEB86659FD93

_SPACES = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    return np.concatenate([np.ones(1, dtype=np.uint64), np.multiply.accumulate(np.full(n, base, dtype=np.uint64))])


_UP, _DOWN = powers(BASE, PIECE + 2), powers(INVERSE, PIECE + 2)


def _rows(hashes: np.ndarray, kind: int) -> np.ndarray:
    """Rows of the table for hashes of one kind of feature."""
    mixed = (hashes + np.uint64(kind)) * np.uint64(FINISH)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(FINISH)
    return (mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def pieces(text: str) -> Iterator[np.ndarray]:
    """Code points, white space as one kind, with a space at either end of each piece."""
    at = 0
    while at < len(text):
        end = min(at + PIECE - 2, len(text))
        if end < len(text):
            cut = max(text.rfind(c, at, end) for c in " \n\t\r\x0b\x0c")
            end = cut + 1 if cut > at else end
        points = np.frombuffer(f" {text[at:end]} ".encode("utf-32-le"), dtype=np.uint32)
        yield np.where(np.isin(points, _SPACES), np.uint32(32), points).astype(np.uint64)
        at = end


def features(text: str | None) -> Iterator[np.ndarray]:
    """Table rows of all features of a text, an array for each piece and kind."""
    before = np.zeros(0, dtype=np.uint64)  # the last word of the piece before
    for points in pieces(text or ""):
        space = points == 32
        inside = np.cumsum(~space)  # letters up to each place
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        if not len(starts):
            continue
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(points * _UP[:len(points)])])
        words = (total[ends] - total[starts]) * _DOWN[starts]
        yield _rows(words, 1)
        words = np.concatenate([before, words])
        before = words[-1:]
        first, second = words[:-1], words[1:]
        yield _rows(np.where(first == second, np.uint64(0), first * np.uint64(FINISH) + second), 2)
        for n in GRAMS:
            if len(points) < n:
                continue
            m = len(points) - n + 1
            at = np.flatnonzero(inside[n - 2:n - 2 + m] - inside[:m] == n - 2)  # white space only at the ends
            yield _rows((total[at + n] - total[at]) * _DOWN[at], n)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and how often each occurs."""
    counts = np.zeros(0, dtype=np.int64)
    parts = list(features(text))
    if not parts:
        return counts, counts
    if sum(map(len, parts)) < BUCKETS:
        return np.unique(np.concatenate(parts), return_counts=True)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for p in parts:
        counts += np.bincount(p, minlength=BUCKETS)
    rows = np.flatnonzero(counts)
    return rows, counts[rows]


@dataclass
class Model:
    """Vectors of the table rows, and weights and offsets of the classes 0 and 1."""

    vectors: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def evidence(self) -> np.ndarray:
        """Evidence for class 1 over class 0 of each table row."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float64)


def empty() -> Model:
    return Model(np.zeros((BUCKETS, WIDTH), dtype=np.float32), np.zeros((2, WIDTH), dtype=np.float32), np.zeros(2))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Softmax regression on averaged vectors, vectors learned too: one document a step.

    The classes weigh the same in sum. Rows of a document are distinct, so its
    step is one indexed update of its rows.
    """
    rng = np.random.default_rng(seed)
    model = empty()
    model.vectors[:] = rng.uniform(-1 / WIDTH, 1 / WIDTH, model.vectors.shape)
    shares = [(rows, (n / n.sum()).astype(np.float32)[:, None]) for rows, n in bags]
    many = np.bincount(labels, minlength=2)
    weight = len(labels) / (2.0 * np.maximum(many, 1))
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            rows, share = shares[i]
            step = rate * (1 - done / steps) * min(1.0, weight[labels[i]])
            done += 1
            part = model.vectors[rows]
            mean = (part * share).sum(0)
            logits = model.weights @ mean + model.offsets
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1.0  # gradient of the loss by the softmax input
            model.vectors[rows] = part - share * (step * (p @ model.weights)).astype(np.float32)
            model.weights -= (step * np.outer(p, mean)).astype(np.float32)
            model.offsets -= 0.1 * step * p
    return model


def sample(docs: DataFrame, labels: DataFrame, use: Column, per_class: int, chars: int) -> DataFrame:
    """(doc_id, text, quality): about ``per_class`` labelled rows of each class, at most ``chars`` code points in all."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & use)
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return docs.sparkSession.createDataFrame([], "doc_id long, text string, quality int")
    share = F.create_map(*(F.lit(v) for k in (0, 1) for v in (k, min(1.0, per_class / sizes[k]))))
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000
    picked = known.where(place < share[F.col("quality")]).select(F.col("doc_id").alias("llm_id"), "quality")
    texts = docs.select(F.col("doc_id").cast("long").alias("llm_doc"), F.col("text").alias("llm_text"))
    # at most about 2 * per_class ids and labels: a proven bound
    rows = texts.join(F.broadcast(picked), F.col("llm_doc") == F.col("llm_id"))
    order = F.struct(F.xxhash64("llm_text"), F.length("llm_text"))
    one = rows.groupBy("llm_id", "quality").agg(F.min(order).alias("order"))
    lengths = one.select("llm_id", F.coalesce(F.col("order")["col2"], F.lit(0)).alias("n"), F.col("order")["col1"].alias("hash")).collect()
    # longest first out: the bound drops whole rows, the same ones every time
    kept, total = [], 0
    for r in sorted(lengths, key=lambda r: (r["n"], r["llm_id"])):
        total += r["n"]
        if total > chars:
            break
        kept.append((r["llm_id"], r["hash"]))
    wanted = docs.sparkSession.createDataFrame(kept, "want_id long, want_hash long")
    chosen = rows.join(F.broadcast(wanted), (F.col("llm_id") == F.col("want_id")) & (F.xxhash64("llm_text") == F.col("want_hash")))
    return chosen.groupBy("llm_id").agg(F.first("llm_text").alias("text"), F.first("quality").alias("quality")).withColumnRenamed("llm_id", "doc_id")


def fit(docs: DataFrame, labels: DataFrame, use: Column | None = None, per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS) -> Model:
    """A model of ``labels.quality`` from the rows of ``labels`` with ``use``."""
    def make():
        def f(ids, texts, flags):
            out = []
            for i, t, q in zip(ids, texts, flags):
                rows, n = bag(t)
                if len(rows):
                    out.append((i, q, rows.astype("<i4").tobytes(), n.astype("<i4").tobytes()))
            return out

        return f

    rows = sample(docs, labels, F.lit(True) if use is None else use, per_class, chars)
    got = map_rows(rows.select("doc_id", "text", "quality"), make, schema("doc_id long,quality int,rows binary,counts binary")).collect()  # bounded by the sample
    got.sort(key=lambda r: r["doc_id"])
    flags = np.array([r["quality"] for r in got], dtype=np.int64)
    if len(set(flags.tolist())) < 2:
        return empty()
    return train([(np.frombuffer(r["rows"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in got], flags)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_features) of every row: the probability of class 1; one pass, no shuffle."""
    evidence, offset = model.evidence(), float(model.offsets[1] - model.offsets[0])

    def make():
        def score(text):
            total, n = 0.0, 0
            for rows in features(text):
                total += float(evidence[rows].sum())
                n += len(rows)
            x = offset + (total / n if n else 0.0)
            return float(1 / (1 + np.exp(-x))), n

        return lambda ids, texts: [(i, *score(t)) for i, t in zip(ids, texts)]

    return map_rows(docs.select(F.col(id_col).cast("long"), text_col), make, schema("doc_id long,score double,n_features long"))
