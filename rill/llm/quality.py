"""Quality rules by gradient-boosted trees over document statistics.

Statistics of each text (lengths, symbols, repeated lines and windows, case,
digits, variety) feed boosted trees that are fitted in numpy on a bounded
sample of labelled rows. Chosen statistics have monotonic constraints: more of
them never raises the score. The fitted trees are flattened into node arrays
(feature, threshold, left, right, value), and a slice of documents descends
all trees together, one level a step.

Defined results: null and empty texts have zero statistics and fail the base
rule; repeated rows and ties get equal rows; rows with a null ``doc_id`` are
scored and never have a label; without labels of both kinds the trees are
empty and only the base rule counts; an empty table gives an empty result;
other columns are not read. Whole texts are counted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rill.llm.common import map_rows, reliable, schema

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"

# Fixed order of the statistics; the sign is the constraint on the score, 0 for none.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": -1, "mark_words": -1, "variety": 0, "end_marks": 0, "line_length": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: At most about so many labelled rows of each class are used to learn.
SAMPLE_PER_CLASS = 10_000
TREES, DEPTH, RATE, BINS, MIN_LEAF, RIDGE = 60, 3, 0.15, 32, 20, 1.0

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_END = b".!?"
_MARKED = re.compile(rb"[#*$%&|!]{2,}(?=\s|\Z)|(?<!\S)\|(?!\S)")


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, each word counted once."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    grams, size = ids, 1
    while size < window:  # exact numbers of longer and longer windows, by pairs of shorter ones
        step = min(size, window - size)
        left, right = grams[:len(grams) - step], grams[step:]
        pairs = left.astype(np.int64) * (int(grams.max()) + 1) + right
        grams, size = np.unique(pairs, return_inverse=True)[1], size + step
    many = np.bincount(grams)[grams] > 1
    if not many.any():
        return 0
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:n] += many
    edge[window:window + n] -= many
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """Base counts and features of one text."""
    raw = text.encode() if text else b""
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * 5, (0.0,) * len(FEATURES)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    space = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    chars = len(text) - space
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    dups = len(lines) - len(set(lines))
    repeats = repeated_words(ids)
    letters = len(raw)
    count = lambda drop: letters - len(raw.translate(None, drop))
    features = (
        float(np.log1p(n)), chars / n, symbols / chars, dups / len(lines), repeats / n, count(_UPPER) / chars,
        count(_DIGIT) / chars, len(_MARKED.findall(raw)) / n, len(numbers) / n, count(_END) / n, n / len(lines),
    )
    return (n, chars, symbols, dups, repeats), features


def base_failed(counts: tuple[int, ...]) -> bool:
    return counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]


@dataclass
class Trees:
    """Node arrays of all trees, one after another; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document, for rows of features."""
        if not len(self.roots):
            return np.ones(len(x))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.offset + self.value[node].sum(1))))


NO_TREES = Trees(*(np.zeros(0, dtype=k) for k in (np.int64, float, np.int64, np.int64, float, np.int64)), 0.0)


def boost(x: np.ndarray, y: np.ndarray, signs: np.ndarray) -> Trees:
    """Logistic boosting on histograms; classes weigh the same in sum.

    A split on a constrained feature must order its sides by the sign, and the
    middle of the two bounds everything below either side, so whole trees, and
    their sum, are monotonic.
    """
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    raw, nodes, roots = np.zeros(len(y)), [], []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, lo: float, hi: float) -> int:
        G, H = g[rows].sum(), h[rows].sum()
        me = len(nodes)
        nodes.append([0, 0.0, me, me, RATE * float(np.clip(-G / (H + RIDGE), lo, hi))])
        if depth == 0 or len(rows) < 2 * MIN_LEAF:
            return me
        best = (1e-6, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            gs, hs, ns = (np.bincount(b, w, len(e) + 1).cumsum()[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
            vl, vr = np.clip(-gs / (hs + RIDGE), lo, hi), np.clip(-(G - gs) / (H - hs + RIDGE), lo, hi)
            gain = gs * -vl - 0.5 * (hs + RIDGE) * vl**2 + (G - gs) * -vr - 0.5 * (H - hs + RIDGE) * vr**2
            gain -= 0.5 * G**2 / (H + RIDGE)
            gain[(ns < MIN_LEAF) | (len(rows) - ns < MIN_LEAF) | (signs[f] * (vr - vl) < 0)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1] is None:
            return me
        f, k, vl, vr = best[1]
        low, mid = binned[rows, f] <= k, (vl + vr) / 2
        bounds = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid)), 0: ((lo, hi), (lo, hi))}[int(signs[f])]
        nodes[me][:2] = [f, float(edges[f][k])]
        nodes[me][2] = grow(rows[low], g, h, depth - 1, *bounds[0])
        nodes[me][3] = grow(rows[~low], g, h, depth - 1, *bounds[1])
        return me

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        start = len(nodes)
        roots.append(grow(np.arange(len(y)), weight * (p - y), weight * p * (1 - p), DEPTH, -np.inf, np.inf))
        at = np.full(len(y), start)
        a = np.array(nodes[start:])
        for _ in range(DEPTH):
            f, t, l, r = a[at - start, 0].astype(int), a[at - start, 1], a[at - start, 2], a[at - start, 3]
            at = np.where(x[np.arange(len(y)), f] <= t, l, r).astype(int)
        raw = raw + a[at - start, 4]
    a = np.array(nodes)
    return Trees(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], np.array(roots), 0.0)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Trees:
    """Trees fitted on about ``per_class`` labelled rows of each quality, chosen by hash."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return NO_TREES
    share = F.create_map(*(F.lit(v) for k in (0, 1) for v in (k, min(1.0, per_class / sizes[k]))))
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) / 1_000_000
    # at most about 2 * per_class ids and flags: a proven bound
    picked = known.where(hashed < share[F.col("quality")]).select(F.col("doc_id").alias("llm_id"), "quality")
    texts = docs.select(F.col("doc_id").alias("llm_doc"), F.col("text").alias("llm_text"))
    rows = texts.join(F.broadcast(picked), F.col("llm_doc") == F.col("llm_id"))
    # one row of each id, whatever repeats: partial minima per task
    rows = rows.groupBy("llm_id", "quality").agg(
        F.min_by("llm_text", F.struct(F.xxhash64("llm_text"), F.length("llm_text"))).alias("llm_text")
    ).select("llm_text", F.col("quality").cast("int").alias("quality"))
    make = lambda: lambda texts, flags: [(list(statistics(t)[1]), f) for t, f in zip(texts, flags)]
    got = map_rows(rows, make, schema("x doubles,quality int")).collect()  # bounded by the sample
    data = np.array([[*r["x"], r["quality"]] for r in got])
    if len(data) < 2 * MIN_LEAF or len(np.unique(data[:, -1])) < 2:
        return NO_TREES
    data = data[np.lexsort(data.T)]
    return boost(data[:, :-1], data[:, -1], np.array(list(FEATURES.values())))


def judge(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, score) of every row; one pass, no shuffle."""

    def make():
        def f(ids, texts):
            found = [statistics(t) for t in texts]
            scores = trees.score(np.array([x for _, x in found]))
            return [
                (i, *c, bad := base_failed(c), bool(not bad and s >= threshold), float(s))
                for i, (c, _), s in zip(ids, found, scores)
            ]

        return f

    kinds = ",".join(f"{c} long" for c in ("doc_id", *BASE))
    return map_rows(docs.select("doc_id", "text"), make, schema(f"{kinds},base_failed boolean,kept boolean,score double"))
