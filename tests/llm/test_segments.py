import math
import random

from pyspark.sql import functions as F

from rill.llm import segments

KINDS = "vec_id long, embedding array<double>, label int, score int, rank string"


def brute(rows, k=5):
    """Every query against every other row, in Python integers."""
    exact = lambda v: int(v) * 256 if abs(v) >= 2**53 else math.floor(256 * v)
    ok = [
        (n, i, list(map(exact, vec))) for n, (i, vec) in enumerate(rows)
        if i is not None and vec is not None and all(v is not None and math.isfinite(v) for v in vec)
    ]
    out = []
    for n, i, q in ok:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, j, c in ok if m != n)[:k]
            out += [(i, r, j, -s if abs(s) < 1 << 63 else None) for r, (s, j) in enumerate(best, 1)]
    return sorted(out, key=str)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], KINDS)
    found = segments.top_k(df, F.col("vec_id") % 50 == 0, k)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=str)


def floats(rows):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_matches_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(segments, "ROW_BLOCK", 150)
    monkeypatch.setattr(segments, "QUERY_BLOCK", 4)
    random.seed(8)
    centers = [[random.gauss(0, 1) for _ in range(32)] for _ in range(6)]
    rows = floats([(i, [c + random.gauss(0, 0.2) for c in random.choice(centers)]) for i in range(700)])
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_small_integers(spark):
    random.seed(3)
    rows = floats([(i, [random.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(300)])
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = floats([
        (0, [1.0, 2.0]), (50, [nan, 1.0]), (100, None), (150, []), (200, [inf, 0.0]), (250, [None, 1.0]), (None, [1.0, 1.0]),
        (1, [0.5, -0.5]), (2, [1.0, 1.0, 1.0]), (3, [1e30, 0.0]), (350, []), (400, [2e6, 1.0]), (5, [1.5e6, 0.0]), (6, []), (300, [-1.0]), (300, [-1.0]), (4, [1.0, 2.0]),
    ])
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, floats([(0, [1.0])])) == [] and run(spark, floats([(1, [1.0]), (2, [1.0])])) == []


def test_components_of_any_size_are_ranked_exactly(spark):
    random.seed(5)
    rows = floats([(i, [random.uniform(-9e5, 9e5) for _ in range(24)]) for i in range(120)])
    assert run(spark, rows) == brute(rows)
    sizes = [1.0, 2e6, 1e18, 1e30, 1e38, 1e160, 1.7e308]
    rows = [(i, [random.choice(sizes) * random.choice([-1.0, 0.0, 1.0, 0.75]) for _ in range(random.choice([0, 1, 5]))]) for i in range(400)]
    want = brute(rows)
    assert any(r[3] is None for r in want) and run(spark, rows) == want


def test_ranking_keys_order_as_the_scores():
    random.seed(1)
    scores = [random.choice([-1, 1]) * random.getrandbits(random.choice([3, 61, 62, 63, 64, 200])) for _ in range(500)] + [0, 1 << 62, -(1 << 62), -(1 << 62) - 1]
    assert sorted(scores) == sorted(scores, key=segments.ranking_key)
