import hashlib

import numpy as np
import pytest

from rill.llm import clusters

KINDS = "vec_id long, embedding array<double>, cluster string, distance double"


def brute(rows, k=8, rounds=10, dims=64, scale=1024, seed="3"):
    """Plain loops in exact integers."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dims or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(x) * scale if abs(x) > 2**53 else int(np.floor(x * scale)) for x in v]))
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in order[:k]]
    if not cs:
        return []
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, vs in members.items():
            cs[n] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, c, d in found if c == n) for n in range(len(cs))}
    fits = lambda x: x if x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return [(i, c, fits(d), fits(inertia[c]), fits(sum(inertia.values())), sha[c]) for i, c, d in found]


def run(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, "x", 1.5) for i, v in rows], KINDS).repartition(3)
    dims = {k: v for k, v in settings.items() if k == "dims"}
    centroids = clusters.fit(df, **settings)
    return sorted(map(tuple, clusters.with_inertia(clusters.label(df, centroids, **dims), centroids).collect()), key=str)


def vectors(n, dims=64, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=dims) * spread + i % 5).tolist()) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(300)
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_ties_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    grid = [(i, rng.integers(-1, 2, 64).astype(float).tolist()) for i in range(60)]
    rows = grid + grid[:20] + [(i, [0.0] * 64) for i in range(100, 160)] + [
        (None, [0.5] * 64), (200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63),
        (204, [float("nan")] * 64), (205, [float("inf")] * 64), (206, [1.0] * 65), (207, [-0.0] * 64),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    tied = [(i, [float(i % 2)] * 64) for i in range(40)]  # two points, eight starts: equal centroids
    assert run(spark, tied) == sorted(brute(tied), key=str)


def test_few_rows_and_empty_table(spark):
    for rows in ([], [(1, [1.0] * 64)], vectors(3), [(None, [1.0] * 64)], [(5, [1.0] * 3)]):
        assert run(spark, rows) == sorted(brute(rows), key=str)


def test_large_components_stay_exact(spark):
    for size in (2.0**17, 2.0**40, 1.7e308):
        check_large(spark, size)


def check_large(spark, size):
    rows = vectors(30) + [(100, [size] * 64), (101, [-size] + [0.25] * 63), (102, [size] * 64)]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_other_settings(spark):
    rows = vectors(200, dims=3, seed=4)
    assert run(spark, rows, k=40, rounds=3, dims=3, seed="z") == sorted(brute(rows, k=40, rounds=3, dims=3, seed="z"), key=str)


@pytest.mark.parametrize("k", [1, 4, 5, 9, 200])
def test_tree_search_prunes_and_is_exact(k):
    rng = np.random.default_rng(k)
    x = rng.integers(-50, 50, (500, 2))
    centroids = rng.integers(-50, 50, (k, 2)).tolist()
    tree = clusters.VantageTree(centroids)
    want = [min((int(((np.array(c) - v) ** 2).sum()), n) for n, c in enumerate(centroids)) for v in x]
    best, which, compared = tree.search(x)
    assert list(zip(best.tolist(), which.tolist())) == want
    assert [tree.nearest(v) for v in x.tolist()] == want
    if k == 200:
        assert compared < 0.3 * len(x) * k
