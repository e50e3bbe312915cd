"""Centroid clustering with a vantage-point tree over the centroids.

Components become whole numbers, ``floor(scale * x)``. Each round the driver
builds a vantage-point tree over the centroids and broadcasts it (centroids
times components numbers: its size does not depend on the data). Every vector
searches the tree best first: the open node with the smallest lower bound is
expanded, its vantage point compared exactly, and its two sides are opened
with the bound that the triangle inequality gives. A node is left out only if
its bound is above the best distance so far; at equality it is searched, so
that equal distances go to the smaller centroid number.

Vectors of a batch are searched side by side: one matrix holds the bounds of
all nodes for each vector, a step expands each unfinished vector's own best
node, and finished vectors leave. Distances are int64 where they fit; batches
or centroids with larger components are searched one vector at a time in
Python integers, with whole-number bounds.

Tasks return counts and sums per cluster, never vectors; sums are added up in
limbs of ``LIMB`` bits, exact at any size.

Defined results: vectors that are null, of another length or with null or
non-finite components take no part; rows without an id are assigned and
counted but never start a centroid; repeated ids and rows are vectors of their
own, equal ids starting in the order of their components; fewer starts than
``k`` give fewer centroids, and without any the result is empty; a squared
distance or an inertia beyond a long is null, the assignment exact all the
same; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from rill.llm.common import let_workers_import, reliable

#: Centroids of a leaf.
LEAF = 4
#: Vectors searched side by side.
VECTORS = 2_048
#: Bits of a limb: sums of 2**30 tasks' limbs fit a decimal of 38 digits with room to spare.
LIMB = 40
LONG = 1 << 63


@dataclass
class Node:
    """A vantage point with the nearer and the farther rest, or a leaf with its members."""

    members: tuple[int, ...]  # centroid numbers compared when the node is expanded
    sides: tuple[tuple[int, int, int], ...] = ()  # (node, least, most) squared distance from the vantage point


class VantageTree:
    """Tree over integer centroids; node 0 is the root."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        self.nodes: list[Node] = []
        # components below this (in absolute value) have squared distances within int64
        self.narrow = math.isqrt((1 << 62) // max(1, len(centroids[0]) if centroids else 1)) // 2
        self.wide = any(abs(x) >= self.narrow for c in centroids for x in c)
        if centroids:
            self._grow(list(range(len(centroids))))
        self.matrix = None if self.wide else np.array(centroids, dtype=np.int64)

    def _grow(self, members: list[int]) -> int:
        me = len(self.nodes)
        self.nodes.append(Node(tuple(members)))
        if len(members) <= LEAF:
            return me
        # the vantage point is the member farthest from the first: it tells the others apart best
        distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(self.centroids[a], self.centroids[b]))
        point = max(members, key=lambda m: (distance(members[0], m), -m))
        rest = sorted((distance(point, m), m) for m in members if m != point)
        half = len(rest) // 2
        sides = []
        for part in (rest[:half], rest[half:]):
            sides.append((self._grow([m for _, m in part]), part[0][0], part[-1][0]))
        self.nodes[me] = Node((point,), tuple(sides))
        return me

    def nearest(self, vector: list[int]) -> tuple[int, int]:
        """(squared distance, centroid) of one vector, in Python integers.

        Roots are rounded down, so a distance lies in [root, root + 1): bounds
        take the safe end and compare as squares.
        """
        best = None
        queue = [(0, 0)]
        while queue:
            bound, at = heapq.heappop(queue)
            if best is not None and bound * bound > best[0]:
                break
            node = self.nodes[at]
            for m in node.members:
                d2 = sum((x - y) ** 2 for x, y in zip(vector, self.centroids[m]))
                if best is None or (d2, m) < best:
                    best = d2, m
            if node.sides:
                d = math.isqrt(d2)
                for side, least, most in node.sides:
                    low = max(bound, d - math.isqrt(most) - 1, math.isqrt(least) - d - 1)
                    heapq.heappush(queue, (low, side))
        return best

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(squared distances, centroids) of int64 vectors, and how many distances were computed."""
        n = len(x)
        best, which = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.centroids))
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0
        alive, compared = np.arange(n), 0
        while len(alive):
            open_ = bounds[alive]
            pick = open_.argmin(1)
            low = open_[np.arange(len(alive)), pick]
            # bounds carry the rounding of their roots downwards; one above the best distance cannot hold an equal one
            go = np.isfinite(low) & (low <= np.sqrt(best[alive].astype(np.float64)) * (1 + 1e-12))
            alive, pick, low = alive[go], pick[go], low[go]
            for at in np.unique(pick):
                here = alive[pick == at]
                floor = low[pick == at]
                bounds[here, at] = np.inf
                node = self.nodes[at]
                for m in node.members:
                    away = x[here] - self.matrix[m]
                    d2 = np.einsum("vd,vd->v", away, away)
                    compared += len(here)
                    better = (d2 < best[here]) | ((d2 == best[here]) & (m < which[here]))
                    best[here[better]], which[here[better]] = d2[better], m
                d = np.sqrt(d2.astype(np.float64)) if node.sides else None
                for side, least, most in node.sides:
                    near, far = math.sqrt(least), math.sqrt(most)
                    bounds[here, side] = np.maximum(floor, np.maximum(d - far, near - d) - 1e-9 * (d + far))
        return best, which, compared


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers if any is too large for it."""
    scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    exact = lambda v: int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale)
    return np.array([exact(v) for v in values.ravel()], dtype=object).reshape(values.shape)


def vectors_of(batch: pa.RecordBatch, dims: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and whole components of the vectors that take part."""
    ids, lists = batch.column(0), batch.column(1)
    fit = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
    ids, lists = ids.filter(fit), lists.filter(fit)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    fine = np.isfinite(values).all(1)  # nulls have become not-a-number
    with np.errstate(over="ignore"):
        return ids.filter(pa.array(fine)), whole(values[fine], scale)


def assign(tree: VantageTree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distances, centroids) of the vectors, exact."""
    if not tree.wide and x.dtype != object and (not x.size or np.abs(x).max() < tree.narrow):
        best, which, _ = tree.search(x)
        return best, which
    found = [tree.nearest(v) for v in x.tolist()]
    return np.array([d for d, _ in found], dtype=object), np.array([c for _, c in found], dtype=np.int64)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of a whole number: limbs below 2**LIMB, the sign in the last."""
    place = 0
    while not -(1 << LIMB) < value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


SUMS = pa.schema([("cluster", pa.int32()), ("item", pa.int32()), ("place", pa.int32()), ("amount", pa.int64())])


def totals(rows: DataFrame, tree: Broadcast, dims: int, scale: int) -> dict[int, list[int]]:
    """Per centroid the component sums and the count of its vectors: one pass, a few rows for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                _, x = vectors_of(batch.slice(at, VECTORS), dims, scale)
                _, which = assign(tree.value, x)
                for c in np.unique(which).tolist():
                    part = x[which == c]
                    # a slice of int64 sums fits as long as its vectors are below 2**62 / VECTORS; else Python integers
                    small = part.dtype != object and np.abs(part).max(initial=0) < 1 << 50
                    sums = (part if small else part.astype(object)).sum(0).tolist()
                    held[c] = [a + b for a, b in zip(held.get(c, [0] * (dims + 1)), [*sums, len(part)])]
        out = [(c, i, p, v) for c, sums in held.items() for i, s in enumerate(sums) for p, v in limbs(s)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), SUMS)], schema=SUMS)

    parts = rows.mapInArrow(run, "cluster int, item int, place int, amount long")
    found: dict[int, list[int]] = {}
    # centroids times components, with a few limbs each: bounded by the setting, not by the data
    for r in parts.groupBy("cluster", "item", "place").agg(F.sum(F.col("amount").cast("decimal(19,0)")).alias("amount")).collect():
        sums = found.setdefault(r["cluster"], [0] * (dims + 1))
        sums[r["item"]] += int(r["amount"]) << (LIMB * r["place"])
    return found


def starts(rows: DataFrame, k: int, dims: int, scale: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors whose ids have the smallest sha256 of ``seed:id``, in that order; at most ``k`` of each task are sent."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: list[tuple[str, list[int]]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, VECTORS):
                ids, x = vectors_of(batch.slice(at, VECTORS), dims, scale)
                order = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in ids.to_pylist()]
                top = heapq.nsmallest(k, (h for h, i in zip(order, ids) if i.is_valid))
                some = [(h, v.tolist()) for h, i, v in zip(order, ids, x) if i.is_valid and h <= top[-1]] if top else []
                first = sorted(first + some)[:k]
        if first:
            near = lambda v: float(v) if abs(v) < 1 << 1000 else (math.inf if v > 0 else -math.inf)
            columns = ([h for h, _ in first], [[near(c) for c in v] for _, v in first], [",".join(map(str, v)) for _, v in first])
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["hash", "size", "components"])

    sent = rows.mapInArrow(keep, "hash string, size array<double>, components string").orderBy("hash", "size", "components").limit(k)
    return [list(map(int, r["components"].split(","))) for r in sent.collect()]


def fit(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
        id_col: str = "vec_id", vector_col: str = "embedding") -> list[list[int]]:
    """Centroids after ``rounds`` rounds; a centroid without vectors stays."""
    let_workers_import(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector_col)
    centroids = starts(rows, k, dims, scale, seed)
    for _ in range(rounds if centroids else 0):
        tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
        for c, sums in totals(rows, tree, dims, scale).items():
            centroids[c] = [s // sums[-1] for s in sums[:-1]]
        tree.unpersist()
    return centroids


def label(vectors: DataFrame, centroids: list[list[int]], dims: int = 64, scale: int = 1024,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance) of every vector that takes part; a squared distance beyond a long is null."""
    session = vectors.sparkSession
    let_workers_import(session)
    tree = session.sparkContext.broadcast(VantageTree(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if centroids else ():
            for at in range(0, batch.num_rows, VECTORS):
                ids, x = vectors_of(batch.slice(at, VECTORS), dims, scale)
                best, which = assign(tree.value, x)
                away = [d if d < LONG else None for d in best.tolist()] if best.dtype == object else best
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(which, type=pa.int32()), pa.array(away, type=pa.int64())], names=["vec_id", "cluster", "distance"]
                )

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector_col)
    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def with_inertia(labelled: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``labelled`` with its clusters' inertia, that of all, and the hash of the centroid; one row per cluster is collected."""
    labelled = reliable(labelled)
    sums = labelled.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(19,0)")).alias("inertia"), F.count_if(F.isnull("distance")).alias("beyond")
    ).collect()
    fits = lambda v: v if v is not None and v < LONG else None
    known = {r["cluster"]: None if r["beyond"] else int(r["inertia"]) for r in sums}
    everything = fits(None if None in known.values() else sum(known.values()))
    facts = labelled.sparkSession.createDataFrame(
        [(c, fits(v), everything, centroid_sha256(centroids[c])) for c, v in sorted(known.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return labelled.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def centroid_sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
