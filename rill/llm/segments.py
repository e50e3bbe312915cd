"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments; a segment is summed up by its mean and its
deviation. For two vectors the squared distance is at least
``sum(len * ((m1 - m2)**2 + (d1 - d2)**2))`` over the segments, and with the
exact norms that bounds the inner product from above. Bounds go from coarse to
fine segments; only pairs that can still reach a query's k-th best exact score
go on, and the survivors are scored exactly.

Queries meet all rows in blocks: rows and queries are dealt into blocks of
bounded size, every (query block, row block) is one group, and the groups'
best k are merged per query.

Bounds are floats with a slack in proportion to both norms; a score is exact,
in floats where both norms leave room for that, else in Python integers.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; finite components may be of any size,
a score beyond a long is null and ranked exactly all the same; an empty vector
scores 0 with every other; vectors of different lengths are compared as if
padded with zeros; a query never meets its own row but meets other rows with
its id; ties go to the smaller id; repeated rows are rows of their own; without
queries or candidates the result is empty; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rill.llm.common import let_workers_import

#: Segments of the resolutions, coarse to fine.
RESOLUTIONS = (4, 16)
#: Rows and queries of a block.
ROW_BLOCK, QUERY_BLOCK = 2_048, 2_048
#: Pairs whose components are held at once.
PAIRS = 1 << 14
#: Components are scaled by this and rounded down.
SCALE = 256
#: Scores below this (in absolute value, with all their partial sums) are exact in floats.
EXACT = 2.0**52
#: Relative error allowed to bounds, per product of norms.
SLACK = 1e-9
#: Bits of a limb of a ranking key.
LIMB = 62


def summaries(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row the scaled means and deviations: their products bound inner products."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).round().astype(int)
    sizes = np.diff(cuts)
    sums = np.add.reduceat(x, cuts[:-1], axis=1)
    squares = np.add.reduceat(x * x, cuts[:-1], axis=1)
    spread = np.maximum(squares - sums**2 / sizes, 0.0)  # length times variance
    return np.concatenate([sums / np.sqrt(sizes), np.sqrt(spread)], axis=1)


def components(column: pa.ChunkedArray) -> np.ndarray:
    """A list column as a dense matrix, padded with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return out


def whole(v: float) -> int:
    """floor(SCALE * v), exact at any size."""
    return int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE)


def ranking_key(score: int) -> list[int]:
    """A list that orders as the score does: signed number of limbs, then the limbs from the top one, which has the sign."""
    limbs = []
    while not -(1 << LIMB) <= score < 1 << LIMB:
        limbs.append(score & ((1 << LIMB) - 1))
        score >>= LIMB
    limbs.append(score)
    return [len(limbs) if score >= 0 else -len(limbs), *reversed(limbs)]


def block_top_k(q_raw: np.ndarray, q_row: np.ndarray, x_raw: np.ndarray, x_id: np.ndarray, x_row: np.ndarray, k: int):
    """(query index, row index, score) lists of the k best rows of each query in a block, ties to smaller ids."""
    width = max(q_raw.shape[1], x_raw.shape[1])
    q_raw, x_raw = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q_raw, x_raw))
    out_q, out_x, out_scores = [], [], []
    with np.errstate(over="ignore", invalid="ignore"):  # bounds that overflow keep their pairs
        q, x = np.floor(q_raw * SCALE), np.floor(x_raw * SCALE)
        q_norm, x_norm = (np.sqrt((m * m).sum(1)) for m in (q, x))
        levels = [(summaries(q, s), summaries(x, s)) for s in RESOLUTIONS]
        for at in range(0, len(q), 256):
            part = slice(at, min(at + 256, len(q)))
            own = q_row[part, None] == x_row[None, :]
            slack = 0.5 + SLACK * q_norm[part, None] * x_norm[None, :]  # scores are whole numbers; rounding stays far below
            bound = levels[0][0][part] @ levels[0][1].T + slack
            bound[np.isnan(bound)] = np.inf
            bound[own] = -np.inf
            n = min(k, len(x))
            # scores of the rows with the best coarse bounds give each query a first threshold
            first = np.argpartition(-bound, n - 1, axis=1)[:, :n]
            seeds = np.einsum("qd,qnd->qn", q[part], x[first]) - np.take_along_axis(slack, first, 1)
            seeds[np.take_along_axis(own, first, 1) | np.isnan(seeds)] = -np.inf
            reach = seeds.min(axis=1) if n == k else np.full(len(first), -np.inf)
            qi, xi = np.nonzero((bound >= reach[:, None]) & ~own)
            for fine_q, fine_x in levels[1:]:
                keep = np.zeros(len(qi), dtype=bool)
                for p in range(0, len(qi), PAIRS):
                    a, b = qi[p:p + PAIRS], xi[p:p + PAIRS]
                    bounds = np.einsum("pd,pd->p", fine_q[at + a], fine_x[b]) + slack[a, b]
                    keep[p:p + PAIRS] = np.isnan(bounds) | (bounds >= reach[a])
                qi, xi = qi[keep], xi[keep]
            scores = np.zeros(len(qi), dtype=np.int64)
            narrow = q_norm[at + qi] * x_norm[xi] < EXACT
            for p in range(0, len(qi), PAIRS):
                fit = p + np.flatnonzero(narrow[p:p + PAIRS])
                scores[fit] = np.einsum("pd,pd->p", q[at + qi[fit]], x[xi[fit]]).astype(np.int64)
            if narrow.all():
                order = np.lexsort((x_id[xi], -scores, qi))
            else:
                scores = scores.astype(object)
                for p in np.flatnonzero(~narrow):
                    scores[p] = sum(whole(a) * whole(b) for a, b in zip(q_raw[at + qi[p]].tolist(), x_raw[xi[p]].tolist()) if a and b)
                order = np.array(sorted(range(len(qi)), key=lambda p: (qi[p], -scores[p], x_id[xi[p]])), dtype=np.int64)
            qi, xi, scores = qi[order], xi[order], scores[order]
            new = np.r_[True, qi[1:] != qi[:-1]] if len(qi) else np.zeros(0, dtype=bool)
            place = np.arange(len(qi)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(qi) else qi
            best = place < k
            out_q.extend((at + qi[best]).tolist())
            out_x.extend(xi[best].tolist())
            out_scores.extend(scores[best].tolist())
    return out_q, out_x, out_scores


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row with ``is_query``."""
    fit = F.forall(vector_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fit).select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    row_blocks, query_blocks = max(1, -(-sizes["n"] // ROW_BLOCK)), max(1, -(-sizes["q"] // QUERY_BLOCK))
    number = F.col("row_no")
    own_row, own_query = F.pmod(number, F.lit(row_blocks)), F.pmod(F.xxhash64(number), F.lit(query_blocks))
    place = lambda qb, rb, asks: F.struct(
        qb.cast("int").alias("query_block"), rb.cast("int").alias("row_block"), F.lit(asks).alias("query")
    )
    as_row = F.transform(F.sequence(F.lit(0), F.lit(query_blocks - 1)), lambda b: place(b, own_row, False))
    as_query = F.transform(F.sequence(F.lit(0), F.lit(row_blocks - 1)), lambda b: place(own_query, b, True))
    dealt = (
        rows.withColumn("row_no", F.monotonically_increasing_id())
        .withColumn("at", F.explode(F.when(F.col("asks"), F.concat(as_row, as_query)).otherwise(as_row)))
        .select("at.query_block", "at.row_block", "at.query", "row_no", "vec_id", "v")
    )
    arrow = pa.schema([*((n, pa.int64()) for n in ("query_no", "query_id", "vec_id", "score")), ("key", pa.list_(pa.int64()))])
    let_workers_import(vectors.sparkSession)

    def search(group: pa.Table) -> pa.Table:
        query = group.column("query").to_numpy(zero_copy_only=False).astype(bool)
        if not query.any() or query.all():
            return arrow.empty_table()
        q, x = group.filter(pa.array(query)), group.filter(pa.array(~query))
        ids = lambda t, c: t.column(c).to_numpy()
        qi, xi, scores = block_top_k(
            components(q.column("v")), ids(q, "row_no"), components(x.column("v")), ids(x, "vec_id"), ids(x, "row_no"), k
        )
        fits = [v if -(1 << 63) <= v < 1 << 63 else None for v in scores]
        columns = (ids(q, "row_no")[qi], ids(q, "vec_id")[qi], ids(x, "vec_id")[xi], fits, list(map(ranking_key, scores)))
        return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    found = dealt.groupBy("query_block", "row_block").applyInArrow(
        search, "query_no long, query_id long, vec_id long, score long, key array<long>"
    )
    w = Window.partitionBy("query_no").orderBy(F.desc("key"), "vec_id")  # k rows of each row block
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
