"""Mixing sources to target weights, with built-in SQL functions only.

A source's weight is its token share to the power ``alpha``, normalised.
``alpha`` is found by bisection, either to reach a target entropy or as the
least flattening whose most repeated source stays within a repetition limit.
The weights are then realised: each source gets a token quota, read as whole
passes over its documents plus the start of one more, every pass in another
hash permutation, and the stream of passes is cut into blocks of equal budget
that each hold the sources in their weights.

Running sums inside a source, which may hold a third of all rows, go through
bit buckets of the permutation key: sums of buckets first, rows inside one
bucket after, so that no window holds a whole source.

Defined results: a null source is a source of its own; null and empty texts
have no tokens and, like sources without tokens, are placed once per pass of
their source; every row has a key of its own, so repeated rows and rows without
an id are placed one by one; an empty table gives an empty plan and no rows; other columns are not read, and ``realise``
keeps all columns of every row it places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rill.llm.common import reliable
from rill.session import scratch_path

WORDS = r"[^\x20\x09-\x0D]+"
#: Halvings settled by one aggregate, and aggregates: 25 halvings of [0, 1].
HALVINGS, ROUNDS = 5, 5
#: Bits of the permutation key that one refinement of a cut looks at, and refinements.
CUT_BITS, CUT_LEVELS = 12, 2
#: About so many rows in a bucket of the placement's running sums.
BUCKET_ROWS = 4_096


@dataclass(frozen=True)
class Target:
    """What the mixture has to meet; one of the first two is set."""

    max_repeats: float | None = 2.0
    entropy: float | None = None  # in nats
    budget: int | None = None  # tokens; None: the least that uses every document once
    block_tokens: int = 1_000_000
    seed: int = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


#: Columns of a table that ``numbered`` has written: a row with all its columns, and its number.
PACKED, ROW = "llm_packed", "llm_row_number"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once as packed rows with a number each, for ``compact`` and ``realise`` to agree on."""
    path = scratch_path(docs.sparkSession, "mix-rows")
    docs.select(F.struct(*docs.columns).alias(PACKED), F.monotonically_increasing_id().alias(ROW)).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def row_key(seed: int, doc_id, source, text, number) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, source, F.xxhash64(text), number)


def compact(docs: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, source, tokens, key) of every row: all that the plan needs.

    Rows that are not ``numbered`` are numbered here; checkpoint the result then.
    """
    packed = docs.columns == [PACKED, ROW]
    field = lambda c: F.col(PACKED)[c] if packed else F.col(c)
    number = F.col(ROW) if packed else F.monotonically_increasing_id()
    return docs.select(
        field("doc_id").alias("doc_id"), field("source").alias("source"), word_count(field("text")).alias("tokens"),
        row_key(seed, field("doc_id"), field("source"), field("text"), number).alias("key"),
    )


def shares(rows: DataFrame) -> DataFrame:
    """(source, n_docs, tokens, share) of every source."""
    sums = reliable(rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("tokens")))
    total = sums.agg(F.sum("tokens")).first()[0] or 0  # one number
    share = F.col("tokens") / F.lit(float(total)) if total else F.lit(0.0)
    return sums.withColumn("share", share)


def _curve(sources: DataFrame, alphas: list[float]) -> dict[float, dict]:
    """Entropy and repetition span of the mixture at each exponent, in one aggregate."""
    grid = F.explode(F.array(*(F.lit(a) for a in alphas))).alias("alpha")
    power = F.pow("share", "alpha")
    fixed = lambda c: F.sum(c.cast("decimal(28,18)"))  # exact sums do not depend on row order
    rows = (
        sources.where("share > 0").select("share", "tokens", grid).groupBy("alpha").agg(
            fixed(power).cast("double").alias("z"), fixed(power * F.log("share")).cast("double").alias("zl"),
            F.max(power / F.col("tokens")).alias("most"), F.min(power / F.col("tokens")).alias("least"),
        )
        .withColumn("entropy", F.log("z") - F.col("alpha") * F.col("zl") / F.col("z"))
        .collect()  # one row for each exponent of the grid
    )
    return {r["alpha"]: r.asDict() for r in rows}


def solve(sources: DataFrame, target: Target) -> float:
    """The exponent, by bisection over [0, 1] (repeats) or [0, 4] (entropy).

    One aggregate evaluates all points that the next ``HALVINGS`` halvings can
    ask for. A target that no exponent reaches ends at the nearer border.
    """
    lo, hi = 0.0, 1.0 if target.entropy is None else 4.0

    def go_up(at: dict) -> bool:
        """True if the exponent has to grow."""
        if target.entropy is not None:
            return at["entropy"] > target.entropy
        if target.budget is None:  # the least repeated source is used once
            return at["most"] / at["least"] > target.max_repeats
        return target.budget * at["most"] / at["z"] > target.max_repeats

    for _ in range(ROUNDS):
        n = 1 << HALVINGS
        grid = [lo + (hi - lo) * k / n for k in range(n + 1)]
        curve = _curve(sources, grid)
        if not curve:
            return 1.0
        a, b = 0, n
        if not go_up(curve[grid[0]]) and lo == 0.0:
            return 0.0
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if go_up(curve[grid[mid]]) else (a, mid)
        lo, hi = grid[a], grid[b]
    return hi


def plan(rows: DataFrame, target: Target = Target()) -> DataFrame:
    """One row per source: weight, quota, whole passes and the cut of the last pass."""
    sources = reliable(shares(rows))
    alpha = solve(sources, target)
    power = F.pow("share", F.lit(alpha))
    sums = sources.where("share > 0").agg(  # two numbers
        F.sum(power.cast("decimal(28,18)")).cast("double").alias("z"), F.min(power / F.col("tokens")).alias("least")
    ).first()
    z = sums["z"] or 1.0
    budget = float(target.budget) if target.budget is not None else z / sums["least"] if sums["least"] else 0.0
    used = F.col("tokens") > 0
    quotas = (
        sources.withColumn("weight", F.when(F.col("share") > 0, power / z).otherwise(F.lit(0.0)))
        .withColumn("mix_tokens", F.lit(round(budget)).cast("long"))
        .withColumn("quota", F.round(F.col("weight") * budget).cast("long"))
        .withColumn("passes", F.when(used, F.floor(F.col("quota") / F.col("tokens"))).otherwise(F.lit(1)).cast("int"))
        .withColumn("rest", F.when(used, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(F.lit(0)).cast("long"))
        .select("source", "n_docs", "tokens", "share", "weight", F.lit(alpha).alias("alpha"), "mix_tokens", "quota", "passes", "rest")
    )
    quotas = reliable(quotas)
    # written, so that its size is known: Spark then sends a small plan to the rows instead of dealing rows by source
    path = scratch_path(rows.sparkSession, "mix-plan")
    _with_cuts(rows, quotas, target.seed).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def pass_key(key: Column, number: Column, seed: int) -> Column:
    """Place of a row in the permutation of pass ``number``: 0 to 2**62 - 1."""
    return F.shiftrightunsigned(F.xxhash64(key, number.cast("int"), F.lit(seed)), 2)


def _with_cuts(rows: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """Adds ``cut``: rows of the last, partial pass are those with a key up to it (-1: none).

    The cut is the largest key whose running token sum stays within ``rest``.
    Two refinements by 12 bits narrow it to the rows of one small bucket.
    """
    last = rows.join(quotas.select(F.col("source").alias("s"), "passes", "rest"), F.col("source").eqNullSafe(F.col("s")))
    last = last.where("rest > 0").select("source", pass_key(F.col("key"), F.col("passes"), seed).alias("k"), "tokens", "rest")
    state = None
    for level in range(1, CUT_LEVELS + 1):
        shift = 62 - CUT_BITS * level
        part = F.shiftrightunsigned("k", shift)
        inside = last
        if state is not None:
            inside = last.join(
                state.select(F.col("source").alias("s"), "bucket", "before"),
                F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("k", shift + CUT_BITS) == F.col("bucket")),
            ).select("source", "k", "tokens", "rest", "before")
        else:
            inside = last.withColumn("before", F.lit(0).cast("long"))
        sums = inside.groupBy("source", part.alias("part")).agg(
            F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"), F.first("before").alias("before")
        )
        w = Window.partitionBy("source").orderBy("part")  # at most 2**12 rows of a source
        run = sums.withColumn("upto", F.col("before") + F.sum("tokens").over(w))
        crossing = run.where("upto > rest").groupBy("source").agg(
            F.min_by(F.struct("part", "upto", "tokens"), "part").alias("x")
        )
        state = reliable(crossing.select("source", F.col("x.part").alias("bucket"), (F.col("x.upto") - F.col("x.tokens")).alias("before")))
    inside = last.join(
        state.select(F.col("source").alias("s"), "bucket", "before"),
        F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("k", 62 - CUT_BITS * CUT_LEVELS) == F.col("bucket")),
    ).select("source", "k", "tokens", "rest", "before")
    w = Window.partitionBy("source").orderBy("k").rangeBetween(Window.unboundedPreceding, 0)
    over = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(w)).where("upto > rest")
    first_out = over.groupBy("source").agg(F.min("k").alias("out"))
    cut = F.when(F.col("rest") > 0, F.coalesce(F.col("out") - 1, F.lit((1 << 62) - 1))).otherwise(F.lit(-1)).cast("long")
    return quotas.join(first_out.select(F.col("source").alias("s"), "out"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        *quotas.columns, cut.alias("cut")
    )


def _copies(key: Column, seed: int) -> Column:
    return F.col("passes") + (pass_key(key, F.col("passes"), seed) <= F.col("cut")).cast("int")


def place(rows: DataFrame, sources: DataFrame, target: Target = Target()) -> DataFrame:
    """(doc_id, source, tokens, epoch, block_id, position) of every placed document."""
    info = sources.select(
        F.col("source").alias("s"), "passes", "cut", "quota", "mix_tokens", F.col("tokens").alias("source_tokens"),
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / BUCKET_ROWS))).cast("int").alias("bits"),
    )
    placed = (
        rows.join(info, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("copies", _copies(F.col("key"), target.seed)).where("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .withColumn("k", pass_key(F.col("key"), F.col("epoch"), target.seed))
        .withColumn("bucket", F.expr("shiftrightunsigned(k, 62 - bits)"))
        .select("doc_id", "source", "tokens", "epoch", "k", "bucket", "quota", "mix_tokens", "source_tokens")
    )
    group = ["source", "epoch", "bucket"]
    sums = placed.groupBy(*group).agg(F.sum("tokens").alias("n"))
    w = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"),
    )
    w = Window.partitionBy(*group).orderBy("k", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("epoch") * F.col("source_tokens") + F.col("before") + F.col("inside")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("mix_tokens") / target.block_tokens)).cast("long")
    even = F.floor(at.cast("double") / F.col("quota") * blocks).cast("long")
    cut = (
        placed.withColumn("inside", F.coalesce(F.sum("tokens").over(w), F.lit(0)))
        .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("bucket") == F.col("b")))
        .withColumn("block_id", F.when(F.col("quota") > 0, F.least(even, blocks - 1)).otherwise(F.pmod(F.col("k"), blocks)))
    )
    w = Window.partitionBy("block_id").orderBy(F.xxhash64("k", "epoch", F.lit(target.seed)), "doc_id", "epoch", "source")
    return cut.select("doc_id", "source", "tokens", "epoch", "block_id", F.row_number().over(w).alias("position"))


def realise(rows: DataFrame, sources: DataFrame, target: Target = Target()) -> DataFrame:
    """All columns of the ``numbered`` rows, every row as often as the plan places it."""
    info = sources.select(F.col("source").alias("llm_s"), F.col("passes"), F.col("cut"))
    field = lambda c: F.col(PACKED)[c]
    key = row_key(target.seed, field("doc_id"), field("source"), field("text"), F.col(ROW))
    mixed = rows.join(info, field("source").eqNullSafe(F.col("llm_s"))).withColumn("llm_copies", _copies(key, target.seed))
    many = mixed.where("llm_copies > 0").withColumn("llm_copy", F.explode(F.sequence(F.lit(1), F.col("llm_copies"))))
    return many.select(*(field(c).alias(c) for c in rows.schema[PACKED].dataType.names))
