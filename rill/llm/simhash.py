"""SimHash near-duplicates by a trie self-join.

A fingerprint has a bit set where over half the hashes of a text's shingles
have it. Fingerprints within ``distance`` bits are linked and a document's
class is its connected component.

The self-join walks pairs of nodes of a binary trie together: descending on
equal bits keeps the error, on different bits adds one, and a pair beyond the
error budget is pruned. To share the walk out, the 64 bits are cut into
``distance + 1`` blocks: two fingerprints within ``distance`` bits agree in at
least one whole block, so each block in turn is moved to the top of the trie
and only the node pairs below equal blocks have to be walked, one Spark group
per (block, value). In a group above ``chunk`` members the bits below the block
are cut into blocks again, and each of these in turn comes next. A group still
above ``chunk`` is dealt by its trie nodes some bits further down: only pairs of
nodes within the error budget meet, so far pairs are pruned before the shuffle,
and a node above ``chunk`` meets in chunks. No task holds an unbounded group and
nothing is skipped. A walk returns a spanning forest of the links it found,
which has the same components as all of them.

Defined results: null and empty texts have fingerprint zero, linked like any
other; repeated rows and copies share a fingerprint and are joined as one; a
component whose ids are all null has a null ``component_id``, otherwise nulls
are ignored; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rill.llm.common import let_workers_import, map_rows, reliable, schema

SHINGLE_WORDS, DISTANCE, SEED = 3, 3, 42
#: Members of one side of a walk; larger groups are dealt into node pairs.
CHUNK = 2_048
#: Bits of a trie node that a large group is dealt by, at most: 299 nodes are within three bits of one.
NODE_BITS = 12
#: Members gathered for one vectorised walk over many small groups.
WALK_ROWS = 32_768
#: Node pairs held at once; more are walked in pieces.
FRONT = 500_000


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes, highest bit first, of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return bytes(8)
    if len(words) <= n:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(s, SEED) for s in shingles])
    size, counts = len(raw) // 8, np.zeros(64, dtype=np.int64)
    hashes = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, len(hashes), 1 << 16):  # slices bound the unpacked bits of a long text
        counts += np.unpackbits(hashes[at:at + (1 << 16)]).reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(counts * 2 > size).tobytes()


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed 64-bit number."""

    def make():
        return lambda ids, texts: [
            (i, int.from_bytes(fingerprint(t, words), "big", signed=True)) for i, t in zip(ids, texts)
        ]

    return map_rows(docs.select("doc_id", "text"), make, schema("doc_id long,fp long"))


def walk(keys: np.ndarray, pairs: np.ndarray, depth: int, budget: int):
    """Close index pairs below trie node pairs.

    ``keys`` holds sorted runs of unsigned fingerprints, rotated so that their
    first ``depth`` bits agree inside a run. A row of ``pairs`` is a pair of
    runs (lo1, hi1, lo2, hi2), the same run twice for a self-join. Yields
    arrays (i, j) with at most ``budget`` differing bits, each pair once.
    """
    errors = np.zeros(len(pairs), dtype=np.int64)
    stack = [(depth, pairs, errors)]
    while stack:
        d, p, e = stack.pop()
        if len(p) > FRONT:
            half = len(p) // 2
            stack += [(d, p[half:], e[half:]), (d, p[:half], e[:half])]
            continue
        single = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
        if d == 64 or single.any():
            ends = np.ones(len(p), dtype=bool) if d == 64 else single
            i, j = p[ends, 0], p[ends, 2]
            if d == 64:  # equal keys: only across two runs, as keys are distinct inside one
                yield i[i != j], j[i != j]
            else:
                differ = np.bitwise_count(keys[i] ^ keys[j])
                near = (i != j) & (differ <= budget)
                yield i[near], j[near]
            p, e = p[~ends], e[~ends]
        if not len(p):
            continue
        left, right = _split(keys, p[:, 0], p[:, 1], d), _split(keys, p[:, 2], p[:, 3], d)
        same = (p[:, 0] == p[:, 2]) & (p[:, 1] == p[:, 3])
        zero = np.stack([p[:, 0], left, p[:, 2], right], 1)
        one = np.stack([left, p[:, 1], right, p[:, 3]], 1)
        cross = np.stack([p[:, 0], left, right, p[:, 3]], 1)
        back = np.stack([left, p[:, 1], p[:, 2], right], 1)
        open_ = e < budget
        p = np.concatenate([zero, one, cross[open_], back[open_ & ~same]])
        e = np.concatenate([e, e, e[open_] + 1, e[open_ & ~same] + 1])
        some = (p[:, 1] > p[:, 0]) & (p[:, 3] > p[:, 2])
        alone = (p[:, 0] == p[:, 2]) & (p[:, 1] == p[:, 3]) & (p[:, 1] - p[:, 0] == 1)
        stack.append((d + 1, p[some & ~alone], e[some & ~alone]))


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where bit ``depth`` turns to one in each sorted run [lo, hi): a bisection of all runs at once."""
    a, b, shift = lo.copy(), hi.copy(), np.uint64(63 - depth)
    while (todo := a < b).any():
        mid = (a + b) >> 1
        one = ((keys[np.where(todo, mid, 0)] >> shift) & np.uint64(1)).astype(bool)
        b = np.where(todo & one, mid, b)
        a = np.where(todo & ~one, mid + 1, a)
    return a


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component, by label passing with jumps."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def spanning(keys: np.ndarray, pairs: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) links that connect what ``walk`` links."""
    label = np.arange(len(keys))
    kept_i, kept_j, size = [], [], 0
    for i, j in walk(keys, pairs, depth, budget):
        kept_i.append(i)
        kept_j.append(j)
        size += len(i)
        if size > 1 << 20:
            label = forest(len(keys), np.concatenate([*kept_i, np.arange(len(keys))]), np.concatenate([*kept_j, label]))
            kept_i, kept_j, size = [], [], 0
    if size:
        label = forest(len(keys), np.concatenate([*kept_i, np.arange(len(keys))]), np.concatenate([*kept_j, label]))
    member = np.flatnonzero(label != np.arange(len(keys)))
    return member, label[member]


def _cuts(bits: int, parts: int) -> list[int]:
    return [round(bits * k / parts) for k in range(parts + 1)]


def heads(distance: int) -> list[tuple[int, int, int, int]]:
    """(turn, below, inner turn, depth) of every order of bits that heads a trie.

    The 64 bits are turned so that a block comes first, the ``below`` bits after
    it so that one of their blocks comes next; ``depth`` bits then head the trie.
    The first ``distance + 1`` orders have one block, the others two.
    """
    outer = _cuts(64, distance + 1)
    one = [(a, 64 - (b - a), 0, b - a) for a, b in zip(outer, outer[1:])]
    two = []
    for turn, below, _, depth in one:
        inner = _cuts(below, distance + 1)
        two += [(turn, below, a, depth + b - a) for a, b in zip(inner, inner[1:])]
    return one + two


def _key(fp, head: tuple[int, int, int, int]):
    """The bits of column ``fp`` in the order of ``head``."""
    turn, below, inner, _ = head
    key = F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn)) if turn else fp
    if inner:
        mask = (1 << below) - 1
        low = key.bitwiseAND(F.lit(mask))
        low = F.shiftleft(low, inner).bitwiseOR(F.shiftrightunsigned(low, below - inner)).bitwiseAND(F.lit(mask))
        key = key.bitwiseAND(F.lit(~mask)).bitwiseOR(low)
    return key


def _fp(keys: np.ndarray, head: tuple[int, int, int, int]) -> np.ndarray:
    """The fingerprints whose bits ``_key`` has put in the order of ``head``."""
    turn, below, inner, _ = head
    u = np.uint64
    if inner:
        mask = u((1 << below) - 1)
        low = keys & mask
        low = ((low >> u(inner)) | (low << u(below - inner))) & mask
        keys = (keys & ~mask) | low
    return (keys >> u(turn)) | (keys << u(64 - turn)) if turn else keys


def _keyed(fps: DataFrame, orders: dict[int, tuple[int, int, int, int]]) -> DataFrame:
    """(head, value, key) of every fingerprint in each order; ``value`` is the bits that head the trie."""
    at = F.explode(F.array(*(
        F.struct(F.lit(h).alias("head"), _key(F.col("fp"), o).alias("key"), F.lit(64 - o[3]).alias("rest"))
        for h, o in orders.items()
    )))
    return fps.select(at.alias("at")).select(
        "at.head", F.expr("shiftrightunsigned(at.key, at.rest)").alias("value"), "at.key", "at.rest"
    )


def _sized(keyed: DataFrame) -> DataFrame:
    """Rows of groups with company, and the group's size ``n``."""
    sizes = keyed.groupBy("head", "value").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(sizes, ["head", "value"])


def _by_node(rows: DataFrame, distance: int, chunk: int) -> DataFrame:
    """Rows of large groups dealt to pairs of trie nodes within ``distance`` bits.

    A node is the next bits of the key, as many as bring nodes down to about
    ``chunk`` members. Nodes are counted; one above ``chunk`` is cut into parts by
    hash. A slot is a part of a node, and two slots meet once.
    """
    group = ["head", "value", "width"]
    width = F.least(F.lit(NODE_BITS), F.col("rest"), F.ceil(F.log2(F.col("n") / chunk))).cast("int")
    rows = rows.withColumn("width", width).withColumn(
        "node", F.expr("shiftrightunsigned(key, rest - width) & (shiftleft(1L, width) - 1L)")
    )
    nodes = rows.groupBy(*group, "node").agg(F.ceil(F.count("*") / chunk).cast("long").alias("parts"))
    masks = (  # at most 2**NODE_BITS rows a width
        rows.sparkSession.range(1 << NODE_BITS).where(F.bit_count("id") <= distance)
        .select(F.col("id").alias("mask"), F.explode(F.sequence(F.lit(0), F.lit(NODE_BITS))).alias("width"))
        .where("mask < shiftleft(1L, width)")
    )
    near = nodes.join(F.broadcast(masks), "width").withColumn("far", F.col("node").bitwiseXOR(F.col("mask")))
    far = nodes.select(*group, F.col("node").alias("far"), F.col("parts").alias("far_parts"))
    near = near.join(far, [*group, "far"]).select(*group, "node", "parts", "far", "far_parts")
    slot = lambda node, part: F.shiftleft(node, 32) + part
    return (
        rows.join(near, [*group, "node"])
        .withColumn("own", slot(F.col("node"), F.pmod(F.xxhash64("key", F.lit(5)), F.col("parts"))))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("far_parts") - 1)))
        .withColumn("other", slot(F.col("far"), F.col("part")))
        .select(
            "head", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "key",
        )
    )


def links(fps: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links among the distinct values of ``fp``, spanning each component."""
    orders = heads(distance)
    blocks = distance + 1
    whole = lambda rows: rows.where(F.col("n") <= chunk).select(
        "head", "value", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"), F.lit(0).alias("side"), "key"
    )
    first = _sized(_keyed(fps, dict(enumerate(orders[:blocks]))))
    dealt = whole(first)
    # each large group again, the blocks below its own in turn; the key of the first order holds the bits
    again = first.where(F.col("n") > chunk)
    inner = F.explode(F.array(*(
        F.struct(
            (F.lit(blocks) + F.col("head") * blocks + j).cast("int").alias("head"),
            F.coalesce(*(F.when(F.col("head") == k, _key(F.col("key"), (0, *orders[blocks + k * blocks + j][1:]))) for k in range(blocks))).alias("key"),
            F.coalesce(*(F.when(F.col("head") == k, 64 - orders[blocks + k * blocks + j][3]) for k in range(blocks))).alias("rest"),
        )
        for j in range(blocks)
    )))
    second = _sized(again.select(inner.alias("at")).select(
        "at.head", F.expr("shiftrightunsigned(at.key, at.rest)").alias("value"), "at.key", "at.rest"
    ))
    dealt = dealt.unionByName(whole(second)).unionByName(_by_node(second.where(F.col("n") > chunk), distance, chunk))
    meeting = ["head", "value", "low", "high"]
    dealt = dealt.repartition(*meeting).sortWithinPartitions(*meeting)

    let_workers_import(fps.sparkSession)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= WALK_ROWS:
                done, rest = _last_group(pa.Table.from_batches(held), meeting)
                if done is not None:
                    yield from _join(done, meeting, orders, distance)
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield from _join(pa.Table.from_batches(held), meeting, orders, distance)

    return dealt.mapInArrow(run, "a long, b long")


def _changes(t: pa.Table, cols: list[str]) -> np.ndarray:
    """True at rows that begin a new group."""
    new = np.zeros(t.num_rows, dtype=bool)
    new[:1] = True
    for c in cols:
        x = t.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return new


def _last_group(t: pa.Table, cols: list[str]):
    """Whole groups so far, and the last group, which may go on."""
    start = int(np.flatnonzero(_changes(t, cols))[-1])
    return (t.slice(0, start) if start else None), t.slice(start)


def _join(t: pa.Table, meeting: list[str], orders: list[tuple[int, int, int, int]], budget: int):
    """Walk all meetings of a table; tables are cut by head because the walk starts below it."""
    t = t.combine_chunks()
    group = np.cumsum(_changes(t, meeting)) - 1
    key = t.column("key").to_numpy().view(np.uint64)
    head, side = t.column("head").to_numpy(), t.column("side").to_numpy()
    low, high = t.column("low").to_numpy(), t.column("high").to_numpy()
    for h in np.unique(head):
        rows = np.flatnonzero(head == h)
        order = np.lexsort((key[rows], side[rows], group[rows]))
        rows = rows[order]
        keys = key[rows]
        run = group[rows] * 2 + side[rows]
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        ends = np.r_[starts[1:], len(run)]
        own = low[rows][starts] == high[rows][starts]
        pairs = [np.stack([starts, ends, starts, ends], 1)[own]]
        left = {int(r) // 2: n for n, r in enumerate(run[starts]) if r % 2 == 0 and not own[n]}
        right = {int(r) // 2: n for n, r in enumerate(run[starts]) if r % 2 == 1}
        meet = [(starts[left[g]], ends[left[g]], starts[n], ends[n]) for g, n in right.items() if g in left]
        if meet:
            pairs.append(np.array(meet))
        member, root = spanning(keys, np.concatenate(pairs), orders[h][3], budget)
        if len(member):
            original = _fp(keys, orders[h]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(original[member]), pa.array(original[root])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of (a, b): alternating large and small stars.

    A large star ties every larger neighbour to a node's least neighbour, a
    small star every smaller one, until nothing changes. Each round cuts its
    lineage with a reliable checkpoint, so a lost executor costs one round.
    """
    state = reliable(_directed(edges))
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _directed(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*")
        state = reliable(_directed(small))
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    prints = reliable(fingerprints(docs, words))
    firsts = reliable(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(firsts.select("fp"), distance, chunk))
    rooted = firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    leaders = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(leaders, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
