"""Alignment of two tokenizations of the same texts by lockstep merging.

Each text is encoded by a byte-level BPE (A) and a piece model (B). Both cut
the same bytes, so their tokens are matched by walking the two lists of byte
ends together. All documents of a block advance at once: a NumPy state vector
holds one A and one B pointer each; a step links every pair under the
pointers, cuts where both tokens end, moves the pointer with the smaller end
(both at a cut) and drops finished documents from the state. A long document
enters as several lanes of ``LANE`` A tokens, whose B pointers are found by
bisection, so the number of steps does not grow with its length.

Counts over the corpus never meet in one place: a block emits its distinct
pairs with the number of its documents holding them; these are added up per
pair, joined back to the blocks' pairs and returned to the blocks, one row for
each distinct pair of a block instead of one for each link. A pair's highest
count per A id has at most one row per vocabulary entry, so it may be broadcast.

Defined results: texts that are null, empty, or whose joined token bytes of A
or B differ from a space and the text have no tokens, zeros and the empty
digest; repeated rows are documents of their own, null ids stay null; equal
highest counts all count as best; an empty table gives an empty result; other
columns are not read. Texts are encoded whole; names of special tokens in them
are plain text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rill.llm.bpe import PATTERN, byte_letters
from rill.llm.common import SLICE_ROWS, let_workers_import, reliable, schema

#: A tokens and rows after which a block is closed: what one task holds at a time, beside its largest text.
BLOCK_TOKENS, BLOCK_ROWS = 1 << 20, 1 << 14
#: A tokens of one lane of the state vector.
LANE = 256

BLOCK = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int32())), ("n_b", pa.list_(pa.int32())),
    ("a", pa.binary()), ("b", pa.binary()),
])
BLOCK_DDL = "block long, doc_ids array<long>, n_a array<int>, n_b array<int>, a binary, b binary"


@dataclass
class Vocabulary:
    """Token bytes by id, their lengths, and the smallest integer type of the ids."""

    tokens: list[bytes]

    def __post_init__(self):
        self.lengths = np.array(list(map(len, self.tokens)), dtype=np.int64)
        self.dtype = np.dtype("<u2" if len(self.tokens) <= 1 << 16 else "<u4")


class TokenizerPair:
    """Both tokenizers with their vocabularies."""

    def __init__(self, byte_bpe: str, pieces: str):
        with open(byte_bpe, encoding="utf-8") as f:
            spec = json.load(f)
        letters, special = byte_letters(), {t["content"] for t in spec["added_tokens"]}
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ranks = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        made = [ranks[as_bytes(x) + as_bytes(y)] for x, y in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"ids of {byte_bpe} do not follow the order of its merges")
        self.encode_a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        by_id = {i: t for t, i in ranks.items()}
        self.a = Vocabulary([by_id.get(i, b"") for i in range(max(by_id) + 1)])
        self.sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        piece = self.sp.id_to_piece
        self.b = Vocabulary([
            bytes([int(piece(i)[3:5], 16)]) if self.sp.is_byte(i) else piece(i).replace("▁", " ").encode()
            for i in range(self.sp.get_piece_size())
        ])

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and B of each text; none where either does not give the text's bytes."""
        there = [t for t in texts if t]
        second = iter(self.sp.encode(there, num_threads=1) if there else [])
        out = []
        for text in texts:
            a, b = (self.encode_a(" " + text), next(second)) if text else ([], [])
            raw = (" " + text).encode() if text else b""
            same = all(b"".join(map(v.tokens.__getitem__, ids)) == raw for v, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if same else ([], []))
        return out


@lru_cache(maxsize=2)
def tokenizers(byte_bpe: str, pieces: str) -> TokenizerPair:
    """One per worker process and pair of files."""
    return TokenizerPair(byte_bpe, pieces)


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A index, B index) in order, and which of them are cuts.

    ``a_end`` and ``b_end`` are byte ends over all documents laid end to end;
    ``a_first`` has each document's first A token, and the number of A tokens.
    """
    sizes = np.diff(a_first)
    lanes = -(-sizes // lane)
    total = int(lanes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    inner = np.arange(total) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    pa_ = np.repeat(a_first[:-1], lanes) + inner * lane
    stop = np.minimum(pa_ + lane, np.repeat(a_first[1:], lanes))
    starts = np.concatenate([[0], a_end])[pa_]
    pb = np.searchsorted(b_end, starts, side="right")
    # the sum of both pointers grows along a document and over documents: each link's place
    link_b = np.full(len(a_end) + len(b_end), -1, dtype=np.int64)
    is_cut = np.zeros(len(link_b), dtype=bool)
    while len(pa_):
        ea, eb = a_end[pa_], b_end[pb]
        place = pa_ + pb
        link_b[place] = pb
        is_cut[place] = ea == eb
        pb = pb + (eb <= ea)
        pa_ = pa_ + (ea <= eb)
        alive = pa_ < stop
        if not alive.all():
            pa_, pb, stop = pa_[alive], pb[alive], stop[alive]
    places = np.flatnonzero(link_b >= 0)
    found = link_b[places]
    return places - found, found, is_cut[places]


class Block:
    """One block's tokens, aligned."""

    def __init__(self, row: dict, a: Vocabulary, b: Vocabulary):
        self.doc_ids, self.width = row["doc_ids"], len(b.tokens)
        self.n_a, self.n_b = (np.array(row[c], dtype=np.int64) for c in ("n_a", "n_b"))
        self.a, self.b = (
            np.frombuffer(pa.decompress(row[c], int(n.sum()) * v.dtype.itemsize, "zstd"), dtype=v.dtype).astype(np.int64)
            for c, n, v in (("a", self.n_a, a), ("b", self.n_b, b))
        )
        self.a_first, self.b_first = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        self.a_end, self.b_end = np.cumsum(a.lengths[self.a]), np.cumsum(b.lengths[self.b])
        self.link_a, self.link_b, self.is_cut = lockstep(self.a_end, self.b_end, self.a_first)
        self.doc = np.searchsorted(self.a_first, self.link_a, side="right") - 1  # of each link
        self.key = self.a[self.link_a] * self.width + self.b[self.link_b]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pair keys and the number of the block's documents that hold each."""
        bits = max(1, len(self.doc_ids)).bit_length()
        held = np.unique(self.key << bits | self.doc) >> bits
        first = np.flatnonzero(np.diff(held, prepend=-1))
        return held[first], np.diff(np.append(first, len(held)))

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a link column over each document, exact."""
        total = np.concatenate([[0], np.cumsum(values)])
        at = np.searchsorted(self.doc, np.arange(len(self.doc_ids) + 1))
        return total[at[1:]] - total[at[:-1]]

    def groups(self, written: list[bytes], size_a: int) -> Iterator[bytes]:
        """Each document's groups as text: ``a1,a2|b1;a3|b2``.

        ``written`` has every id's decimals four times: A before a comma and
        before a bar, B before a comma and before a semicolon.
        """
        last_a, last_b = (np.zeros(len(x), dtype=bool) for x in (self.a, self.b))
        last_a[self.link_a[self.is_cut]] = True
        last_b[self.link_b[self.is_cut]] = True
        # a token stands behind all tokens of its own list before it and the other list's of the groups before (A) or up to it (B)
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        codes[np.arange(len(self.a)) + np.concatenate([[0], ends_b])[group_a]] = self.a + size_a * last_a
        codes[np.arange(len(self.b)) + (ends_a[group_b] if len(self.b) else group_b)] = 2 * size_a + self.b + self.width * last_b
        ends = self.a_first + self.b_first
        for lo, hi in zip(ends[:-1], ends[1:]):
            yield b"".join(map(written.__getitem__, codes[lo:hi].tolist()))[:-1]


def encode(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of encoded documents, written once: a few thousand documents a row, ids packed and compressed."""
    let_workers_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(byte_bpe, pieces)
        number, held, tokens = TaskContext.get().partitionId() << 32, [], 0

        def close():
            ids, a, b = zip(*held)
            packed = (pa.compress(b"".join(x), "zstd", asbytes=True) for x in (a, b))
            sizes = ([len(x) // v.dtype.itemsize for x in c] for c, v in ((a, both.a), (b, both.b)))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=f.type) for v, f in zip((number, list(ids), *sizes, *packed), BLOCK)], schema=BLOCK
            )

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = (c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns)
                for i, (a, b) in zip(ids, both.encode(texts)):
                    held.append((i, np.array(a, dtype=both.a.dtype).tobytes(), np.array(b, dtype=both.b.dtype).tobytes()))
                    tokens += len(a)
                    if tokens >= BLOCK_TOKENS or len(held) >= BLOCK_ROWS:
                        yield close()
                        number, held, tokens = number + 1, [], 0
        if held:
            yield close()

    return reliable(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, BLOCK_DDL))


def over_blocks(blocks: DataFrame, byte_bpe: str, pieces: str, make, out: str) -> DataFrame:
    """``make(block number, Block, TokenizerPair)`` gives the Arrow columns of each block."""
    let_workers_import(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(byte_bpe, pieces)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                yield make(one["block"], Block(one, both.a, both.b), both)

    return blocks.mapInArrow(run, out)


def links(blocks: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """(doc_id, a, b, link_a, link_b, cuts) of every document.

    ``a`` and ``b`` are its ids, ``link_a`` and ``link_b`` the places of each
    linked pair in them, ``cuts`` the byte offsets where both tokens end.
    """
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    arrow = pa.schema([("doc_id", pa.int64()), ("a", ints), ("b", ints), ("link_a", ints), ("link_b", ints), ("cuts", longs)])

    def make(_, block: Block, __) -> pa.RecordBatch:
        d = block.doc
        base = np.concatenate([[0], block.a_end])[block.a_first]
        cut = block.is_cut
        columns = (
            (block.a, block.a_first), (block.b, block.b_first),
            (block.link_a - block.a_first[d], None), (block.link_b - block.b_first[d], None),
            (block.a_end[block.link_a[cut]] - base[d[cut]], np.searchsorted(d[cut], np.arange(len(block.doc_ids) + 1))),
        )
        at = np.searchsorted(d, np.arange(len(block.doc_ids) + 1))
        lists = [
            pa.ListArray.from_arrays(pa.array(at if ends is None else ends, type=pa.int32()), pa.array(v, type=f.type.value_type))
            for (v, ends), f in zip(columns, list(arrow)[1:])
        ]
        return pa.RecordBatch.from_arrays([pa.array(block.doc_ids, type=pa.int64()), *lists], schema=arrow)

    kinds = "doc_id long, a array<int>, b array<int>, link_a array<int>, link_b array<int>, cuts array<long>"
    return over_blocks(blocks, byte_bpe, pieces, make, kinds)


def pair_counts(blocks: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """(block, a, b, docs): each block's distinct linked id pairs and how many of its documents hold them."""
    arrow = pa.schema([("block", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])

    def make(number: int, block: Block, _) -> pa.RecordBatch:
        keys, docs = block.pairs()
        columns = (np.full(len(keys), number), keys // block.width, keys % block.width, docs)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return over_blocks(blocks, byte_bpe, pieces, make, "block long, a int, b int, docs long")


def corpus_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n, best): documents of the corpus that hold the pair, and whether no pair of the A id has more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most one row per id of A's vocabulary
    return counts.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def summaries(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    blocks = encode(docs, byte_bpe, pieces)
    pairs = reliable(pair_counts(blocks, byte_bpe, pieces))
    counted = pairs.join(corpus_counts(pairs), ["a", "b"]).select("block", "a", "b", "n", "best")
    out = schema("doc_id long,n_a long,n_b long,n_groups long,n_links long,n_best long,count_sum long,groups_sha256 string")
    names = out.fieldNames()

    def digest(block_rows: pa.Table, counts: pa.Table) -> pa.Table:
        both = tokenizers(byte_bpe, pieces)
        block = Block(block_rows.to_pylist()[0], both.a, both.b)
        column = lambda c, kind: counts.column(c).to_numpy().astype(kind)
        keys = column("a", np.int64) * block.width + column("b", np.int64)
        order = np.argsort(keys)
        at = order[np.searchsorted(keys, block.key, sorter=order)]
        texts = block.groups(_written(byte_bpe, pieces), len(both.a.tokens))
        hashes = [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(texts, block.n_a)]
        values = (
            block.n_a, block.n_b, block.per_doc(block.is_cut), block.per_doc(np.ones(len(block.key), dtype=np.int64)),
            block.per_doc(column("best", bool)[at]), block.per_doc(column("n", np.int64)[at]),
        )
        return pa.table([pa.array(block.doc_ids, type=pa.int64()), *(pa.array(v, type=pa.int64()) for v in values), pa.array(hashes, type=pa.string())], names=names)

    return blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(digest, out)


@lru_cache(maxsize=2)
def _written(byte_bpe: str, pieces: str) -> list[bytes]:
    """Decimals of all ids with the mark that may follow, see ``Block.groups``."""
    both = tokenizers(byte_bpe, pieces)
    return [b"%d%s" % (i, mark) for v, marks in ((both.a, b",|"), (both.b, b",;")) for mark in (marks[:1], marks[1:]) for i in range(len(v.tokens))]
