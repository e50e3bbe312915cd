"""Token-id files with a minimal perfect hash index.

Documents are encoded with a public tokenizer, an end id is appended, and the
ids are written as raw little-endian payloads in ascending key order, one
shard per range partition. A shard is two files in the shared folder:

* ``shard-N.ids``: the ids of its documents one after another, 16 bits each
  if the vocabulary allows, else 32, and nothing else;
* ``shard-N.idx``: a 64-byte header (magic, id width, documents, ids, keys,
  levels), then per document its key, offset and length, then the index: bit
  arrays of the hash levels with their sizes, and per key a 32-bit fingerprint
  and the row of its first document.

The index is a minimal perfect hash by levels: keys hash into a bit array
twice their number, those alone at their bit settle there, the others go on to
the next level; a settled key's slot is the number of bits set before its own.
A lookup costs a few bit tests and one rank, whatever the size; the stored
fingerprint turns foreign keys away and the row's key settles the rest.

A task writes its files under a temporary name and renames them, so a retry
or a second attempt replaces whole files only. Shards and starts travel as a
manifest of one row per shard.

Defined results: null and empty texts are documents of the end id alone;
documents with a null key come first and are not in the index; documents with
the same key stand together, ordered by a hash of their text, and a lookup
returns all of them; an empty table gives no shards; other columns are not
read. Whole texts are encoded.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window, functions as F

from rill.llm.common import WordCache, let_workers_import, map_rows, reliable, schema

MAGIC = b"TOKSHRD1"
HEADER = struct.Struct("<8sIIQQQI20x")
END_ID = 2
#: Pieces that a worker's cache holds before it starts afresh.
CACHE_WORDS = 500_000
#: Pieces of plain letters in one string to encode.
JOINED = 256
#: Bits of a hash level per key that is still unsettled.
LEVEL_BITS = 2
#: Rows encoded together.
SLICE = 512

MANIFEST = "shard long,n_docs long,n_ids long,low long,high long"


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    local = re.sub(r"^file:/+", "/", folder)
    return (pafs.LocalFileSystem(), local) if local.startswith("/") else pafs.FileSystem.from_uri(folder)


# The tokenizer's splitting pattern, spelt out for texts in Latin-1 after lower-casing.
_LETTERS, _NUMBERS, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_RUNS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+").findall
_BEYOND = re.compile("[^\x00-\xff]").search
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


class Encoder:
    """Ids as packed bytes, piece by piece.

    A text in Latin-1 is lower-cased and cut into the tokenizer's own runs;
    any other text, or one that may hold a special token, is cut at ASCII
    white space, which always ends a token. Either way a text's ids are those
    of its pieces one after another, and each distinct piece is encoded once;
    pieces of plain letters go to the library many to a string.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache = WordCache(CACHE_WORDS, self._encode)

    def packed(self, texts: list[str | None]) -> list[bytes]:
        return list(map(b"".join, self.cache.values([_pieces(t) if t else [] for t in texts])))

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        plain: list[str] = []
        others: list[str] = []
        for w in words:
            (plain if _PLAIN(w) else others).append(w)
        for word, e in zip(others, self.tokenizer.encode_batch(others, add_special_tokens=False)):
            found[word] = np.array(e.ids, dtype=self.dtype).tobytes()
        groups = [plain[n:n + JOINED] for n in range(0, len(plain), JOINED)]
        lines = list(map(" ".join, groups))
        width = self.dtype.itemsize
        for group, e in zip(groups, self.tokenizer.encode_batch(lines, add_special_tokens=False)):
            ids, runs = np.array(e.ids, dtype=self.dtype), np.array(e.word_ids)
            starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
            if len(starts) != len(group):
                raise ValueError("a plain word is not one run of this tokenizer")
            raw, edges = ids.tobytes(), (np.r_[starts, len(ids)] * width).tolist()
            found.update(zip(group, [raw[i:j] for i, j in zip(edges, edges[1:])]))
        return found


def _pieces(text: str) -> list[str]:
    if "<|" in text or _BEYOND(text):
        # marked with a leading space, which ends up in no token, to tell them from lower-cased runs
        return [" " + w.decode() for w in text.encode().split()]
    return _RUNS(text.lower())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key and seed."""
    x = keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int]):
        self.levels, self.sizes = levels, sizes  # uint64 words of each level, and its bits
        counts = [np.bitwise_count(words).astype(np.int64) for words in levels]
        self.ranks, base = [], 0
        for c in counts:  # bits set before each word, over all levels
            ends = np.cumsum(c)
            self.ranks.append(np.r_[0, ends[:-1]] + base if len(c) else ends)
            base += int(ends[-1]) if len(c) else 0

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        left, levels, sizes = keys.astype(np.uint64), [], []
        while len(left):
            bits = max(64, -(-LEVEL_BITS * len(left) // 64) * 64)
            at = (_mix(left, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            packed = np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64)
            levels.append(packed)
            sizes.append(bits)
            left = left[~alone[at]]
        return cls(levels, sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for some foreign keys, any slot for the others."""
        keys, out = keys.astype(np.uint64), np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, (words, bits) in enumerate(zip(self.levels, self.sizes)):
            if not len(todo):
                break
            at = (_mix(keys[todo], level) % np.uint64(bits)).astype(np.int64)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[todo[hit]] = self.ranks[level][at[hit] >> 6] + below
            todo = todo[~hit]
        return out


def _paths(root: str, shard: int) -> tuple[str, str]:
    return f"{root}/shard-{shard:06d}.ids", f"{root}/shard-{shard:06d}.idx"


def index_bytes(keys: list[int | None], lengths: list[int], width: int) -> bytes:
    """The index file of a shard whose documents have these keys, in order, and lengths."""
    nulls = sum(k is None for k in keys)
    doc_keys = np.array([0] * nulls + keys[nulls:], dtype="<i8")
    sizes = np.array(lengths, dtype="<u8")
    offsets = (np.cumsum(sizes) - sizes).astype("<u8")
    distinct, first = np.unique(doc_keys[nulls:], return_index=True)
    table = PerfectHash.build(distinct)
    slots = table.slots(distinct)
    prints, rows = np.zeros(len(distinct), dtype="<u4"), np.zeros(len(distinct), dtype="<u8")
    prints[slots], rows[slots] = fingerprint(distinct), first + nulls
    head = HEADER.pack(MAGIC, width, nulls, len(doc_keys), int(sizes.sum()), len(distinct), len(table.sizes))
    levels = b"".join(w.astype("<u8").tobytes() for w in table.levels)
    return b"".join([
        head, np.array(table.sizes, dtype="<u8").tobytes(), doc_keys.tobytes(), offsets.tobytes(), sizes.tobytes(),
        levels, rows.tobytes(), prints.tobytes(),
    ])


class Shard:
    """Keyed and ordered access to one shard's files."""

    def __init__(self, folder: str, number: int):
        self.fs, root = filesystem(folder)
        self.ids_path, idx_path = _paths(root, number)
        with self.fs.open_input_file(idx_path) as f:
            raw = f.read()
        magic, self.width, self.nulls, docs, self.n_ids, n_keys, n_levels = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError(f"{idx_path} is not a token shard index")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        sizes = [int(x) for x in take("<u8", n_levels)]
        self.keys, self.offsets, self.lengths = take("<i8", docs), take("<u8", docs), take("<u8", docs)
        self.table = PerfectHash([take("<u8", s // 64).astype(np.uint64) for s in sizes], sizes)
        self.rows, self.prints = take("<u8", n_keys), take("<u4", n_keys)
        self.dtype = np.dtype(f"<u{self.width}")
        self.payload = self.fs.open_input_file(self.ids_path)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of the first document of each key, -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if len(self.rows):
            slots = self.table.slots(keys)
            ok = slots >= 0
            ok[ok] = self.prints[slots[ok]] == fingerprint(keys[ok])
            rows = self.rows[slots[ok]].astype(np.int64)
            out[ok] = np.where(self.keys[rows] == keys[ok], rows, -1)
        return out

    def ids(self, row: int) -> np.ndarray:
        size = int(self.lengths[row]) * self.width
        return np.frombuffer(self.payload.read_at(size, int(self.offsets[row]) * self.width), dtype=self.dtype)

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document with this key."""
        row, out = int(self.find(np.array([key], dtype=np.int64))[0]), []
        while 0 <= row < len(self.keys) and self.keys[row] == key:
            out.append(self.ids(row))
            row += 1
        return out


def write(docs: DataFrame, folder: str, vocab: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of (doc_id, text); returns the manifest, one row (and partition) per shard.

    Range partitions of the key, sorted inside, become shards in key order.
    The text's hash and the row's number end the range key, so that the many
    rows of one key, or without one, are dealt to several shards.
    """
    order = ["doc_id", "llm_hash", "llm_row"]
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("llm_hash"), F.monotonically_increasing_id().alias("llm_row"))
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    arrow = pa.schema([(n, pa.int64()) for n in ("shard", "n_docs", "n_ids", "low", "high")])
    let_workers_import(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        shard, coder = TaskContext.get().partitionId(), encoder(vocab)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        fs, root = filesystem(folder)
        ids_path, idx_path = _paths(root, shard)
        mark = f".tmp-{uuid.uuid4().hex}"
        keys: list[int | None] = []
        lengths: list[int] = []
        out = None
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    if out is None and part.num_rows:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(ids_path + mark)
                    keys += part.column(0).to_pylist()
                    for packed in coder.packed(part.column(1).to_pylist()):
                        out.write(packed + end)
                        lengths.append(len(packed) // coder.dtype.itemsize + 1)
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        with fs.open_output_stream(idx_path + mark) as f:
            f.write(index_bytes(keys, lengths, coder.dtype.itemsize))
        fs.move(ids_path + mark, ids_path)
        fs.move(idx_path + mark, idx_path)
        real = [k for k in keys if k is not None]
        row = (shard, len(keys), sum(lengths), real[0] if real else None, real[-1] if real else None)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], schema=arrow)

    return reliable(rows.mapInArrow(run, schema(MANIFEST)))


def read(manifest: DataFrame, folder: str, describe) -> DataFrame:
    """One row per document, read back through the index: (doc_id, start, n_tokens, <describe(ids)>).

    ``describe`` turns a document's ids (a numpy array) into a long. ``start``
    counts the ids of all documents before. A task reads one shard.
    """
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select(F.col("shard").alias("s"), F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("before"))
    # one row per shard on either side; the broadcast keeps each manifest row in its own partition
    shards = manifest.join(F.broadcast(starts), F.col("shard") == F.col("s")).select("shard", "before")

    def make():
        def f(numbers, befores):
            out = []
            for number, before in zip(numbers, befores):
                out += _documents(Shard(folder, number), before, describe)
            return out

        return f

    return map_rows(shards, make, schema("doc_id long,start long,n_tokens long,value long"), 1)


def _documents(shard: Shard, before: int, describe) -> list[tuple]:
    """Rows of a shard's documents; keyed ones are found by their key."""
    keys = shard.keys[shard.nulls:]
    distinct, counts = np.unique(keys, return_counts=True)
    firsts = shard.find(distinct)
    if (firsts < 0).any():
        raise ValueError("the index misses keys of its own shard")
    places = [(None, row) for row in range(shard.nulls)]
    places += [(int(k), int(r) + n) for k, r, c in zip(distinct, firsts, counts) for n in range(c)]
    return [
        (key, before + int(shard.offsets[row]), int(shard.lengths[row]), describe(shard.ids(row))) for key, row in places
    ]


def lookup(keys: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, ids) for each row of ``keys`` that has documents: keyed access, no scan of the payloads.

    Shards cover ranges of keys, so a key's shards are found by bisection over
    the manifest (one row per shard).
    """
    ranges = sorted((r["high"], r["low"], r["shard"]) for r in manifest.where("low is not null").collect())
    highs = [r[0] for r in ranges]

    def route():
        def f(ids):
            out = []
            for k in ids:
                at = bisect.bisect_left(highs, k) if k is not None else len(highs)
                while at < len(highs) and ranges[at][1] <= k:
                    out.append((k, ranges[at][2]))
                    at += 1
            return out

        return f

    routed = map_rows(keys.select("doc_id"), route, schema("doc_id long,shard long")).repartition("shard")

    def fetch():
        opened: dict[int, Shard] = {}

        def f(ids, shards):
            out = []
            for k, s in zip(ids, shards):
                if s not in opened:
                    opened.clear()
                    opened[s] = Shard(folder, s)
                out += [(k, x.tolist()) for x in opened[s].get(k)]
            return out

        return f

    return map_rows(routed.sortWithinPartitions("shard", "doc_id"), fetch, schema("doc_id long,ids ints"))


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
