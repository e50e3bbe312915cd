"""BPE encoding and decoding by a walk over a trie of distinct words.

The words (pre-tokens) of a slice of texts are made distinct and inserted into
a trie. A depth-first walk gives every node, that is every prefix of a word,
its last token: the one token ending there that may follow the last token of
the prefix before it. Prefixes that words share are computed once, and a
word's ids are read back from its node through the chain of last tokens.

Whether two tokens may stand side by side is settled by undoing merges: a pair
is wrong if, at some point of undoing the later merge of the two, the pieces
at the seam form an earlier merge. Only tokens that encode to themselves can
be last tokens.

Words already encoded come from a bounded cache, kept by the Python worker
across tasks; no text is shuffled and nothing is broadcast.

Defined results: null and empty texts have no ids and decode to the empty
text; repeated rows repeat; null ids stay null; an empty table gives an empty
result; other columns are not read. Whole texts are encoded.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from rill.llm.common import WordCache, map_rows, schema

# The splitting pattern of byte-level BPE and its white space.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a worker's cache holds before it starts afresh.
CACHE_WORDS = 200_000
#: Rows whose distinct words share one trie.
SLICE = 512


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _explicit(pattern: str) -> str:
    """White space named character by character, the same in every library."""
    return pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


def _narrow(pattern: str) -> str:
    """The pattern for texts below U+0250, with the letters and digits there spelt out for the faster library."""
    top = range(0x250)
    spans = lambda test: "".join(re.escape(chr(c)) for c in top if test(chr(c)))
    letters, numbers = (spans(lambda c, k=k: bool(regex.fullmatch(rf"\p{{{k}}}", c))) for k in "LN")
    out = _explicit(pattern)
    return out.replace(r"[^" + SPACE + r"\p{L}\p{N}]", f"[^{SPACE}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")


class Splitter:
    """Pre-tokens of a text, special tokens apart."""

    def __init__(self, special: dict[str, int]):
        self.wide, self.narrow = regex.compile(_explicit(PATTERN)).findall, re.compile(_narrow(PATTERN)).findall
        self.beyond = re.compile("[^\x00-ɏ]").search
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None

    def words(self, text: str) -> list[str]:
        return (self.wide if self.beyond(text) else self.narrow)(text)

    def pieces(self, text: str) -> list[list[str] | int]:
        """Lists of pre-tokens, and ids of special tokens between them."""
        if not self.special or not any(s in text for s in self.special):
            return [self.words(text)]
        return [self.special.get(p) if k % 2 else self.words(p) for k, p in enumerate(self.cut(text))]


class PrefixBpe:
    """Vocabulary and merges of a byte-level BPE, and the trie walk."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        as_bytes = lambda t: bytes(letters[c] for c in t)
        # tokens are numbered by rank: bytes first, then merges in their order
        self.bytes = [bytes([b]) for b in range(256)]
        rank = {t: r for r, t in enumerate(self.bytes)}
        self.pair: dict[tuple[int, int], int] = {}
        self.halves = [(r, r) for r in range(256)]
        for left, right in model["merges"]:
            a, b = rank[as_bytes(left)], rank[as_bytes(right)]
            token = self.bytes[a] + self.bytes[b]
            self.pair[a, b] = len(self.bytes)
            rank.setdefault(token, len(self.bytes))
            self.bytes.append(token)
            self.halves.append((a, b))
        ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.id = [ids.get(t, -1) for t in self.bytes]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in special.items()}
        self.token_of_id = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.dtype = np.dtype(np.uint16 if len(by_id) <= 1 << 16 else np.uint32)
        self.decimal = [str(i) for i in range(len(self.token_of_id))]
        self.splitter = Splitter(special)
        self._fits: dict[int, bool] = {}
        # only tokens whose own halves may stand side by side up to their merge encode to themselves
        self.token = {t: r for r, t in enumerate(self.bytes) if rank[t] == r and (r < 256 or self._own(r))}
        self.lengths = list(map(len, self.bytes))
        # sizes of the tokens that end in some three bytes, longest first; all end in fewer or these
        ends: dict[bytes, set[int]] = {}
        for t in self.token:
            if len(t) >= 3:
                ends.setdefault(t[-3:], set()).add(len(t))
        self.sizes = {e: sorted(n | {1, 2}, reverse=True) for e, n in ends.items()}
        self.cache = WordCache(CACHE_WORDS, self.encode_words)

    def _own(self, r: int) -> bool:
        a, b = self.halves[r]
        return self._seam(a, b, r)

    def _seam(self, a: int, b: int, limit: int) -> bool:
        """May ``a`` stand before ``b``: no merge below ``limit`` forms at the seam while merges are undone."""
        while True:
            merged = self.pair.get((a, b))
            if merged is not None and merged < limit:
                return False
            if a > b:
                limit = a
                a = self.halves[a][1]
                if a == limit:
                    limit, b2 = b + 1, self.halves[b][0]
                    if b2 == b:
                        return True
                    b = b2
            else:
                limit, b2 = b + 1, self.halves[b][0]
                if b2 == b:
                    limit, a2 = a, self.halves[a][1]
                    if a2 == a:
                        return True
                    a = a2
                else:
                    b = b2

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 200_000:
                self._fits.clear()
            known = self._fits[key] = self._seam(a, b, 1 << 30)
        return known

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct words: trie, depth-first last tokens, chains read back.

        The trie is held in preorder: the words sorted by bytes, each sharing
        a path with the one before. ``last`` is the state of the path walked:
        the last token of each prefix. Stepping to the next word goes back to
        the node both share and on down the new branch.
        """
        out: dict[str, bytes] = {}
        pack = self.dtype.char
        token, known, fits, sizes = self.token, self._fits, self.fits, self.sizes
        lengths, ids, few = self.lengths, self.id, (2, 1)
        last, path = [0], b""
        for word, w in sorted((w.encode(), w) for w in words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1:]
            for n in range(shared + 1, len(word) + 1):
                for size in sizes.get(word[n - 3:n], few) if n > 2 else few:
                    if size > n:
                        continue
                    t = token.get(word[n - size:n])
                    if t is None:
                        continue
                    if size == n:
                        break
                    before = last[n - size]
                    ok = known.get(before << 20 | t)
                    if ok or ok is None and fits(before, t):
                        break
                last.append(t)
            path, at, found = word, len(word), []
            while at:
                t = last[at]
                found.append(ids[t])
                at -= lengths[t]
            found.reverse()
            out[w] = array(pack, found).tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        split = [self.splitter.pieces(t) if t else [] for t in texts]
        values = iter(self.cache.values([p for pieces in split for p in pieces if isinstance(p, list)]))
        out = []
        for pieces in split:
            ids: list[int] = []
            for p in pieces:
                ids += [p] if isinstance(p, int) else np.frombuffer(b"".join(next(values)), dtype=self.dtype).tolist()
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_of_id.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> PrefixBpe:
    """One per worker process and vocabulary, with its cache."""
    return PrefixBpe(path)


def encode(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row. ``vocab`` is read on every worker."""

    def make():
        bpe = tokenizer(vocab)
        return lambda keys, texts: list(zip(keys, bpe.encode(texts)))

    return map_rows(docs.select(id_col, text_col), make, schema("doc_id long,ids ints"), SLICE)


def decode(tokens: DataFrame, vocab: str) -> DataFrame:
    """(doc_id, text) of rows of (doc_id, ids)."""

    def make():
        bpe = tokenizer(vocab)
        return lambda keys, ids: [(k, bpe.decode(x or [])) for k, x in zip(keys, ids)]

    return map_rows(tokens.select("doc_id", "ids"), make, schema("doc_id long,text string"))


def round_trip(docs: DataFrame, vocab: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, in one pass."""

    def make():
        bpe = tokenizer(vocab)
        sha = lambda x: hashlib.sha256(x).hexdigest()

        def f(keys, texts):
            return [
                (k, len(ids), sha(",".join(map(bpe.decimal.__getitem__, ids)).encode()), sha(bpe.decode(ids).encode()))
                for k, ids in zip(keys, bpe.encode(texts))
            ]

        return f

    return map_rows(docs.select("doc_id", "text"), make, schema("doc_id long,n_tokens long,ids_sha256 string,decoded_sha256 string"), SLICE)
