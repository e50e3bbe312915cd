"""Toxicity by a weighted lexicon.

The lexicon is learned from labelled documents: a term is a word, or the
first letters of one, and its weight is the log-odds of a toxic document among
those holding it. Scoring folds homoglyphs and digit substitutions, finds all
terms in one Aho-Corasick pass, drops hits inside exception phrases, divides
the summed weights by a power of the length and maps the quotient to 0..1.

Defined results: a null or empty text has no hits and gets the score of "no
hit"; repeated rows and ties get equal scores, as a score depends on the text
alone; a null ``doc_id`` is in the training split (its checksum is null) but
never has a label; with no toxic or no clean training row the lexicon is empty
and every score is 0; an empty table gives an empty result; other columns are
never read. Texts are scored whole.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rill.llm.common import SLICE_ROWS, let_workers_import, map_rows, reliable, schema

# Look-alike letters and digit substitutions, folded before matching.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "ү": "y", "ь": "b",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "զ": "q",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʟ": "l", "ɴ": "n", "ʀ": "r", "ꜱ": "s", "ᴜ": "u", "ᴠ": "v", "ø": "o", "ł": "l", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
}
# Harmless phrases whose words would otherwise count; more are learned.
EXCEPTIONS = ("clown fish", "clown car", "trash can", "trash bin", "pathetic fallacy", "pond scum")

#: Longest learned word beginning, in letters; shorter ones down to PREFIX_MIN.
PREFIX_MIN, PREFIX_MAX = 4, 6
#: At most about so many labelled rows of each class are used to learn.
SAMPLE_PER_CLASS = 6_000
#: Training documents that must hold a term, and its least weight.
MIN_DOCS, MIN_WEIGHT = 3, 2.0
#: Letters of the shortest term, a whole word.
SHORTEST = 3
#: Chosen terms after which a training document asks for no more.
DEMAND = 8
#: Powers of the length tried by the fit.
POWERS = (0.05, 0.1, 0.25, 0.5)

_FOLD = str.maketrans({k: v for k, v in LOOK_ALIKES.items() if k.isalpha()})
_SIGNS = str.maketrans({k: v for k, v in LOOK_ALIKES.items() if not k.isalpha()})
#: Runs of digits and signs beside a letter; they are folded if all of them stand for letters.
_BESIDE = re.compile(r"(?<=[^\W\d_])[0-9@$]+|[0-9@$]+(?=[^\W\d_])")
#: Marks without width: soft hyphens, joiners, direction marks, variation selectors.
_NO_WIDTH = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff]")
_GAP = re.compile(r"[\W_]+")
SCORES = "doc_id long,score double,n_hits long"


@dataclass
class Lexicon:
    """A fitted scorer: plain values, small enough to travel with each task."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    power: float = 0.1
    slope: float = 1.0
    offset: float = 0.0

    def matcher(self) -> "Matcher":
        return Matcher(self)


def fold(text: str | None) -> str:
    """Lower case, look-alikes replaced, every gap one space, a space around.

    Letters of other widths and styles become plain ones (NFKC) and marks
    without width go. Digits and signs count as letters only beside a letter
    and only if the whole run of them stands for letters: numbers stay numbers.
    """
    if not text:
        return "  "
    if not text.isascii():
        text = _NO_WIDTH.sub("", unicodedata.normalize("NFKC", text)).lower().translate(_FOLD)
    else:
        text = text.lower()
    plain = _BESIDE.sub(_letters, text)
    return f" {_GAP.sub(' ', plain)} "


def _letters(run: re.Match) -> str:
    out = run[0].translate(_SIGNS)
    return out if out.isalpha() else run[0]


class Matcher:
    """One automaton over the lexicon and its exception phrases."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.machine = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            self.machine.add_word(term, (len(term), weight, False))
        for phrase in lexicon.exceptions:
            self.machine.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        if len(self.machine):
            self.machine.make_automaton()

    def hits(self, folded: str) -> list[float]:
        """Weights of the words hit: the largest of each word's terms."""
        if not len(self.machine):
            return []
        best: dict[int, float] = {}
        shielded: list[tuple[int, int]] = []
        for end, (size, weight, exception) in self.machine.iter(folded):
            start = end - size + 1
            if exception:
                shielded.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if shielded:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in shielded)}
        return list(best.values())

    def evidence(self, text: str | None) -> tuple[float, int, int]:
        """(summed weights, hits, words) of one text."""
        folded = fold(text)
        found = self.hits(folded)
        return sum(found), len(found), max(0, folded.count(" ") - 1)

    def score(self, text: str | None) -> tuple[float, int]:
        total, n, words = self.evidence(text)
        if not self.lexicon.terms:
            return 0.0, 0
        x = self.lexicon.slope * normalised(total, words, self.lexicon.power) + self.lexicon.offset
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, x)))), n


def normalised(total: float, words: int, power: float) -> float:
    return total / (1.0 + words / 100.0) ** power


def terms_of(text: str | None) -> set[str]:
    """Candidate terms of a text: `` word `` and `` begin``nings of its words."""
    out = set()
    for w in set(fold(text).split()):
        if len(w) >= 3:
            out.add(f" {w} ")
        for n in range(PREFIX_MIN, min(len(w), PREFIX_MAX) + 1):
            out.add(f" {w[:n]}")
    return out


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 marks the held-out part."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """About ``per_class`` labelled training rows of each class, chosen by hash: (text, toxic)."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(remainder(F.col("doc_id")) != 0)
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*(F.lit(x) for k in (0, 1) for x in (k, min(1.0, per_class / max(1, sizes.get(k, 0))))))
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    picked = known.where(hashed < share[F.col("toxic")]).withColumnRenamed("doc_id", "llm_id")
    # at most about 2 * per_class ids and flags: a proven bound
    texts = docs.select(F.col("doc_id").alias("llm_doc"), F.col("text").alias("llm_text"))
    joined = texts.join(F.broadcast(picked), F.col("llm_doc") == F.col("llm_id"))
    # one row of each id, whatever repeats: partial minima per task
    one = joined.groupBy("llm_id", "toxic").agg(F.min_by("llm_text", F.struct(F.xxhash64("llm_text"), F.length("llm_text"))).alias("text"))
    return one.select("text", F.col("toxic").cast("int").alias("toxic"))


def _count_terms():
    def count(texts, flags):
        toxic, clean = Counter(), Counter()
        for text, flag in zip(texts, flags):
            (toxic if flag else clean).update(terms_of(text))
        return [(t, toxic[t], clean[t]) for t in toxic.keys() | clean.keys()]

    return count


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Lexicon:
    """Learn a lexicon from the training part of ``labels``.

    Spark counts the terms of the sampled rows. Terms that are frequent and
    telling enough are candidates, given how many were tried; the bounded
    sample bounds them. A greedy pass over all of them keeps those that mark
    toxic rows not yet marked often enough, so that the many words of copied
    documents stay out.
    """
    rows = reliable(sample(docs, labels, per_class).distinct())
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon()
    counts = map_rows(rows, _count_terms, schema("term string,toxic long,clean long"))
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = reliable(counts.where(F.col("toxic") >= MIN_DOCS))
    tried = counts.count()
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    # log-likelihood gain of the term's own rate over the base rate; chance gives the log of the terms tried
    n, base = F.col("toxic") + F.col("clean"), n_toxic / (n_toxic + n_clean)
    gain = F.col("toxic") * F.log(F.col("toxic") / n / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - base))
    ).otherwise(F.lit(0.0))
    candidates = (
        counts.withColumn("weight", F.round(weight, 6)).withColumn("gain", F.round(gain, 6))
        .where((F.col("weight") >= MIN_WEIGHT) & (F.col("gain") >= math.log(max(2, tried))))
        .select("term", "weight").collect()
    )
    weights = {r["term"]: r["weight"] for r in candidates}
    held = map_rows(rows, lambda: lambda texts, flags: [
        (sorted(t for t in terms_of(x) if t in weights), f) for x, f in zip(texts, flags)
    ], _held_schema()).where("toxic = 1").collect()
    lexicon = Lexicon(cover([set(r["terms"]) for r in held], weights))
    lexicon.exceptions = tuple(sorted({*EXCEPTIONS, *learned_exceptions(rows, lexicon)}))
    return calibrate(rows, lexicon)


def _held_schema():
    from pyspark.sql import types as T

    return T.StructType().add("terms", T.ArrayType(T.StringType())).add("toxic", T.IntegerType())


def cover(docs: list[set[str]], weights: dict[str, float]) -> dict[str, float]:
    """Greedy choice: the term with the largest weight times open documents, until few are left.

    A document closes once ``DEMAND`` chosen terms mark it. Beginnings of one
    word count as one term: a chosen one takes the place of those it contains
    or extends.
    """
    left = Counter(t for d in docs for t in d)
    holders: dict[str, list[int]] = {}
    for i, d in enumerate(docs):
        for t in d:
            holders.setdefault(t, []).append(i)
    stems: dict[str, set[str]] = {}  # terms by their first letters: those that one beginning contains or extends
    for t in left:
        stems.setdefault(t.strip()[:SHORTEST], set()).add(t)
    marks, chosen = [0] * len(docs), {}
    # of equally good terms the longer one, which says more; worth only falls, so an old entry is put back with its new one
    order = lambda t: (-left[t] * weights[t], -len(t), _Falling(t))
    queue = [(order(t), t) for t in left]
    heapq.heapify(queue)
    while queue:
        known, term = heapq.heappop(queue)
        if term not in left:
            continue
        if (now := order(term)) != known:
            heapq.heappush(queue, (now, term))
            continue
        if left[term] < MIN_DOCS:
            break
        chosen[term] = weights[term]
        for i in holders[term]:
            marks[i] += 1
            if marks[i] == DEMAND:
                left.subtract(t for t in docs[i] if t in left)
        stem = term.strip()
        for t in [t for t in stems[stem[:SHORTEST]] if t.strip().startswith(stem) or stem.startswith(t.strip())]:
            left.pop(t, None)
            stems[stem[:SHORTEST]].discard(t)
    return chosen


class _Falling(str):
    """Text in falling order."""

    def __lt__(self, other: str) -> bool:
        return str.__gt__(self, other)


def learned_exceptions(rows: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Pairs of words around a hit that ``MIN_DOCS`` or more clean sampled rows hold and no toxic one."""
    def make():
        m = lexicon.matcher()
        known: dict[str, bool] = {}

        def hit(word: str) -> bool:
            if word not in known:
                if len(known) > 200_000:
                    known.clear()
                known[word] = bool(m.hits(f" {word} "))
            return known[word]

        def count(texts, flags):
            out = []
            for text, flag in zip(texts, flags):
                words = fold(text).split()
                pairs = {f"{a} {b}" for a, b in zip(words, words[1:]) if hit(a) or hit(b)}
                out += [(p, int(flag == 1), int(flag == 0)) for p in pairs]
            return out

        return count

    pairs = map_rows(rows, make, schema("pair string,toxic long,clean long"))
    pairs = pairs.groupBy("pair").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return tuple(sorted(r["pair"] for r in pairs.where((F.col("toxic") == 0) & (F.col("clean") >= MIN_DOCS)).collect()))


def calibrate(rows: DataFrame, lexicon: Lexicon) -> Lexicon:
    """Fit slope, offset and length power on the sampled rows by Newton steps."""
    import numpy as np

    def evidence():
        m = lexicon.matcher()
        return lambda texts, flags: [(*m.evidence(t)[::2], f) for t, f in zip(texts, flags)]

    got = map_rows(rows, evidence, schema("total double,words long,toxic int")).collect()
    data = np.array([(r["total"], r["words"], r["toxic"]) for r in got], dtype=float)
    data = data[np.lexsort(data.T)]
    y, best = data[:, 2], None
    for power in POWERS:
        x = data[:, 0] / (1.0 + data[:, 1] / 100.0) ** power
        X, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
        balance = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
            grad = X.T @ (balance * (p - y)) + 1e-4 * w
            hess = (X * (balance * p * (1 - p))[:, None]).T @ X + 1e-4 * np.eye(2)
            w = w - np.linalg.solve(hess, grad)
        p = np.clip(1 / (1 + np.exp(-np.clip(X @ w, -30, 30))), 1e-9, 1 - 1e-9)
        loss = -(balance * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        if best is None or loss < best[0]:
            best = (loss, power, w)
    return Lexicon(lexicon.terms, lexicon.exceptions, best[1], float(best[2][0]), float(best[2][1]))


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_hits) of every row; one pass, no shuffle."""

    def make():
        m = lexicon.matcher()
        return lambda ids, texts: [(i, *m.score(t)) for i, t in zip(ids, texts)]

    return map_rows(docs.select(id_col, text_col), make, schema(SCORES))


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The rows scored below ``threshold``, with all their columns unchanged."""
    at = docs.columns.index("text")
    let_workers_import(docs.sparkSession)

    def run(batches):
        m = lexicon.matcher()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                keep = [m.score(t)[0] < threshold for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
