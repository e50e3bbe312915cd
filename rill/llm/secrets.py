"""Secret scans with built-in SQL functions only.

Three fixed kinds are found by pattern. Beside them, candidate strings (long
runs holding letters and digits) are read through a sliding window whose
Shannon entropy is kept up by incremental counts: a step adds one character
and drops one, and only those two terms of the sum change. Windows at or
above the threshold of the candidate's character class (hex or base64) merge
into ``entropy`` spans; candidates on the allow-list give none.

Defined results: null and empty texts have no spans; spans of one kind never
overlap, spans of different kinds may; repeated rows repeat; null ids stay
null; an empty table gives an empty result; other columns are not read, and
``redact`` leaves them as they are. Whole texts are scanned; positions are
code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# The base kinds' patterns, in the order used for ties.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE_MIN = 12
KINDS = ("assign", "access", "hex", "entropy")

# Candidate strings, character classes and the allow-list.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
HEX_ALPHABET = "0123456789abcdef"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
WINDOW = 20
THRESHOLDS = {"hex": 2.95, "base64": 3.85}
ALLOWED = r"(?i)example|sample|dummy|placeholder|changeme|x{4,}|0123456789|abcdefgh|deadbeef"

_RUN = 256  # elements of an inner prefix sum; keeps array building linear


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(values: Column) -> Column:
    """Running sums of an array<int>, inclusive: sums of runs, then inside each run."""

    def scan(xs: Column, base: Column) -> Column:
        out = F.aggregate(
            xs, F.struct(base.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda s, x: let(s["at"] + x, lambda n: F.struct(n.alias("at"), F.concat(s["all"], F.array(n)).alias("all"))),
        )
        return out["all"]

    def runs(xs: Column) -> Column:
        count = F.ceil(F.size(xs) / F.lit(_RUN)).cast("int")
        return let(
            F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(xs, k * _RUN + 1, F.lit(_RUN))),
            lambda parts: let(
                scan(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, b: a + b)), F.lit(0)),
                lambda ends: F.flatten(F.transform(
                    parts, lambda p, k: scan(p, F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1)))
                )),
            ),
        )

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, runs))


def _span(start: Column, end: Column, kind: str) -> Column:
    return F.struct(
        start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("int").alias("end"),
        F.lit(kind).alias("kind"),
    )


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def located(text: Column, pattern: str, hits: Column) -> Column:
    """array<struct<start, hit>> of all matches: gap and match lengths added up."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return let(F.struct(gaps.alias("g"), hits.alias("h")), lambda v: let(
        prefix_sums(F.transform(v["h"], lambda x, k: F.get(v["g"], k) + F.length(x))),
        lambda ends: F.zip_with(ends, v["h"], lambda e, h: F.struct((e - F.length(h)).alias("start"), h.alias("hit"))),
    ))


def _guarded(text: Column, pattern: str, found: Column) -> Column:
    return F.when(text.rlike(pattern), found).otherwise(_none())


def assign_spans(text: Column) -> Column:
    """Short values are matched too, as they use up their place, and dropped after."""
    whole, value = (F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(k)) for k in (0, 2))
    long_enough = F.zip_with(
        located(text, ASSIGN, whole), value,
        lambda m, v: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["hit"])).alias("end"), F.length(v).alias("n")),
    )
    kept = F.filter(long_enough, lambda m: m["n"] >= ASSIGN_VALUE_MIN)
    return _guarded(text, ASSIGN, F.transform(kept, lambda m: _span(m["start"], m["end"], "assign")))


def run_spans(text: Column, pattern: str, kind: str) -> Column:
    found = located(text, pattern, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return _guarded(text, pattern, F.transform(
        found, lambda m: _span(m["start"], m["start"] + F.length(m["hit"]), kind)
    ))


def _term(c: Column) -> Column:
    return F.when(c <= 1, F.lit(0.0)).otherwise(c * F.log2(c.cast("double")))


def _windows(chars: Column, alphabet: str, threshold: float) -> Column:
    """Merged [from, to) ranges of the windows at or above ``threshold``, by one pass over the characters."""
    need = WINDOW * (math.log2(WINDOW) - threshold) + 1e-9  # entropy >= threshold, as a bound on the sum
    codes = F.transform(chars, lambda c: F.instr(F.lit(alphabet), c) - 1)
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("at"),
        F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.array().cast("array<struct<lo:int,hi:int>>").alias("done"),
    )

    def step(codes_: Column):
        def one(s: Column, new: Column) -> Column:
            old = F.when(s["at"] >= WINDOW, F.get(codes_, s["at"] - WINDOW)).otherwise(F.lit(-1))

            def drop(o: Column) -> Column:
                gone = F.when(o < 0, F.lit(0.0)).otherwise(
                    _term(F.get(s["counts"], o) - 1) - _term(F.get(s["counts"], o))
                )
                fewer = F.when(o < 0, s["counts"]).otherwise(
                    F.transform(s["counts"], lambda c, k: F.when(k == o, c - 1).otherwise(c))
                )
                return let(F.struct(fewer.alias("c"), (s["total"] + gone).alias("t")), add)

            def add(v: Column) -> Column:
                more = F.transform(v["c"], lambda c, k: F.when(k == new, c + 1).otherwise(c))
                total = v["t"] + _term(F.get(v["c"], new) + 1) - _term(F.get(v["c"], new))
                return let(total, lambda t: close(more, t, (s["at"] + 1 >= WINDOW) & (t <= need)))

            def close(counts: Column, total: Column, high: Column) -> Column:
                lo = s["at"] + 1 - WINDOW
                apart = high & (lo > s["hi"]) & (s["hi"] >= 0)
                return F.struct(
                    counts.alias("counts"), total.alias("total"), (s["at"] + 1).alias("at"),
                    F.when(high & ((s["hi"] < 0) | (lo > s["hi"])), lo).otherwise(s["lo"]).alias("lo"),
                    F.when(high, s["at"] + 1).otherwise(s["hi"]).alias("hi"),
                    F.when(apart, F.concat(s["done"], F.array(F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")))))
                    .otherwise(s["done"]).alias("done"),
                )

            return let(old, drop)

        return one

    def finish(s: Column) -> Column:
        last = F.array(F.struct(s["lo"].alias("lo"), s["hi"].alias("hi")))
        return F.when(s["hi"] < 0, s["done"]).otherwise(F.concat(s["done"], last))

    return let(codes, lambda c: F.aggregate(c, start, step(c), finish))


def unlisted(found: Column) -> Column:
    """Parts of the candidates between strings of the allow-list that hold a window: array<struct<start, part, hex>>.

    A window overlaps no allowed string if and only if it lies in one part.
    """
    def parts(m: Column) -> Column:
        is_hex = m["hit"].rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")
        part = lambda at, text: F.struct((m["start"] + at).cast("int").alias("start"), text.alias("part"), is_hex.alias("hex"))
        listed = located(m["hit"], ALLOWED, F.regexp_extract_all(m["hit"], F.lit(ALLOWED), F.lit(0)))
        cut = let(F.transform(listed, lambda x: x["start"] + F.length(x["hit"])), lambda ends: F.transform(
            F.split(m["hit"], ALLOWED, -1), lambda g, k: part(F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1)), g)
        ))
        return F.when(m["hit"].rlike(ALLOWED), cut).otherwise(F.array(part(F.lit(0), m["hit"])))

    return F.filter(F.flatten(F.transform(found, parts)), lambda p: F.length(p["part"]) >= WINDOW)


def entropy_spans(text: Column) -> Column:
    found = located(text, CANDIDATE, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    mixed = F.filter(found, lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]"))

    def of(p: Column) -> Column:
        chars = F.split(p["part"], "")
        ranges = F.when(p["hex"], _windows(F.transform(chars, F.lower), HEX_ALPHABET, THRESHOLDS["hex"])).otherwise(
            _windows(chars, BASE64_ALPHABET, THRESHOLDS["base64"])
        )
        return F.transform(ranges, lambda r: _span(p["start"] + r["lo"], p["start"] + r["hi"], "entropy"))

    return _guarded(text, CANDIDATE, F.flatten(F.transform(unlisted(mixed), of)))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of spans by start and kind; ``spans`` has the entropy ones too."""
    text = F.col("llm_text")
    found = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("llm_text")).select(
        id_col,
        F.concat(assign_spans(text), run_spans(text, ACCESS, "access"), run_spans(text, HEX, "hex")).alias("base"),
        entropy_spans(text).alias("more"),
    )
    return found.select(id_col, F.sort_array("base").alias("base"), F.sort_array(F.concat("base", "more")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``; overlapping spans of the text merge and become ``mark``."""
    text = F.col(text_col)

    def merge(spans: Column) -> Column:
        return F.aggregate(
            spans, F.array().cast("array<struct<lo:int,hi:int>>"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["hi"] >= s["start"]),
                F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                    F.try_element_at(done, F.lit(-1))["lo"].alias("lo"),
                    F.greatest(F.try_element_at(done, F.lit(-1))["hi"], s["end"]).alias("hi"),
                ))),
            ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("lo"), s["end"].alias("hi"))))),
        )

    def cut(ranges: Column) -> Column:
        before = F.transform(ranges, lambda r, k: let(
            F.when(k == 0, F.lit(0)).otherwise(F.get(ranges, k - 1)["hi"]),
            lambda at: F.substring(text, at + 1, r["lo"] - at),
        ))
        tail = F.substring(text, F.try_element_at(ranges, F.lit(-1))["hi"] + 1, F.length(text))
        return F.array_join(F.concat(before, F.array(tail)), mark)

    spans = F.sort_array(F.concat(
        assign_spans(text), run_spans(text, ACCESS, "access"), run_spans(text, HEX, "hex"), entropy_spans(text)
    ))
    any_kind = text.rlike(ASSIGN) | text.rlike(HEX) | text.rlike(ACCESS) | text.rlike(CANDIDATE)
    clean = let(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(let(merge(s), cut)))
    out = docs.withColumn(text_col, F.when(any_kind, clean).otherwise(text))
    if length_col in docs.columns:
        changed = F.length(F.col(text_col)).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col(length_col).isNull(), F.col(length_col)).otherwise(changed))
    return out
