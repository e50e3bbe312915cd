"""License scans: one Aho-Corasick pass and a parser for license expressions.

Texts are lower-cased (A-Z) and cut into words; an automaton over identifier
tags and notice phrases finds all places where their words stand in a row.
What follows an identifier tag that the automaton found, on its line or, if
that ends there, the next one, is read as a license expression, up to the next tag:
a shunting-yard parser orders ``and``, ``or``, ``with`` and parentheses, and
the evaluation gives the labels and how far the terms restrict reuse: ``and``
takes the stricter side, ``or`` the milder, ``with`` an exception that softens;
``/`` between identifiers counts as ``or``, a comma as ``and``.

Defined results: null and empty texts have no words, labels or places and
score 0; an expression that cannot be parsed counts as all its identifiers
joined by ``and``; repeated rows repeat, null ids stay null; an empty table
gives an empty result; other columns are not read. Whole texts are read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from rill.llm.common import map_rows, schema

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# Identifier tags, after which an expression stands on the line.
TAGS = ("spdx license identifier", "license expression")
# Beginnings of license identifiers, the label each stands for; the longest match counts.
IDENTIFIERS = {
    "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "isc": "isc",
    "mpl": "mpl", "epl": "epl", "bsl": "bsl", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc",
    "cc0": "public-domain", "unlicense": "public-domain", "0bsd": "bsd",
}
LONGEST = max(map(len, IDENTIFIERS))
# How far each label restricts reuse; others count as UNKNOWN.
RESTRICTION = {
    "public-domain": 0.05, "mit": 0.1, "isc": 0.1, "bsd": 0.15, "bsl": 0.15, "apache": 0.2, "cc-by": 0.25,
    "epl": 0.45, "mpl": 0.45, "lgpl": 0.55, "cc-by-sa": 0.6, "gpl": 0.75, "cc-by-nc": 0.8, "agpl": 0.85,
    "all-rights-reserved": 1.0,
}
UNKNOWN, EXCEPTION_FACTOR = 0.5, 0.8

# words are runs of digits, letters and everything beyond ASCII; here byte by byte
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: What may stand between a tag and its expression; on the way, one line end.
_BEFORE = re.compile(r"[ \t:=\"'`*>#-]*(?:\r?\n[ \t:=\"'`*>#/-]*)?")
_TOKEN = re.compile(r"[(),/]|[A-Za-z0-9.+:-]+|\S")
_SIGN = {"/": "or", ",": "and"}
#: The same words in the text itself.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_STRENGTH = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """The family label of an identifier; itself in lower case if unknown."""
    name = identifier.lower().rstrip("+")
    for n in range(min(len(name), LONGEST), 0, -1):
        if name[:n] in IDENTIFIERS and (n == len(name) or not name[n].isalpha()):
            return IDENTIFIERS[name[:n]]
    return name


def tokens_of(line: str) -> list[str]:
    """The expression at the beginning of a line: up to where operands and operators stop taking turns."""
    out, operand, depth = [], True, 0
    for found in _TOKEN.finditer(line):
        t = _SIGN.get(found[0], found[0])
        low = t.lower()
        if t == "(" and operand:
            depth += 1
        elif t == ")" and depth and not operand:
            depth -= 1
        elif low in _STRENGTH and not operand:
            operand = True
        elif operand and re.fullmatch(r"[A-Za-z0-9.+:-]+", t) and low not in _STRENGTH:
            operand = False
        else:
            break
        out.append(t)
    return out


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: operands and operators in order of evaluation; None if malformed."""
    out: list[str] = []
    held: list[str] = []
    for t in tokens:
        low = t.lower()
        if low in _STRENGTH:
            while held and held[-1] != "(" and _STRENGTH[held[-1]] >= _STRENGTH[low]:
                out.append(held.pop())
            held.append(low)
        elif t == "(":
            held.append(t)
        elif t == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            out.append("=" + t)
    while held:
        if (op := held.pop()) == "(":
            return None
        out.append(op)
    return out


def evaluate(line: str) -> tuple[set[str], float] | None:
    """Labels and restriction of the expression that a line begins with."""
    tokens = tokens_of(line)
    names = [t for t in tokens if t not in "()" and t.lower() not in _STRENGTH]
    if not names:
        return None
    steps: list[tuple[set[str], float]] = []
    ordered = postfix(tokens)
    try:
        for t in ordered or [None]:
            if t.startswith("="):
                label = label_of(t[1:])
                steps.append(({label}, RESTRICTION.get(label, UNKNOWN)))
                continue
            right, left = steps.pop(), steps.pop()
            if t == "with":
                steps.append((left[0], left[1] * EXCEPTION_FACTOR))
            else:
                steps.append((left[0] | right[0], (max if t == "and" else min)(left[1], right[1])))
        (result,) = steps
        return result
    except (IndexError, ValueError, AttributeError):
        labels = {label_of(n) for n in names}
        return labels, max(RESTRICTION.get(x, UNKNOWN) for x in labels)


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICES), ("base", BASE_PHRASES)):
        for phrase, label in phrases.items():
            machine.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    for tag in TAGS:
        machine.add_word(f" {tag} ", (len(tag) + 2, "tag", ""))
    machine.make_automaton()
    return machine


def tag_spans(text: str, places: list[int]) -> list[tuple[int, int]]:
    """Code points of the tags whose first words have the given numbers: first, and behind the last word."""
    wanted = {p + k: (p, k) for p in places for k in range(3)}
    first: dict[int, int] = {}
    ends: dict[int, int] = {}
    for number, m in enumerate(_WORD.finditer(text)):
        if number in wanted:
            first[number], ends[number] = m.start(), m.end()
    size = lambda p: 3 if text[first[p]:ends[p]].lower() == "spdx" else 2
    return [(first[p], ends[p + size(p) - 1]) for p in places]


def scan(text: str | None) -> dict:
    """Places, labels and score of one text."""
    words = text.encode().translate(_WORDS).split() if text else []
    line = f" {b' '.join(words).decode('latin-1')} " if words else ""
    starts: list[int] = []
    places: list[tuple[int, str, str]] = []
    base: set[str] = set()
    more: set[str] = set()
    score, tagged = 0.0, False
    word, at = 0, 0
    hits = sorted((end - size + 1, kind, label) for end, (size, kind, label) in automaton().iter(line)) if line else []
    for start, kind, label in hits:
        word, at = word + line.count(" ", at, start), start
        places.append((word, kind, label))
        if kind == "tag":
            tagged = True
            continue
        if kind == "base":
            starts.append(word)
            base.add(label)
        more.add(label)
        score = max(score, RESTRICTION.get(label, UNKNOWN))
    if tagged:
        spans = tag_spans(text, [word for word, kind, _ in places if kind == "tag"])
        for (_, begin), (upto, _) in zip(spans, [*spans[1:], (len(text), 0)]):
            begin = min(upto, _BEFORE.match(text, begin).end())
            stop = text.find("\n", begin, upto)
            if (found := evaluate(text[begin:upto if stop < 0 else stop])) is not None:
                more |= found[0]
                score = max(score, found[1])
    return {"n_words": len(words), "starts": starts, "base": base, "labels": base | more, "score": score, "places": places}


SCANNED = "doc_id long,n_words long,n_base long,first_word long,last_word long,base_labels string,labels string,score double"


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, first and last base place, labels, score) of every row; one pass, no shuffle."""

    def f(ids, texts):
        out = []
        for i, text in zip(ids, texts):
            s = scan(text)
            starts = s["starts"]
            out.append((
                i, s["n_words"], len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(s["base"])), ",".join(sorted(s["labels"])), s["score"],
            ))
        return out

    return map_rows(docs.select(id_col, text_col), lambda: f, schema(SCANNED))
