import random
import re

import pytest

from rill.llm import licences
from tests_llm_rows import ODD


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_places_match_brute_force(make_docs):
    random.seed(2)
    words = ["GNU", "general", "public", "license", "Apache", "cc", "by", "CC-BY", "MIT", "mıt", "é", "mit license", "x1", "日本", "by\x7f"]
    rows = [(i, "".join(random.choice(words) + random.choice([" ", "-", "\n", ". ", "_"]) for _ in range(30))) for i in range(300)]
    rows += ODD
    got = licences.scan_licences(make_docs(rows)).collect()
    want = sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert licences.scan_licences(make_docs([])).collect() == []


@pytest.mark.parametrize("line, labels, score", [
    ("MIT", {"mit"}, 0.1),
    ("MIT OR GPL-3.0-only", {"mit", "gpl"}, 0.1),
    ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 0.75),
    ("MIT OR GPL-2.0 AND Apache-2.0", {"mit", "gpl", "apache"}, 0.1),
    ("(MIT OR GPL-2.0) AND Apache-2.0", {"mit", "gpl", "apache"}, 0.2),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl"}, 0.75 * 0.8),
    ("LGPL-2.1+ */", {"lgpl"}, 0.55),
    ("CC-BY-NC-4.0 text goes on", {"cc-by-nc"}, 0.8),
    ("MIT or (Apache-2.0 and", {"mit", "apache"}, 0.2),
    ("Odd-1.0", {"odd-1.0"}, 0.5),
    ("MIT/Apache-2.0", {"mit", "apache"}, 0.1),
    ("mit, apache-2.0", {"mit", "apache"}, 0.2),
    ("MIT, and then some", {"mit"}, 0.1),
    ("MIT / , x", {"mit"}, 0.1),
])
def test_expressions(line, labels, score):
    got = licences.evaluate(line)
    assert got[0] == labels and got[1] == pytest.approx(score)


def test_nothing_to_parse_and_deep_nesting():
    assert licences.evaluate("") is None and licences.evaluate("and or )") is None
    deep = "(" * 5000 + "MIT" + ")" * 5000
    assert licences.evaluate(deep) == ({"mit"}, 0.1)


def test_tags_and_notices_add_labels():
    s = licences.scan("// SPDX-License-Identifier: Apache-2.0 OR MIT\nMozilla Public License. Under the MIT license.")
    assert s["base"] == {"mit"} and s["labels"] == {"mit", "apache", "mpl"} and s["score"] == pytest.approx(0.45)


def test_every_tag_of_a_line_counts():
    s = licences.scan("/* SPDX-License-Identifier: MIT */ a(); /* SPDX-License-Identifier: GPL-2.0-only */ b();")
    assert s["labels"] == {"mit", "gpl"} and s["score"] == pytest.approx(0.75)
    s = licences.scan("x License-Expression: MIT SPDX-License-Identifier: Apache-2.0 OR MIT\nGPL; license expression = EPL-2.0")
    assert s["labels"] == {"mit", "apache", "epl"} and s["score"] == pytest.approx(0.45)


def test_expressions_begin_at_the_tag_whatever_stands_between():
    cases = {
        "SPDX-License-Identifier MIT": {"mit"}, "SPDX-License-Identifier:\n  MIT OR GPL-2.0\nApache-2.0": {"mit", "gpl"},
        "spdx  ---  LICENSE\nIdentifier = 'ISC'": {"isc"}, "license_expression: \"BSD-3-Clause\"": {"bsd"},
        "# SPDX-License-Identifier:\r\n# MIT": {"mit"}, "SPDX-License-Identifier:": set(), "SPDX-License-Identifier:\n\nMIT": set(),
        "日本 SPDX-License-Identifier: MIT": {"mit"}, "License Expression License-Expression: MPL-2.0": {"mpl"},
    }
    for text, labels in cases.items():
        assert licences.scan(text)["labels"] == labels, text


def test_a_very_long_identifier_takes_linear_time():
    import time

    def took(n):
        start = time.process_time()
        found = licences.scan("SPDX-License-Identifier: " + "a" * n)
        assert len(found["labels"]) == 1
        return time.process_time() - start

    took(1_000)
    assert took(1_600_000) < 40 * max(took(200_000), 0.01)
