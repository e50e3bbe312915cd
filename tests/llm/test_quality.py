import random
import re

import numpy as np

from rill.llm import quality
from tests_llm_rows import ODD


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, mark, seen = len(words), [False] * len(words), {}
    for i in range(n - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                mark[i:i + 5] = [True] * 5
    lines, dups = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in lines
            lines.add(line)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), dups, sum(mark)


def test_counts_match_brute_force():
    random.seed(1)
    texts = [t for _, t in ODD]
    for _ in range(300):
        words = random.choices(["a", "b", "é#", "|", "日本", "x<y>"], k=random.randint(0, 60))
        texts.append("".join(w + random.choice([" ", "\n", "\t", " \x0b"]) for w in words))
    for t in texts:
        assert quality.statistics(t)[0] == brute(t)


def labelled(n=1500):
    random.seed(5)
    rows, labels = [], []
    vocab = [f"word{i}" for i in range(500)]
    for i in range(n):
        words, bad = random.choices(vocab, k=random.randint(15, 80)), i % 5 == 0
        if bad and i % 10:
            words = [w + "%%%" for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_trees_learn_and_score_like_a_walk(spark, make_docs):
    rows, labels = labelled()
    docs = make_docs(rows)
    trees = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in quality.judge(docs, trees).collect()}
    assert sum(got[i].kept == bool(q) for i, q, _ in labels) / len(labels) > 0.98
    x = np.array([quality.statistics(t)[1] for _, t in rows[:50]])
    for row, s in zip(x, trees.score(x)):  # one node at a time
        total = trees.offset
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert abs(s - 1 / (1 + np.exp(-total))) < 1e-12


def test_constrained_features_never_raise_the_score():
    rng = np.random.default_rng(0)
    signs = np.array(list(quality.FEATURES.values()))
    x = rng.random((1200, len(signs)))
    y = (rng.random(1200) < 0.3 + 0.4 * x[:, 2]).astype(float)  # the data ask for the forbidden direction
    y[x[:, 0] > 0.7] = 1
    trees = quality.boost(x, y, signs)
    probe = rng.random((100, len(signs)))
    for f in np.flatnonzero(signs):
        scores = []
        for v in np.linspace(-0.1, 1.1, 30):
            moved = probe.copy()
            moved[:, f] = v
            scores.append(trees.score(moved))
        assert (signs[f] * np.diff(np.array(scores), axis=0) >= -1e-12).all()


def test_odd_rows(spark, make_docs):
    labels = spark.createDataFrame([(None, 1, 0), (1, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.fit(make_docs(ODD), labels)
    assert not len(trees.roots)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(make_docs(ODD), trees).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in ODD), key=str)
    assert quality.judge(make_docs([]), trees).collect() == []
