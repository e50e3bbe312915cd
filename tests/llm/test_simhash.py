import random
import re

import numpy as np
import pytest
import xxhash

from rill.llm import simhash
from tests_llm_rows import ODD


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance=3):
    """Smallest index of each print's component, by all pairs."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    a = np.array(prints, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= distance):
            x, y = find(i), find(int(j))
            label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_documents_match_brute_force(make_docs):
    random.seed(4)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(100 + i, " ".join(random.choices(vocab, k=random.randint(1, 80)))) for i in range(60)]
    for i in range(60):  # near copies
        words = rows[i][1].split()
        words[random.randrange(len(words))] = "other"
        rows.append((300 + i, " ".join(words)))
    rows += [r for r in ODD if r[0] != 7] + [(400, "A B c"), (401, "a b C")]
    got = simhash.near_duplicates(make_docs(rows)).collect()
    prints = [brute_print(t) for _, t in rows]
    classes = brute_classes(prints)
    smallest = {c: min((rows[i][0] for i in range(len(rows)) if classes[i] == c and rows[i][0] is not None), default=None) for c in classes}
    want = sorted(((i, format(p, "016x"), smallest[c]) for (i, _), p, c in zip(rows, prints, classes)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("chunk", [3, 64, 2048])
def test_dense_groups_lose_no_link(spark, chunk):
    """One ball of near fingerprints, chains of single bits, and random ones."""
    random.seed(chunk)
    center = random.getrandbits(64)
    prints = {center}
    while len(prints) < 300:
        prints.add(center ^ sum(1 << b for b in random.sample(range(64), random.randint(1, 6))))
    chain = random.getrandbits(64)
    for b in random.sample(range(64), 40):
        chain ^= 1 << b
        prints.add(chain)
    prints |= {random.getrandbits(64) for _ in range(200)} | {0, 1, 2**64 - 1}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = simhash.components(simhash.links(fps, 3, chunk)).collect()
    root = {r.node: r.root for r in found}
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == v) for v in set(labels)}
    assert groups([root.get(s, s) for s in signed]) == groups(brute_classes(prints))


def test_orders_of_bits_are_undone(spark):
    random.seed(8)
    prints = [0, 2**64 - 1] + [random.getrandbits(64) for _ in range(50)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    for distance in (0, 2, 3):
        orders = simhash.heads(distance)
        assert len(orders) == (distance + 1) * (distance + 2)
        cols = [simhash._key(fps.fp, o).alias(f"k{n}") for n, o in enumerate(orders)]
        rows = fps.select("fp", *cols).collect()
        for n, order in enumerate(orders):
            keys = np.array([r[f"k{n}"] for r in rows], dtype=np.int64).view(np.uint64)
            assert simhash._fp(keys, order).view(np.int64).tolist() == [r.fp for r in rows]


def test_one_large_block_group(spark):
    """All fingerprints share 16 bits; planted links in it are found, and few rows meet in a walk."""
    random.seed(21)
    top = 0xBEEF << 48
    prints = {top | random.getrandbits(48) for _ in range(12_000)}
    for p in random.sample(sorted(prints), 300):
        prints.add(p ^ sum(1 << b for b in random.sample(range(64), 3)))
    hot = top | (0xABC << 36)  # a third also shares the next bits
    prints |= {hot | random.getrandbits(36) for _ in range(6_000)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(fps, 3, 256)).collect()}
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == v) for v in set(labels)}
    assert groups([root.get(s, s) for s in signed]) == groups(brute_classes(prints))


def test_walk_yields_each_close_pair_once():
    random.seed(2)
    keys = np.array(sorted({random.getrandbits(64) & 0x7F07 for _ in range(300)}), dtype=np.uint64)
    n = len(keys)
    got = [(int(i), int(j)) for a, b in simhash.walk(keys, np.array([[0, n, 0, n]]), 0, 3) for i, j in zip(a, b)]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if bin(int(keys[i] ^ keys[j])).count("1") <= 3}
    assert len(got) == len(want) and {tuple(sorted(p)) for p in got} == want


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
