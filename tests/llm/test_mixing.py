import math
import random

import pytest

from rill.llm import mixing
from tests_llm_rows import ODD


def corpus(sizes):
    rows, n = [], 0
    for source, (docs, words) in sizes.items():
        for _ in range(docs):
            rows.append((n, " ".join(["w"] * words), source))
            n += 1
    return rows


def run(make_docs, rows, target):
    docs = mixing.numbered(make_docs(rows))
    base = mixing.reliable(mixing.compact(docs, target.seed))
    sources = mixing.plan(base, target)
    return docs, sources, mixing.place(base, sources, target)


SIZES = {"big": (300, 40), "mid": (80, 25), "small": (20, 20), None: (10, 10)}


def test_repeats_stay_within_the_limit_and_every_document_is_used(make_docs):
    target = mixing.Target(max_repeats=3.0, block_tokens=2_000)
    docs, sources, placed = run(make_docs, corpus(SIZES), target)
    info = {r.source: r for r in sources.collect()}
    tokens = {s: d * w for s, (d, w) in SIZES.items()}
    total = sum(tokens.values())
    alpha = info["big"].alpha
    # the same bisection by hand: repetition goes with share ** (alpha - 1)
    shares = [t / total for t in tokens.values()]
    assert (max(shares) / min(shares)) ** (1 - alpha) == pytest.approx(3.0, rel=1e-5)
    z = sum(s**alpha for s in shares)
    for s, r in info.items():
        assert r.weight == pytest.approx((tokens[s] / total) ** alpha / z, rel=1e-9)
        assert 0.999 <= r.quota / r.tokens <= 3.001
    rows = placed.collect()
    assert {r.doc_id for r in rows} == set(range(410))
    copies = {}
    for r in rows:
        copies.setdefault(r.doc_id, set()).add(r.epoch)
    assert all(e == set(range(len(e))) for e in copies.values())
    for s, (d, w) in SIZES.items():  # the quota is met up to one document
        got = sum(r.tokens for r in rows if r.source == s)
        assert info[s].quota - w < got <= info[s].quota
    blocks = {}
    for r in rows:
        blocks.setdefault(r.block_id, []).append(r)
    for block in blocks.values():
        assert sorted(r.position for r in block) == list(range(1, len(block) + 1))
    # inner blocks hold the sources in their weights, up to a document of each
    for b in list(blocks)[1:-1]:
        n = sum(r.tokens for r in blocks[b])
        for s, (d, w) in SIZES.items():
            got = sum(r.tokens for r in blocks[b] if r.source == s)
            assert abs(got - info[s].weight * n) <= 2 * w + 0.02 * n


def test_realise_places_the_same_copies_with_all_columns(make_docs):
    target = mixing.Target(max_repeats=2.5)
    docs, sources, placed = run(make_docs, corpus(SIZES), target)
    out = mixing.realise(docs, sources, target)
    assert out.columns == docs.schema[mixing.PACKED].dataType.names
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in placed.collect())


def test_target_entropy(make_docs):
    target = mixing.Target(max_repeats=None, entropy=1.2, budget=50_000)
    _, sources, placed = run(make_docs, corpus(SIZES), target)
    weights = [r.weight for r in sources.collect()]
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(1.2, abs=1e-5)
    assert sum(r.tokens for r in placed.collect()) == pytest.approx(50_000, abs=100)


def test_budget_below_the_tokens_takes_part_of_a_source(make_docs):
    target = mixing.Target(max_repeats=1.0, budget=6_000)
    _, sources, placed = run(make_docs, corpus(SIZES), target)
    info = {r.source: r for r in sources.collect()}
    got = {}
    for r in placed.collect():
        assert r.epoch < info[r.source].passes + 1
        got[r.source] = got.get(r.source, 0) + r.tokens
    for s, (d, w) in SIZES.items():
        assert info[s].quota - w < got.get(s, 0) <= info[s].quota


def test_odd_rows_and_empty_table(make_docs):
    target = mixing.Target()
    rows = [(i, t, None if i == 5 else "a") for i, t in ODD] + [(20, "", "silent"), (21, None, "silent")]
    docs, sources, placed = run(make_docs, rows, target)
    got = placed.collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    assert sum(r.source == "silent" for r in got) == 2
    docs, sources, placed = run(make_docs, [], target)
    assert placed.collect() == [] and mixing.realise(docs, sources, target).collect() == []


def brute_place(rows, info, target, key_of):
    """(doc, epoch, block) of every placed row: passes in key order, running sums, quotas, by plain loops."""
    out = []
    for s, r in info.items():
        mine = [x for x in rows if x.source == s]
        whole = r.quota // r.tokens if r.tokens else 1
        rest = r.quota - whole * r.tokens if r.tokens else 0
        blocks = max(1, math.ceil(r.mix_tokens / target.block_tokens))
        for epoch in range(whole + (1 if rest else 0)):
            run = 0
            for x in sorted(mine, key=lambda x: key_of[x.key, epoch]):
                if epoch == whole and run + x.tokens > rest:
                    break
                at = epoch * r.tokens + run
                block = min(int(at / r.quota * blocks), blocks - 1) if r.quota else key_of[x.key, epoch] % blocks
                out.append((x.doc_id, x.source, epoch, block))
                run += x.tokens
    return sorted(out, key=str)


@pytest.mark.parametrize("ids", ["own", "none", "one"])
def test_placement_equals_brute_force_and_quotas_hold_without_ids(spark, make_docs, ids):
    """Rows without an id, or all of one id and some with equal texts, are placed one by one."""
    from pyspark.sql import functions as F

    random.seed(5)
    target = mixing.Target(max_repeats=2.0, block_tokens=1_500)
    rows = []
    for source, n in (("big", 250), ("mid", 60), ("small", 25), (None, 12)):
        rows += [({"own": len(rows) + k, "none": None, "one": 7}[ids], " ".join(["w"] * random.randint(0, 30)), source) for k in range(n)]
    docs = mixing.numbered(make_docs(rows))
    base = mixing.reliable(mixing.compact(docs, target.seed))
    sources = mixing.plan(base, target)
    info = {r.source: r for r in sources.collect()}
    flat = base.collect()
    assert len({r.key for r in flat}) == len(rows)
    epochs = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("e")
    key_of = {(r.key, r.e): r.k for r in base.select("key", epochs).select("key", "e", mixing.pass_key(F.col("key"), F.col("e"), target.seed).alias("k")).collect()}
    placed = mixing.place(base, sources, target).collect()
    want = brute_place(flat, info, target, key_of)
    assert sorted(((r.doc_id, r.source, r.epoch, r.block_id) for r in placed), key=str) == want
    for s, r in info.items():
        got = sum(x.tokens for x in placed if x.source == s)
        assert r.quota - 30 <= got <= r.quota
    copies = mixing.realise(docs, sources, target)
    assert copies.count() == len(want)
