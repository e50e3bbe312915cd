import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from rill.llm import alignment
from tests_llm_rows import ODD

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows):
    """Every pair of tokens of a document, compared range by range."""
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    from rill.llm.bpe import byte_letters

    letters, found = byte_letters(), []
    for i, text in rows:
        raw = (" " + text).encode() if text else b""
        a = lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ta = [bytes(letters[c] for c in lib.id_to_token(x)) for x in a]
        tb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or b"".join(ta) != raw or b"".join(tb) != raw:
            found.append((i, [], [], [], []))
            continue
        ea, eb = np.cumsum(list(map(len, ta))).tolist(), np.cumsum(list(map(len, tb))).tolist()
        links = [
            (x, y) for x in range(len(a)) for y in range(max(0, np.searchsorted(eb, ea[x] - len(ta[x]), "right")), len(b))
            if eb[y] - len(tb[y]) < ea[x] and ea[x] - len(ta[x]) < eb[y]
        ] if len(a) < 3000 else None
        cuts = sorted(set(ea) & set(eb))
        found.append((i, a, b, links, [(ea, eb, c) for c in cuts]))
    return found


def digests(rows):
    found = brute(rows)
    count = Counter()
    for _, a, b, links, _ in found:
        count.update({(a[x], b[y]) for x, y in links})
    best = {}
    for (a, _), n in count.items():
        best[a] = max(n, best.get(a, 0))
    out = []
    for i, a, b, links, cuts in found:
        groups, x, y = [], 0, 0
        for ea, eb, c in cuts:
            nx, ny = ea.index(c) + 1, eb.index(c) + 1
            groups.append(",".join(map(str, a[x:nx])) + "|" + ",".join(map(str, b[y:ny])))
            x, y = nx, ny
        counts = [count[a[p], b[q]] for p, q in links]
        n_best = sum(n == best[a[p]] for (p, _), n in zip(links, counts))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(cuts), len(links), n_best, sum(counts), sha))
    return sorted(out, key=str)


def texts(n=150):
    random.seed(3)
    bits = ["the", " of", "Ünï", "日本語", "🤣", "  ", "\n\n", "\t", "<|endoftext|>", "<s>", "</s>", "tion", "x" * 9, "ß", "\x00", "1234", "don't", " ", "<0x41>"]
    return ["".join(random.choices(bits, k=random.randint(1, 40))) for _ in range(n)]


def test_digests_match_brute_force(spark, make_docs):
    rows = [r for r in ODD if r[0] != 7] + [(100 + i, t) for i, t in enumerate(texts())] + [(500, "a▁b"), (501, "word " * 400)]
    got = alignment.summaries(make_docs(rows), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == digests(rows)
    assert alignment.summaries(make_docs([]), A, B).collect() == []


def test_blocks_do_not_change_results(spark, make_docs, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts(60))] * 2
    want = digests(rows)
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 7)
    monkeypatch.setattr(alignment, "LANE", 3)
    got = alignment.summaries(make_docs(rows).repartition(3), A, B)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_links_and_cuts_are_real_places(spark, make_docs):
    rows = list(enumerate(texts(40))) + [(90, None), (91, "")]
    want = {i: (a, b, links, [c for *_, c in cuts]) for i, a, b, links, cuts in brute(rows)}
    got = {r.doc_id: (r.a, r.b, list(zip(r.link_a, r.link_b)), r.cuts) for r in alignment.links(alignment.encode(make_docs(rows), A, B), A, B).collect()}
    assert got == want


def test_lanes_equal_one_walk():
    rng = np.random.default_rng(4)
    ends_a, ends_b, first = [], [], [0]
    at = 0
    for n in (1, 2, 700, 5, 3000):
        cuts = lambda: np.unique(np.append(rng.integers(1, n + 1, n // 2), n)) + at  # noqa: B023
        ends_a.append(cuts())
        ends_b.append(cuts())
        first.append(first[-1] + len(ends_a[-1]))
        at += n
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    i = j = 0
    want = []
    while i < len(a):
        want.append((i, j, bool(a[i] == b[j])))
        i, j = i + int(a[i] <= b[j]), j + int(b[j] <= a[i])
    for lane in (1, 2, 50, 10**6):
        assert list(zip(*(x.tolist() for x in alignment.lockstep(a, b, np.array(first), lane)))) == want


def test_both_libraries_split_every_letter_alike():
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    own = alignment.tokenizers(A, B)
    letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = [" ".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}.{chr(c)}  {chr(c)}" for c in letters[at:at + 64]) for at in range(0, len(letters), 64)]
    for at in range(0, len(lines), 2000):
        for text, enc in zip(lines[at:at + 2000], lib.encode_batch_fast(lines[at:at + 2000], add_special_tokens=False)):
            assert own.encode_a(text) == enc.ids


def test_very_long_runs():
    both = alignment.tokenizers(A, B)
    for text in ("x" * 300_000, " " * 200_000, "word " * 100_000, "é" * 200_000):
        (a, b), = both.encode([text])
        assert sum(both.a.lengths[a]) == sum(both.b.lengths[b]) == len(text.encode()) + 1
