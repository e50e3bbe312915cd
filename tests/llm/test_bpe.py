import hashlib
import random

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rill.llm import bpe
from tests_llm_rows import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text_as_the_library(text):
    own = bpe.tokenizer(PATH)
    ids = own.encode([text])[0]
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text("aehinrt'sSdlLv 12\n\t.,!é<|>", max_size=120))
def test_dense_alphabet_as_the_library(text):
    assert bpe.tokenizer(PATH).encode([text])[0] == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_runs_and_special_tokens():
    own = bpe.tokenizer(PATH)
    for text in (" " * 999, "-" * 500, "a" * 3000, "<|endoftext|><|endoftext|> a <|endoftext|", "x\n\n\n  y"):
        assert own.encode([text])[0] == LIBRARY.encode(text, add_special_tokens=False).ids


def test_cache_turnover_changes_nothing():
    own = bpe.PrefixBpe(PATH)
    own.cache.limit = 20
    random.seed(3)
    texts = [" ".join(random.choices(["alpha", "alphabet", "beta", "betray", "gamma", "zeta"], k=9)) + str(i) for i in range(60)]
    got = [ids for i in range(0, 60, 5) for ids in own.encode(texts[i:i + 5])]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.cache.known) <= 20 + 5 * 10


def test_round_trip_of_odd_rows(make_docs):
    docs = make_docs(ODD)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, t in ODD:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(LIBRARY.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=str) == sorted(want, key=str)
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in ODD), key=str)


def test_empty_table(make_docs):
    assert bpe.round_trip(make_docs([]), PATH).collect() == []
