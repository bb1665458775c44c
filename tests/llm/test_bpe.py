import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbsight.llm import bpe
from curbsight.llm.queries import BYTE_VOCABULARY, vocabulary

MODEL = vocabulary(BYTE_VOCABULARY)
LIBRARY = Tokenizer.from_str(MODEL)
OWN = bpe.ByteBpe.of(MODEL)
PARTS = [
    "a", "aaaa", "the", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "​", "'s", "'RE", "é", "é", "漢", "🙂", "1", "23", "!", "...",
    "_", "<|endoftext|>", "<|endof", "\x00", "İ", "ﬁ",
]


def ids(coded):
    return np.frombuffer(coded, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=5), max_size=30).map("".join))
def test_like_the_library(text):
    (coded,) = OWN.encode([text])
    assert ids(coded) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.decode(coded) == LIBRARY.decode(ids(coded), skip_special_tokens=False) == text


def test_invalid_bytes_become_replacement_characters():
    (coded,) = OWN.encode(["é"])
    single = [i for i in range(256) if OWN._bytes[i] == b"\xc3"]
    assert OWN.decode(np.array(single, "<u4").tobytes()) == "�"
    assert OWN.decode(coded) == "é"


def test_overlapping_pairs_merge_from_the_left():
    letters = bpe.byte_letters()
    vocabulary = {c: b for b, c in letters.items()} | {"aa": 256, "aaa": 257}
    index = bpe.PairIndex(vocabulary, [("a", "a"), ("aa", "a")])
    assert [ids(x) for x in index.encode([["a" * n] for n in range(7)])] == [[], [97], [256], [257], [256, 256], [256, 257], [256, 256, 256]]


def test_rows_in_rows_out(docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "hello"), (4, "word " * 50_000)]
    found = bpe.decode(bpe.encode(docs(rows, "ids", "n_tokens"), MODEL), MODEL).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.text) for r in found), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2)} == {0}
    assert bpe.encode(docs([]), MODEL).count() == 0


@pytest.mark.parametrize("limit", [0, 3, 1000, 1500, 10**6])
def test_a_full_memo_changes_nothing(limit):
    memo = bpe.Memo(lambda keys: [k.upper().encode() for k in keys], limit)
    for _ in range(3):
        assert memo.joined([["a", "b"], ["c", "d", "a"], []]) == [b"AB", b"CDA", b""]


def test_memos_of_other_kinds_are_emptied():
    one, two = (bpe.Memo(lambda keys: [k.encode() for k in keys], 10**6, kind) for kind in ("one", "two"))
    for memo in (one, two):
        memo.joined([["a"]])
    bpe.Memo.forget_but("one")
    assert one.known == {"a": b"a"} and two.known == {} and two.joined([["a", "b"]]) == [b"ab"]
