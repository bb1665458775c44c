import random
import time
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbsight.llm import packing
from curbsight.llm.common import Memo, Remembered
from curbsight.llm.queries import WORD_VOCABULARY, vocabulary

MODEL = vocabulary(WORD_VOCABULARY)
LIBRARY = Tokenizer.from_str(MODEL)
PARTS = [
    "a", "The", " ", "  ", "\n", "\x1cA", "\x1f", "\x85", "\xa0", " ", "​", "'s", "'RE", "É", "é", "ß", "Σ", "İ", "ﬁ", "漢", "🙂", "12", "½", "ª²", "µ", "\xad",
    "!", "_", "<|endoftext|>", "<|startoftext|>", "<|endof", "\x00", "`",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=5), max_size=30).map("".join))
def test_tokens_like_the_library(text):
    (coded,) = packing.WordTokenizer.of(MODEL).encode([text])
    assert np.frombuffer(coded, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def fewest(lengths, capacity):
    """By trying all ways to place them one by one."""
    best = len(lengths)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best and at < len(lengths) or len(bins) > best:
            return
        if at == len(lengths):
            best = min(best, len(bins))
            return
        for k in range(len(bins)):
            if bins[k] + lengths[at] <= capacity:
                place(at + 1, [*bins[:k], bins[k] + lengths[at], *bins[k + 1 :]])
        place(at + 1, [*bins, lengths[at]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bins_hold_everything_and_are_few(lengths):
    bins = packing.complete(lengths, 20)
    assert sorted(n for b in bins for n in b) == sorted(lengths)
    assert all(sum(b) <= 20 for b in bins)
    assert fewest(lengths, 20) <= len(bins) <= len(packing.best_fit(lengths, 20))


def test_completion_beats_best_fit_where_it_can():
    better = 0
    for seed in range(300):
        rng = random.Random(seed)
        lengths = [rng.randint(5, 60) for _ in range(14)]
        better += len(packing.complete(lengths, 100)) < len(packing.best_fit(lengths, 100))
    assert better


def test_undominated_fillings():
    shelf = packing.Shelf([7, 5, 4, 3, 3], 20)
    assert packing.fillings(shelf, 10, 20) == [(7, 3)]
    assert packing.fillings(packing.Shelf([6, 5], 20), 8, 1) == []
    assert packing.fillings(packing.Shelf([6, 5], 20), 8, 3)[0] == (6,)


@pytest.mark.parametrize("capacity", [20, 100, 500, 2048])
@pytest.mark.parametrize("shape", ["any", "long", "short", "halves", "equal"])
def test_hundreds_of_pieces_in_bounded_time(capacity, shape):
    rng = random.Random(f"{capacity} {shape}")
    ranges = {"any": (1, capacity), "long": (capacity * 3 // 10, capacity), "short": (1, max(1, capacity // 50)), "halves": (capacity // 3, capacity * 2 // 3), "equal": (capacity // 3, capacity // 3)}
    for size in (1, 30, 200, 900):
        lengths = [rng.randint(*ranges[shape]) for _ in range(size)]
        start = time.perf_counter()
        bins = packing.complete(lengths, capacity)
        assert time.perf_counter() - start < 20
        assert sorted(n for b in bins for n in b) == sorted(lengths) and all(sum(b) <= capacity for b in bins)
        assert packing.fewest_bins(lengths, capacity) <= len(bins) <= len(packing.best_fit(lengths, capacity))


@settings(max_examples=300, deadline=5000)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_search_ends_and_is_never_worse_than_best_fit(lengths):
    bins = packing.complete(lengths, 30)
    assert sorted(n for b in bins for n in b) == sorted(lengths)
    assert packing.fewest_bins(lengths, 30) <= len(bins) <= len(packing.best_fit(lengths, 30))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_lower_bound_is_one(lengths):
    assert packing.fewest_bins(lengths, 20) <= fewest(lengths, 20)


def test_more_short_pieces_than_branches():
    assert packing.fillings(packing.Shelf([1] * 450, 2048), 548, 500) == [(1,) * 450]
    bins = packing.complete([1500] * 12 + [1] * 450, 2048)
    assert sum(map(len, bins)) == 462 and len(bins) == 12


def test_many_empty_and_repeated_rows(docs):
    rows = [(i, "word " * 1500) for i in range(12)] + [(100 + i, "") for i in range(450)] + [(None, "same words here")] * 600
    found = packing.pack(docs(rows), MODEL).collect()
    assert len(found) == len(rows)
    check(rows, found)


def test_repeated_rows_are_dealt_evenly(docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    found = packing.pack(docs([(1, "one text")] * 1000), MODEL).collect()
    sizes = Counter(r.sequence_id % 40 for r in found)  # twenty groups
    assert len(found) == 1000 and max(sizes.values()) < 150


def check(rows, found):
    """Pieces make up each document's ids and sequences are gapless."""
    by_doc = {}
    for r in found:
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
    for doc_id, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        for piece, start in enumerate(range(0, len(ids) // 4, 2048)):
            part = ids[4 * start : 4 * (start + 2048)]
            assert any((r.start, r.length, r.ids_crc32) == (start, len(part) // 4, zlib.crc32(part)) for r in by_doc[doc_id, piece])
    order = sorted(found, key=lambda r: (r.sequence_id, r.offset))
    for _, own in groupby(order, key=lambda r: r.sequence_id):
        end = 0
        for r in own:
            assert r.offset == end
            end += r.length
        assert end <= 2048


def test_documents_packed(docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["cat", "Dog", "é!"]) for _ in range(rng.choice([0, 1, 50, 900, 2047, 2048, 5000])))) for i in range(60)]
    rows += [(None, "x"), (100, None), (101, ""), (7, rows[7][1])]
    found = packing.pack(docs(rows, "length", "offset", "deal"), MODEL).collect()
    check(rows, found)
    total = sum(r.length for r in found)
    assert len(found) == sum(-(-(len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1) // 2048) for _, t in rows)
    assert len({r.sequence_id for r in found}) <= -(-total // 2048) + 1


def test_many_groups(docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 10)
    rows = [(i, "w " * (i * 37 % 2000)) for i in range(100)]
    check(rows, packing.pack(docs(rows), MODEL).collect())


def test_empty_table(docs):
    assert packing.pack(docs([]), MODEL).collect() == []


@pytest.mark.parametrize("lengths", [[], [5], [2047, 1]])
def test_small_inputs(lengths):
    bins, offsets = packing.place(np.array(lengths, np.int64), 2048)
    assert len(bins) == len(offsets) == len(lengths)


@pytest.mark.parametrize("limit", [0, 500, 1000, 10**6])
def test_what_is_remembered_within_a_budget_changes_nothing(limit):
    asked = []
    known = Remembered(lambda key: asked.append(key) or key.upper().encode(), limit, "other")
    for _ in range(3):
        assert [known.joined(keys) for keys in (["a", "b", "a"], ["c", "d", "a"], [])] == [b"ABA", b"CDA", b""]
        assert (len(known) + len(known._old)) * (Memo.ENTRY + 2) <= limit or len(known) == 1
    assert len(asked) == 4 if limit == 10**6 else len(asked) >= 4
    Memo.forget_but("one")
    assert not known and not known._old and known["a"] == b"A"


def test_runs_and_words_are_coded_once(monkeypatch):
    """Each is computed when it is asked for first; a word that stood alone is known within other runs."""
    tokenizer = packing.WordTokenizer(MODEL)
    coded, encode = [], tokenizer._encode_word
    monkeypatch.setattr(tokenizer, "_encode_word", lambda word: coded.append(word) or encode(word))
    texts = ["tree Tree tree, TREE. 's it's ''s !'s", "tree's tree \u00e9t\u00e9 \u00c9T\u00c9 \u00e9t\u00e9\u00b2 \u6f22 <|x|> tree"]
    expected = [packing.WordTokenizer.of(MODEL)._by_library(t) for t in texts]
    assert tokenizer.encode(texts) == expected and len(coded) == len(set(coded))
    assert coded.count("tree") == 1
    coded.clear()
    assert tokenizer.encode(texts) == expected and not coded
