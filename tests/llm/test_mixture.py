import random
import zlib
from collections import Counter
from fractions import Fraction
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbsight.llm import mixture
from curbsight.llm.queries import WORD_VOCABULARY, vocabulary

MODEL = vocabulary(WORD_VOCABULARY)
LIBRARY = Tokenizer.from_str(MODEL)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, source string, start long, queue string")


def tokens(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, found, capacity=4096):
    """Pieces make up each row's ids once, sequences are gapless and full or a power of two."""
    expected = Counter()
    for doc_id, text, _ in rows:
        ids = tokens(text)
        expected[doc_id, len(ids)] += len(ids)
        expected[doc_id, "rows"] += 1
    whole = {(doc_id, len(ids := tokens(text))): np.array(ids, "<u4") for doc_id, text, _ in rows}
    texts_of = Counter(doc_id for doc_id, _ in {(d, len(tokens(t))) for d, t, _ in rows})
    seen = Counter()
    for r in found:
        seen[r.doc_id, r.doc_tokens] += r.length
        if texts_of[r.doc_id] == 1:
            assert r.ids_crc32 == zlib.crc32(whole[r.doc_id, r.doc_tokens][r.start : r.start + r.length].tobytes())
    assert seen == Counter({k: v for k, v in expected.items() if k[1] != "rows"})
    for doc_id, count in texts_of.items():
        if count == 1 and expected[doc_id, "rows"] == 1:
            own = sorted((r.start, r.length) for r in found if r.doc_id == doc_id)
            assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0
    sizes = []
    for _, own in groupby(sorted(found, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        end = 0
        for r in own:
            assert r.offset == end and r.length > 0
            end += r.length
        sizes.append(end)
    assert all(n == capacity or n < capacity and n & (n - 1) == 0 for n in sizes)
    return sizes


def mixtures(found, capacity):
    """Tokens by source of each full sequence, in order."""
    result = {}
    for r in found:
        result.setdefault(r.sequence_id, Counter())[r.source] += r.length
    return [result[k] for k in sorted(result) if sum(result[k].values()) == capacity]


def corpus(rng, number, sources="aaabbc"):
    return [(i, " ".join(rng.choice(["cat", "Dog", "é!"]) for _ in range(rng.choice([0, 1, 50, 300, 900]))), rng.choice(sources)) for i in range(number)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=6), st.integers(1, 40), st.sampled_from([1, 8, 64]))
def test_windows_give_everything_in_proportion(sizes, least, capacity):
    given_, done = [0] * len(sizes), 0
    total = sum(sizes)
    for turns in mixture.windows(sizes, [Fraction(0)] * len(sizes), capacity, least):
        own = sum(n for _, n in turns)
        assert own == capacity or own & (own - 1) == 0
        for queue, n in turns:
            given_[queue] += n
        done += own
        for queue, size in enumerate(sizes):
            assert abs(given_[queue] - done * size / total) <= len(sizes) * (least + 1)
    assert given_ == sizes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(1, 9)), min_size=1, max_size=5), st.integers(1, 50))
def test_schedule_splits_every_queue(queues, partition):
    lengths, weights = [n for n, _ in queues], [Fraction(w) for _, w in queues]
    schedule = mixture.Schedule(lengths, weights, partition)
    last = -(-sum(lengths) // partition)
    starts = [schedule.start(p) for p in range(last + 1)]
    assert starts[0][0] == [0] * len(queues) and starts[-1][0] == lengths
    for (a, _), (b, owed) in zip(starts, starts[1:]):
        assert all(x <= y for x, y in zip(a, b)) and sum(b) - sum(a) <= partition + len(queues) and all(0 <= o < 1 for o in owed)
    for queue, n in enumerate(lengths):
        for position in range(0, n, 7):
            p = schedule.of(queue, position)
            assert starts[p][0][queue] <= position < starts[p + 1][0][queue] and p == schedule.of(queue, position, last)


def test_natural_shares_in_every_window(spark, monkeypatch):
    monkeypatch.setattr(mixture, "PARTITION_WINDOWS", 4)
    rows = corpus(random.Random(1), 400)
    found = mixture.pack(table(spark, rows).repartition(5), MODEL, capacity=1024).collect()
    sizes = check(rows, found, 1024)
    total = Counter()
    for _, text, source in rows:
        total[source] += len(tokens(text))
    share = {s: n / sum(total.values()) for s, n in total.items()}
    full = mixtures(found, 1024)
    assert len(full) > 50 and len(sizes) - len(full) <= 10 * (len(full) // 4 + 2)
    assert all(abs(own[s] - 1024 * share[s]) <= 3 for own in full for s in share)


def test_targets_hold_until_a_source_runs_out(spark, monkeypatch):
    monkeypatch.setattr(mixture, "PARTITION_WINDOWS", 8)
    rows = corpus(random.Random(2), 300, "abc")
    found = mixture.pack(table(spark, rows), MODEL, capacity=512, targets={"a": 0.5, "b": 0.25, None: 0.25}).collect()
    check(rows, found, 512)
    full = mixtures(found, 512)
    early = full[: len(full) // 4]
    assert early and all(abs(own["a"] - 256) <= 3 and abs(own["b"] - 128) <= 3 for own in early)
    gone = 1 + max(k for k, own in enumerate(full) if own["a"])
    assert len(full) > gone + 8 and all(abs(own["b"] - 256) <= 3 for own in full[gone : gone + 5])


def test_sources_beyond_the_largest_go_together(spark, monkeypatch):
    monkeypatch.setattr(mixture, "QUEUES", 2)
    monkeypatch.setattr(mixture.frequent_sources, "__defaults__", (2,))
    rows = corpus(random.Random(3), 200, "aaaabbbcdefg")
    found = mixture.pack(table(spark, rows), MODEL, capacity=256).collect()
    check(rows, found, 256)
    assert {r.source for r in found} == {"a", "b", None}


def test_small_sources_wait_for_a_piece_of_some_length(spark):
    rows = [(i, "word " * 500, "big") for i in range(100)] + [(1000 + i, "tiny " * 20, "small") for i in range(20)]
    found = mixture.pack(table(spark, rows), MODEL, capacity=1024).collect()
    check(rows, found, 1024)
    small = [r for r in found if r.source == "small"]
    assert len(small) < 60


def test_nulls_repeats_and_long_texts(spark):
    rng = random.Random(4)
    rows = corpus(rng, 30) + [(None, "x y", "a"), (None, None, None), (100, None, "b"), (101, "", None), (7, "again", "c"), (7, "again", "c")]
    rows += [(200, "long text " * 30000, "a")]
    found = mixture.pack(table(spark, rows), MODEL).collect()
    check(rows, found)
    assert {r.source for r in found} >= {"a", "b", "c", ""}


def test_one_row_with_a_third_of_all_tokens_is_spread(spark, monkeypatch):
    monkeypatch.setattr(mixture, "PARTITION_WINDOWS", 1)
    rows = [(0, "hot " * 3000, "a")] + [(i, "cold " * 100, "b") for i in range(1, 60)]
    found = mixture.pack(table(spark, rows), MODEL, capacity=128).collect()
    check(rows, found, 128)
    assert len({r.sequence_id // mixture.NUMBERS for r in found if r.doc_id == 0}) > 20


def test_without_a_source_column(spark):
    rows = [(i, "some words", "") for i in range(10)]
    found = mixture.pack(table(spark, rows).select("doc_id", "text"), MODEL, capacity=8).collect()
    check(rows, found, 8)


def test_empty_table_and_bad_targets(spark):
    assert mixture.pack(table(spark, []), MODEL).collect() == []
    for bad in ({}, {"a": 0.0}, {"a": -1.0}):
        with pytest.raises(ValueError):
            mixture.pack(table(spark, []), MODEL, targets=bad)
