"""The per-task search against plain sorting, on vectors with very many ties."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbsight.operators import nearest

SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("d2", pa.float64())])


@st.composite
def searches(draw):
    dimensions = draw(st.integers(1, 3))
    point = st.lists(st.integers(-1, 1), min_size=dimensions, max_size=dimensions)
    corpus = draw(st.lists(point, min_size=1, max_size=40))
    queries = draw(st.lists(point, min_size=1, max_size=4))
    ids = draw(st.permutations(range(len(corpus))))
    cuts = draw(st.lists(st.integers(0, len(corpus)), max_size=4))
    return np.array(corpus, float), np.array(queries, float), np.array(ids), sorted(cuts), draw(st.integers(1, 6))


@given(searches(), st.sampled_from([2, 2_000_000]), st.sampled_from([0, 8]))
@settings(max_examples=300, deadline=None)
def test_best_rows_in_any_batching(search, cells, many_ties):
    corpus, queries, ids, cuts, k = search
    before = nearest.SCORE_CELLS, nearest.MANY_TIES
    nearest.SCORE_CELLS, nearest.MANY_TIES = cells, many_ties
    try:
        best = nearest._Best(queries, k)
        for start, end in zip([0, *cuts], [*cuts, len(corpus)]):
            best.add(ids[start:end], corpus[start:end])
        found = best.table(pa.array(range(len(queries))), SCHEMA).to_pylist()
    finally:
        nearest.SCORE_CELLS, nearest.MANY_TIES = before

    expected = []
    for q, query in enumerate(queries):
        d2 = ((corpus - query) ** 2).sum(axis=1)
        expected += [(q, i, d) for d, i in sorted(zip(d2, ids.tolist()))[:k]]
    assert [(r["query_id"], r["vec_id"], r["d2"]) for r in found] == expected


def best_of(corpus, queries, k, step):
    best = nearest._Best(queries, k)
    for at in range(0, len(corpus), step):
        best.add(np.arange(at, min(at + step, len(corpus))), corpus[at : at + step])
    return [(r["query_id"], r["vec_id"]) for r in best.table(pa.array(range(len(queries))), SCHEMA).to_pylist()]


def sorted_out(corpus, queries, k):
    d2 = ((np.float64(corpus)[None] - np.float64(queries)[:, None]) ** 2).sum(axis=2)
    return [(q, i) for q, row in enumerate(d2) for i in np.lexsort((np.arange(len(row)), row))[:k].tolist()]


def test_many_pairs_are_screened_in_single_precision_and_few_measured(monkeypatch):
    rng = np.random.default_rng(4)
    corpus, queries = (np.float32(np.abs(rng.normal(size=(n, 64)))) for n in (4000, 700))
    split, measured, partition, distance = [], [], np.partition, nearest._Part._distance
    monkeypatch.setattr(np, "partition", lambda a, *rest, **named: split.append(a.dtype) or partition(a, *rest, **named))
    monkeypatch.setattr(nearest._Part, "_distance", lambda self, v, row, q: measured.append(len(row)) or distance(self, v, row, q))
    assert best_of(corpus, queries, 5, 500) == sorted_out(corpus, queries, 5)
    parts = -(-len(queries) // nearest.PART_QUERIES)
    assert split == [np.dtype(np.float32)] * parts  # of the first rows only
    assert sum(measured) < len(queries) * 40


@pytest.mark.parametrize("scale", [1, 1e-12, 1e12, 1e18, 1e25, 1e-25])
@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_rows_that_single_precision_cannot_tell_apart(scale, kind):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=16)
    corpus = np.vstack([middle + 1e-6 * rng.normal(size=(300, 16)), rng.normal(size=(300, 16))])
    corpus = (corpus * scale).astype(kind)
    queries = np.vstack([corpus[:3], rng.normal(size=(2, 16)) * scale]).astype(kind)
    assert best_of(corpus, queries, 4, 100) == sorted_out(corpus, queries, 4)


def test_far_from_the_origin_and_of_very_different_length():
    rng = np.random.default_rng(6)
    near, far = 1e4 + rng.normal(size=(200, 8)), rng.normal(size=(200, 8)) * 10.0 ** rng.integers(-6, 7, size=(200, 1))
    for corpus in (near, far, np.vstack([near, far])):
        corpus = np.float32(corpus)
        assert best_of(corpus, corpus[::9], 5, 64) == sorted_out(corpus, corpus[::9], 5)
