import math
import random

import numpy as np
import pytest

from curbsight.llm import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def expected(rows, k):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    result = set()
    for q, v in {i: v for i, v in whole if i % 20 == 0}.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:k]
        result |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return result


def search(spark, rows, k):
    vectors = top_k.quantised(frame(spark, rows))
    found = top_k.search(vectors.where("vec_id % 20 = 0"), vectors, k).collect()
    assert len({(r.query_id, r.rank) for r in found}) == len(found)
    return {tuple(r) for r in found}


@pytest.mark.parametrize(("chunk", "group"), [(4096, 8), (16, 2)])
def test_against_all_pairs(spark, monkeypatch, chunk, group):
    monkeypatch.setattr(top_k, "CHUNK", chunk)
    monkeypatch.setattr(top_k, "GROUP_CHUNKS", group)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 4)
    monkeypatch.setattr(top_k, "SEEDS", 30)
    rng = random.Random(2)
    same = [0.5] * 24
    rows = [(i, same if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(24)]) for i in range(300)]
    assert search(spark, rows, 20) == expected(rows, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (20, [1.0]), (40, None), (60, []), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (1, [2.0, 0.01]), (2, [2.0, 0.01]), (None, [1.0, 1.0]), (140, [0.0, 0.0]), (3, [1e12, 1e12])]
    assert search(spark, rows, 3) == expected(rows, 3)
    assert search(spark, [], 3) == set()


def test_bounds_never_lose_a_candidate():
    rng = np.random.default_rng(7)
    for _ in range(50):
        q, c = (top_k.Chunk(40, n, np.arange(n) + at, np.ascontiguousarray(rng.integers(-90, 90, (40, n))).tobytes()) for n, at in ((5, 0), (200, 100)))
        exact = q.exact.T @ c.exact
        least = np.sort(exact, axis=1)[:, -7].astype(float)
        for row, (at, found) in enumerate(top_k.scores(q, c, least)):
            assert (np.flatnonzero(exact[row] >= least[row]) == at).all() and (found == exact[row, at]).all()
