import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbsight.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA.replace("float", kind) + ", code string, error int")


def expected(rows, parts=8, entries=16, rounds=6):
    """All distances, in plain Python integers."""
    kept = [(i, [math.floor(4096 * c) for c in v], label) for i, v, label in rows]
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is not None, kept[r][0] or 0, kept[r][1]))
    books = [[list(cut[r][p]) for r in order[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), at) for at, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = {}
        for row in cut:
            for p in range(parts):
                groups.setdefault((p, nearest(row[p], p)[1]), []).append(row[p])
        for (p, at), own in groups.items():
            books[p][at] = [sum(c) // len(own) for c in zip(*own)]
    final = [[nearest(row[p], p) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in own) for own in final]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    fits = lambda n: n if n < 1 << 63 else None
    return sorted(
        [(i, "".join(f"{at:02x}" for _, at in own), fits(e), fits(by_label[label]), sha) for (i, _, label), own, e in zip(kept, final, errors)], key=str
    )


def coded(df, **options):
    return sorted([tuple(r)[:5] for r in codes.encode(df, **options).collect()], key=str)


def rounded(rng, size, spread=0.2):
    return [float(np.float32(rng.gauss(0, spread))) for _ in range(size)]


@pytest.mark.parametrize("size,number", [(8, 200), (64, 150), (20, 60), (3, 30), (16, 5)])
def test_like_plain_lloyd(spark, size, number):
    rng = random.Random(size)
    rows = [(rng.randrange(10**6), rounded(rng, size), rng.choice([0, 1, None])) for _ in range(number)]
    assert coded(table(spark, rows)) == expected(rows)


def test_ties_copies_and_null_ids(spark):
    rng = random.Random(3)
    rows = [(i % 40 or None, [float(rng.randint(-1, 1)) / 4096 for _ in range(16)], i % 3) for i in range(300)]
    rows += [(7, [0.5] * 16, None)] * 200
    assert coded(table(spark, rows)) == expected(rows)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_nearest_entry_of_any_numbers(data):
    number = st.integers(-3, 3) | st.integers(-(2**57), 2**57)
    vector = st.lists(number, min_size=2, max_size=2)
    x = np.array(data.draw(st.lists(vector, min_size=1, max_size=20)), np.int64)
    entries = np.array(data.draw(st.lists(vector, min_size=1, max_size=8)), np.int64)
    pivots = codes.pivots_among(entries)
    nearest, best, evaluated = codes.assign(x, codes.distances(x, pivots), pivots, entries)
    for row, at, squared in zip(x.tolist(), nearest, best):
        assert (squared, at) == min((sum((a - b) ** 2 for a, b in zip(row, e)), k) for k, e in enumerate(entries.tolist()))
    assert (evaluated <= len(entries)).all()


def test_bounds_save_evaluations(spark):
    rng = random.Random(5)
    rows = [(i, rounded(rng, 16), 0) for i in range(2000)]
    found = codes.encode(table(spark, rows)).collect()
    assert sum(r.evaluations for r in found) < 0.6 * 8 * 16 * len(rows)


def test_huge_components(spark):
    rows = [(i, [1e300 * (-1) ** i, 5e8 * i, 1.0, 0.0], i % 2) for i in range(20)]
    clipped = [(i, [math.copysign(2.0**45, v[0]), *v[1:]], label) for i, v, label in rows]
    assert coded(table(spark, rows, "double")) == expected(clipped)


def test_nulls_infinities_and_lengths(spark):
    rng = random.Random(9)
    rows = [(i, rounded(rng, 8), 1) for i in range(40)]
    bad = [(1, None, 1), (2, [None] * 8, 1), (3, [math.inf] * 8, 1), (4, [math.nan] * 8, 1), (5, [], 1), (6, [1.0], 1)]
    assert coded(table(spark, rows + bad)) == expected(rows)


def test_empty_table(spark):
    assert codes.encode(table(spark, [])).collect() == []
    assert codes.encode(table(spark, [(1, None, 2)])).collect() == []
