import hashlib
import random

import pytest

from curbsight.llm import fixity

SCHEMA = "archive string, offset long, record binary, hash string, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def sha(parts):
    one = [hashlib.sha256(p or b"").hexdigest() for p in parts]
    return one[0] if len(one) == 1 else hashlib.sha256("".join(sorted(one)).encode()).hexdigest()


def expected(left, right):
    sides = []
    for rows in (left, right):
        places = {}
        for archive, offset, record in rows:
            if archive is not None and offset is not None:
                places.setdefault((archive, offset), []).append(record)
        sides.append({k: sha(v) for k, v in places.items()})
    status = lambda k: "left only" if k not in sides[1] else "right only" if k not in sides[0] else "changed"
    return {(*k, status(k), sides[0].get(k), sides[1].get(k)) for k in {*sides[0], *sides[1]} if sides[0].get(k) != sides[1].get(k)}


def audited(spark, left, right):
    return {(r.archive, r.offset, r.status, r.left_hash, r.right_hash) for r in fixity.audit(frame(spark, left), frame(spark, right)).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_against_comparing_all(spark, monkeypatch, seed):
    monkeypatch.setattr(fixity, "RANGE_BYTES", 64)
    monkeypatch.setattr(fixity, "FAN", 3)
    rng = random.Random(seed)
    left = [(f"a{a}", 30 * n, bytes([n % 251])) for a in range(3) for n in range(200)]
    right = [(a, o, r + b"!" if rng.random() < 0.02 else r) for a, o, r in left if rng.random() > 0.01]
    right += [("a1", 30 * 5000, b"new"), ("a9", 0, b"whole archive")]
    assert audited(spark, left, right) == expected(left, right)


def test_odd_rows(spark):
    left = [("a", 0, b"x"), ("a", 0, b"y"), ("a", 5, None), (None, 1, b"z"), ("a", None, b"z"), ("b", 1 << 40, b"far"), ("c", 0, b"c" * 1_000_000)]
    right = [("a", 0, b"y"), ("a", 0, b"x"), ("a", 5, b""), ("b", 1 << 40, b"fat"), ("c", 0, b"c" * 999_999)]
    assert audited(spark, left, right) == expected(left, right)
    assert audited(spark, left, left) == set()
    assert audited(spark, [], []) == set()
    assert audited(spark, left, []) == expected(left, [])


def test_only_differing_branches_are_compared(spark, monkeypatch):
    monkeypatch.setattr(fixity, "RANGE_BYTES", 64)
    monkeypatch.setattr(fixity, "FAN", 4)
    compared = []
    original = fixity._different

    def counting(left, right, keys):
        compared.append(left.count())
        return original(left, right, keys)

    monkeypatch.setattr(fixity, "_different", counting)
    left = [(f"a{a}", 64 * n, bytes([n % 251])) for a in range(4) for n in range(256)]
    right = [(a, o, b"bad" if (a, o) == ("a2", 64 * 77) else r) for a, o, r in left]
    assert audited(spark, left, right) == expected(left, right)
    assert compared[0] == 4 and all(n <= 4 for n in compared[1:])


def test_records_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "é"), (0, None, None), (0, None, None), (None, "v", "w"), (5000, "x", "y")], "page_id long, url string, html string")
    rows = sorted(fixity.warc_records(pages).collect(), key=lambda r: (r.archive, r.offset))
    assert [(r.archive, r.offset) for r in rows if r.archive == "0"][:2] == [("0", 0), ("0", len(rows[0].record))]
    assert b"Content-Length: 2\r\n\r\n" + "é".encode() in rows[2].record
    assert {r.archive[:5] for r in rows} == {"0", "1", "none-"}
    assert fixity.warc_records(pages.limit(0)).count() == 0
