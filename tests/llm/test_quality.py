import math
import random

import numpy as np
import pytest

from curbsight.llm import quality
from curbsight.llm.common import read
from curbsight.llm.queries import QUERIES


def gaussian(x, mean, covariance):
    d = x - mean
    return -0.5 * d @ np.linalg.inv(covariance) @ d - 0.5 * math.log(np.linalg.det(covariance))


def test_log_odds_against_the_formula(monkeypatch):
    monkeypatch.setattr(quality, "SHRINK_TO_POOLED", 0.0)
    monkeypatch.setattr(quality, "SHRINK_TO_SPHERE", 0.0)
    size, rng = len(quality.STATISTICS), np.random.default_rng(1)
    x = {k: rng.normal(k, 1 + k, (4_000_000 // 100, size)) for k in (0, 1)}
    model = quality.Discriminant({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()})
    probe = rng.normal(0.5, 1, (20, size))
    wanted = [gaussian(p, x[1].mean(0), np.cov(x[1].T, bias=True)) - gaussian(p, x[0].mean(0), np.cov(x[0].T, bias=True)) for p in probe]
    assert model.log_odds(probe) == pytest.approx(wanted, rel=0.02, abs=0.3)


def test_held_out_rows_are_told_apart(spark, sf_dir):
    data = sf_dir.replace("0.001", "0.1")
    found = QUERIES["op8_quality_classifier"](spark, data).where("held_out")
    rows = found.join(read(spark, data, "labels"), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.99 and np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_goes_by_the_checksum_of_the_id(spark):
    import zlib

    rows = spark.range(500).select("id", quality.held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, stats string")


def test_odd_rows(spark, docs):
    rng = random.Random(1)
    fine = [(i, " ".join(rng.choice(["one", "two", "Three."]) for _ in range(40))) for i in range(30)]
    junk = [(100 + i, "BUY!!! " * rng.randint(10, 40)) for i in range(30)]
    rows = [*fine, *junk, (200, None), (201, ""), (202, "word " * 200_000), (None, "BUY!!! " * 30), (fine[0][0], fine[0][1])]
    labels = labelled(spark, [(i, 1, "") for i, _ in fine] + [(i, 0, "") for i, _ in junk] + [(0, None, ""), (1, 7, ""), (None, 1, ""), (999, 0, "")])
    frame = docs(rows, "score", "stats", "predicted")
    found = quality.scored(frame, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.doc_id < 100) for r in found if r.doc_id is not None and r.doc_id < 200)
    kept = quality.accepted(frame, labels)
    assert kept.columns == frame.columns
    wanted = sorted((str(r.doc_id) for r in found if r.predicted))
    assert sorted(str(r.doc_id) for r in kept.collect()) == wanted


def test_without_usable_labels(spark, docs):
    none = labelled(spark, [])
    assert [r.score for r in quality.scored(docs([(1, "a")]), none).collect()] == [0.5]
    assert quality.scored(docs([]), none).collect() == []
    assert [r.score for r in quality.scored(docs([(1, "a")]), labelled(spark, [(1, 1, "")])).collect()] == [1.0]
