"""The pipeline against plain versions of its stages, each on the stored result of the one before."""

import math
import zlib

import numpy as np
import pytest
from llm import test_line_dedup as repeats
from llm import test_near_dedup as near
from llm import test_packing as sequences

import corpus_pipeline
from curbsight.llm import line_dedup, quality
from curbsight.llm.common import read
from curbsight.sources.storage import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def accepted(docs, labels):
    """By the textbook formulas, class by class and row by row."""
    x = {r.doc_id: np.array(quality.statistics(r.text or "")) for r in docs}
    known = [(x[r.doc_id], r.quality) for r in labels if r.doc_id in x and zlib.crc32(str(r.doc_id).encode()) % 5 and r.quality in (0, 1)]
    every = np.array([v for v, _ in known])
    centre, scale, size = every.mean(0), np.maximum(every.std(0), 1e-3), every.shape[1]
    own = {k: (np.array([v for v, q in known if q == k]) - centre) / scale for k in (0, 1)}
    pooled = sum(len(v) * np.cov(v.T, bias=True) for v in own.values()) / len(known)

    def density(z, k):
        share = (1 - quality.SHRINK_TO_POOLED) * len(own[k]) / (len(own[k]) + size)
        c = share * np.cov(own[k].T, bias=True) + (1 - share) * pooled
        c = (1 - quality.SHRINK_TO_SPHERE) * c + quality.SHRINK_TO_SPHERE * np.trace(c) / size * np.eye(size)
        d = z - own[k].mean(0)
        return math.log(len(own[k]) / len(known)) - 0.5 * (np.linalg.slogdet(c)[1] + d @ np.linalg.solve(c, d))

    odds = {i: density(z, 1) - density(z, 0) for i, v in x.items() for z in [np.clip((v - centre) / scale, -quality.CLIP, quality.CLIP)]}
    return {i for i, o in odds.items() if o >= math.log(quality.THRESHOLD / (1 - quality.THRESHOLD))}


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """What goes into each stage, and what the last gives."""
    docs = read(spark, sf_dir, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], sf_dir), name))
    return kept


def test_stages_are_the_named_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "best_fit_packing"]


def test_all_but_the_last_keep_the_columns(results):
    assert all(df.columns == COLUMNS and df.schema == results[0].schema for df in results[:-1])


def test_quality(spark, sf_dir, results):
    before, after = results[0].collect(), results[1].collect()
    wanted = accepted(before, read(spark, sf_dir, "labels").collect())
    assert sorted(r.doc_id for r in after) == sorted(wanted) and len(after) < len(before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_lines(results):
    rows = [(r.doc_id, r.text) for r in results[1].collect()]
    wanted = repeats.expected(rows, line_dedup.RUN_WORDS)
    found = results[2].collect()
    assert {r.doc_id: r.text for r in found} == {i: text for i, (text, _) in wanted.items()}
    assert any(n for _, n in wanted.values())
    assert all(r.n_chars == len(r.text) for r in found if wanted[r.doc_id][1])


def test_near_duplicates(results):
    rows = [(r.doc_id, r.text) for r in results[2].collect()]
    label = near.expected_fast(rows)
    assert sorted(r.doc_id for r in results[3].collect()) == sorted(set(label.values()))


def test_packing(results):
    sequences.check([(r.doc_id, r.text) for r in results[3].collect()], results[4].collect())


def test_run_gives_the_last_stage(spark, sf_dir, results):
    found = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(found.select(key).collect()) == sorted(results[4].select(key).collect())


def test_empty_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
        docs = materialize(docs, "empty")


def test_odd_rows_pass_through(spark, sf_dir, docs):
    """Nulls, repeated rows, long texts and further columns with clashing names."""
    rows = [(1, None), (2, ""), (None, "a text"), (3, "same words here"), (3, "same words here"), (4, "long " * 50_000), (5, "Same words, here!")]
    frame = docs(rows, "keys", "score", "removed_lines", "hash")
    for name, stage in corpus_pipeline.STAGES:
        following = stage(spark, frame, sf_dir)
        if name != "best_fit_packing":
            assert following.columns == frame.columns
        frame = materialize(following, name)
    assert frame.count() > 0
