"""Queries that write, where spark.checkpoint.dir is a plain path that all executors of a cluster see."""

import os

import pytest

from curbsight.plans.queries import QUERIES
from curbsight.sources import storage

WRITING = [
    "answer_texts",
    "bronze_csv_by_name",
    "bronze_csv_rejects",
    "bronze_csv_scan",
    "bronze_table_roundtrip",
    "catalog_tables",
    "describe_gold",
    "embed_documents",
    "fallback_churn_from_export",
    "gold_churn_from_base",
    "gold_incremental",
    "gold_service_from_base",
    "gold_snapshot",
    "gold_table_roundtrip",
    "index_roundtrip",
    "knn_blocks",
    "knn_cells",
    "knn_preview",
    "knn_text",
    "portfolio_ranks",
    "question_state",
    "rag_context",
]


@pytest.fixture
def plain_path(spark, tmp_path, monkeypatch):
    context, made, get = spark.sparkContext, tmp_path / "made", type(spark.conf).get
    made.mkdir()
    monkeypatch.setattr(context, "master", "local-cluster[2,1,1024]")
    monkeypatch.setattr(context, "getCheckpointDir", lambda: f"file:{made}")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: str(tmp_path) if key == storage.CHECKPOINT_SETTING else get(self, key, *a))
    return tmp_path


@pytest.mark.parametrize("name", WRITING)
def test_it_writes_there(spark, sf_dir, plain_path, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert os.listdir(plain_path / "curbsight" / spark.sparkContext.applicationId)
