import pytest
from pyspark.sql import functions as F

from curbsight.operators import gold, silver
from curbsight.plans import medallion
from curbsight.sources import adapters, snapshots
from curbsight.sources.adapters import AS_OF
from curbsight.streaming import gold_stream
from tests.helpers import rows


@pytest.fixture
def name(spark):
    yield "published"
    spark.sql("DROP VIEW IF EXISTS published")


def test_readers_see_the_version_they_opened(spark, tmp_path, name):
    snapshots.publish(spark.range(3), name, str(tmp_path))
    opened = spark.table(name)
    snapshots.publish(spark.range(5).withColumn("more", F.lit("x")), name, str(tmp_path))
    assert opened.count() == 3 and spark.table(name).count() == 5 and spark.table(name).columns == ["id", "more"]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, name):
    first = snapshots.publish(spark.range(3), name, str(tmp_path))
    with pytest.raises(Exception, match="broken"):
        snapshots.publish(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")), name, str(tmp_path))
    assert spark.table(name).count() == 3 and snapshots.current(spark, name) == first


def test_old_versions_go_by_age(spark, tmp_path, name):
    assert snapshots.current(spark, name) is None and snapshots.versions(spark, name, str(tmp_path)) == []
    paths = [snapshots.publish(spark.range(n), name, str(tmp_path)) for n in (1, 2, 3)]
    assert snapshots.versions(spark, name, str(tmp_path)) == paths
    assert snapshots.expire(spark, name, str(tmp_path), 3600) == []
    assert snapshots.expire(spark, name, str(tmp_path), -1) == paths[:2]
    assert snapshots.versions(spark, name, str(tmp_path)) == paths[2:] and spark.table(name).count() == 3


def in_order(df):
    return sorted(rows(df), key=str)


def test_gold_after_batches_is_gold_of_all_tickets(spark, sf_dir, folder):
    whole = silver.to_silver(adapters.tickets(spark, sf_dir), AS_OF)
    parts = [whole.where(F.col("ticket_id") % 4 == n) for n in range(4)]
    root = f"{folder}/state"
    for batch_id, part in [(0, parts[0]), (1, parts[1]), (1, parts[1]), (2, parts[2]), (5, parts[3]), (5, parts[3])]:
        gold_stream.apply_batch(part, batch_id, root)
    expected = medallion.gold_tables(whole)
    found = gold_stream.gold_tables(spark, root)
    assert set(found) == set(expected)
    for table, df in expected.items():
        assert in_order(found[table].select(df.columns)) == in_order(df)
    assert gold_stream.batches(spark, root) == [0, 1, 2, 5]
    gold_stream.forget(spark, root)
    assert gold_stream.batches(spark, root) == [2, 5]


def test_a_broken_batch_is_not_counted(spark, sf_dir, folder):
    whole = silver.to_silver(adapters.tickets(spark, sf_dir), AS_OF)
    root = f"{folder}/state"
    gold_stream.apply_batch(whole.limit(50), 0, root)
    with pytest.raises(Exception, match="broken"):
        gold_stream.apply_batch(whole.withColumn("csat_score", F.raise_error(F.lit("broken")).cast("long")), 1, root)
    assert gold_stream.batches(spark, root) == [0]
    gold_stream.apply_batch(whole.limit(0), 1, root)
    assert in_order(gold_stream.state(spark, root)) == in_order(gold.base_aggregate(whole.limit(50)))


def test_no_state_yet(spark, folder):
    with pytest.raises(ValueError, match="no batch"):
        gold_stream.state(spark, f"{folder}/none")


def test_old_tickets_are_not_read_again(spark, sf_dir, folder):
    whole = silver.to_silver(adapters.tickets(spark, sf_dir), AS_OF)
    gold_stream.apply_batch(whole, 0, f"{folder}/state")
    files = gold_stream.gold_tables(spark, f"{folder}/state")["gold_churn_risk"].inputFiles()
    assert files and all(f"{folder}/state" in f for f in files)
