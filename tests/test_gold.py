import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from curbsight.functions import snap_round
from curbsight.operators import audit, fallback, gold, silver
from curbsight.plans import medallion
from curbsight.sources import adapters, csv_files, storage
from tests.helpers import plan, rows, values

SILVER = """property_id string, property_name string, property_type string, service_category string,
    csat_score bigint, resolution_time_hours double, contract_value int, missed_pickups_30d int, renewal_date date"""


def ticket(pid="P1", csat=5, hours=1.0, contract=10000, missed=0, kind="a", category="x"):
    return (pid, f"name {pid}", kind, category, csat, hours, contract, missed, dt.date(2024, 3, 1))


@pytest.fixture(scope="module")
def silver_df(spark, sf_dir):
    return silver.to_silver(adapters.tickets(spark, sf_dir), adapters.AS_OF)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert sorted(map(str, rows(a.select(columns)))) == sorted(map(str, rows(b.select(columns))))


def test_tables_from_base_equal_direct_tables(silver_df):
    tables = medallion.gold_tables(silver_df)
    same(tables["gold_churn_risk"], gold.churn_risk(silver_df))
    same(tables["gold_service_performance"], gold.service_performance(silver_df))
    same(tables["gold_property_health"], gold.property_health(silver_df))


def test_grain_and_totals(silver_df):
    assert audit.duplicate_keys(gold.churn_risk(silver_df)).count() == 0
    health, service = gold.property_health(silver_df), gold.service_performance(silver_df)
    assert audit.duplicate_keys(health, gold.HEALTH_KEYS).count() == 0
    assert health.count() == service.count() == 326
    assert health.agg(F.sum("total_complaints")).first()[0] == silver_df.count()


@pytest.mark.parametrize(
    "average, missed, label",
    [(2.5, 0, "high"), (3.5, 0, "medium"), (3.51, 0, "low"), (4.0, 8, "high"), (4.0, 4, "medium"),
     (None, 0, "low"), (None, 8, "high")],
)
def test_property_label(spark, average, missed, label):
    df = spark.createDataFrame([(average, missed)], "a double, m int")
    assert rows(df.select(gold.property_risk_label(F.col("a"), F.col("m")))) == [(label,)]


def test_label_uses_the_rounded_average(spark):
    # 501/200 = 2.505 rounds to 2.51; 1001/400 = 2.5025 rounds to 2.5.
    scores = [ticket("A", 3)] * 101 + [ticket("A", 2)] * 99 + [ticket("B", 3)] * 201 + [ticket("B", 2)] * 199
    found = gold.churn_risk(spark.createDataFrame(scores, SILVER)).select("property_id", "avg_csat", "churn_risk_label")
    assert sorted(rows(found)) == [("A", 2.51, "medium"), ("B", 2.5, "high")]


@pytest.mark.parametrize("value, expected", [(1.005, 1.01), (2.005, 2.01), (24.505, 24.51)])
def test_ties_round_up(spark, value, expected):
    below = value - 1e-12
    df = spark.createDataFrame([(value,), (below,)], "v double")
    assert rows(df.select(snap_round(F.col("v"), 2))) == [(expected,), (expected,)]


def test_property_without_scores(spark):
    df = spark.createDataFrame([ticket(csat=None, hours=None)], SILVER)
    tables = medallion.gold_tables(df)
    churn = tables["gold_churn_risk"].first()
    assert (churn.avg_csat, churn.churn_risk_label) == (None, "low")
    assert tables["gold_service_performance"].first().avg_resolution_time is None


def test_one_property_with_a_third_of_all_tickets(spark):
    hot = spark.range(30_000).selectExpr("'HOT' AS property_id", "id % 5 + 1 AS csat_score", "id")
    rest = spark.range(60_000).selectExpr("concat('P', id % 500) AS property_id", "id % 5 + 1 AS csat_score", "id")
    df = hot.unionByName(rest).selectExpr(
        "property_id", "'n' AS property_name", "'t' AS property_type", "'c' AS service_category", "csat_score",
        "cast(id % 7 AS double) AS resolution_time_hours", "10000 AS contract_value", "1 AS missed_pickups_30d",
        "date'2024-03-01' AS renewal_date",
    )
    churn = gold.churn_risk(df)
    assert churn.count() == 501
    assert churn.where("property_id = 'HOT'").first().complaint_count == 30_000
    assert "partial_count" in plan(churn)


def test_nightly_run_from_ticket_files(spark, sf_dir, tmp_path):
    tickets = adapters.tickets(spark, sf_dir)
    csv_files.write_tickets(tickets, str(tmp_path / "in"))
    export = str(tmp_path / "export")
    for _ in range(2):  # a rerun replaces everything
        figures = medallion.run_nightly(
            spark, str(tmp_path / "in"), adapters.AS_OF, export, str(tmp_path / "tables")
        )
    assert dict(rows(figures["row_counts"])) == {
        "bronze_tickets": 1000, "silver_tickets": 1000, "gold_churn_risk": 15,
        "gold_service_performance": 326, "gold_property_health": 326,
    }
    assert figures["duplicates"].count() == 0
    assert figures["null_profile"].first().csat_score == tickets.where("csat_score IS NULL").count()
    assert csv_files.read_rag(spark, export).count() == 1000
    same(spark.table("gold_churn_risk"), gold.churn_risk(silver.to_silver(tickets, adapters.AS_OF)))

    ordered = csv_files.read_rag_in_order(spark, export)
    by_file = fallback.churn_counts(ordered, "ingest_order")
    same(by_file, fallback.churn_counts(silver.to_silver(tickets, adapters.AS_OF), "ticket_id"))


def test_nightly_run_leaves_no_scratch(spark, sf_dir, tmp_path):
    csv_files.write_tickets(adapters.tickets(spark, sf_dir), str(tmp_path / "in"))
    own = storage._own_folder(spark)
    before = set(os.listdir(own)) if os.path.isdir(own) else set()
    medallion.run_nightly(spark, str(tmp_path / "in"), adapters.AS_OF, str(tmp_path / "export"), str(tmp_path / "tables"))
    assert (set(os.listdir(own)) if os.path.isdir(own) else set()) == before


def test_lenient_nightly_run_keeps_malformed_ids_aside(spark, sf_dir, tmp_path):
    bad = F.when(F.col("ticket_id") < 3, "BAD").otherwise(F.col("customer_id"))
    csv_files.write_tickets(adapters.tickets(spark, sf_dir).withColumn("customer_id", bad), str(tmp_path / "in"))
    given = (spark, str(tmp_path / "in"), adapters.AS_OF, str(tmp_path / "export"), str(tmp_path / "tables"))
    with pytest.raises(Exception, match="BAD|CAST_INVALID_INPUT"):
        medallion.run_nightly(*given)
    figures = medallion.run_nightly(*given, strict=False)
    counts = dict(rows(figures["row_counts"]))
    assert counts["quarantined_tickets"] == 3 and counts["silver_tickets"] == 1000
    assert sorted(values(spark.table("quarantined_tickets"), "ticket_id")) == [0, 1, 2]
    assert spark.table("silver_tickets").where("property_name IS NULL").count() == 3


def test_duplicate_keys_are_reported(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "property_id string")
    assert rows(audit.duplicate_keys(df)) == [("A", 2)]


def test_null_profile_is_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    profile = audit.null_profile(df)
    assert plan(profile).count("Scan") == 1
    assert rows(profile) == [(1, 2)]


def test_churn_reads_only_its_columns(spark, sf_dir, silver_df):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,props:string>" in plan(gold.churn_risk(silver_df))
