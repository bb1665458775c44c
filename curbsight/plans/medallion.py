"""The nightly job: raw tickets to silver, silver to the three gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from curbsight.operators import audit, gold, silver
from curbsight.sources import csv_files, jdbc, storage, tables

BRONZE_TABLE = "bronze_tickets"
SILVER_TABLE = "silver_tickets"
QUARANTINE_TABLE = "quarantined_tickets"
GOLD_TABLES = ["gold_churn_risk", "gold_service_performance", "gold_property_health"]


def gold_tables(silver_df: DataFrame) -> dict[str, DataFrame]:
    """All gold tables from one pass over silver.

    The base aggregate is written once. Health and service performance are
    projections of it and churn risk sums it up further, from rows that are
    few by then and so need no writing of their own. Silver is scanned
    and shuffled a single time, and a lost executor costs no more than
    re-reading files.
    """
    base = storage.materialize(gold.base_aggregate(silver_df), "gold-base")
    return {
        "gold_churn_risk": gold.churn_from_base(base),
        "gold_service_performance": gold.service_from_base(base),
        "gold_property_health": gold.health_from_base(base),
    }


def run_nightly(
    spark: SparkSession,
    ticket_path: str,
    as_of: dt.date,
    export_path: str,
    table_folder: str | None = None,
    target: jdbc.JdbcTarget | None = None,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Ticket files to tables, retrieval export and, with a target, published gold tables.

    Each step starts from the stored result of the one before. Gives back the
    load's figures: ``null_profile`` of bronze, ``row_counts`` of all tables
    and ``duplicates`` among the gold properties, which should be empty. A
    malformed id ends a strict load; a lenient one leaves its name empty, and
    ``row_counts`` has the number of such tickets, which are kept in the
    quarantine table. Intermediate tables are deleted at the end.
    """

    def store(df: DataFrame, name: str) -> DataFrame:
        path = None if table_folder is None else f"{table_folder.rstrip('/')}/{name}"
        tables.write_table(df, name, path)
        return tables.read_table(spark, name)

    bronze = store(csv_files.read_tickets(spark, ticket_path), BRONZE_TABLE)
    counted = {BRONZE_TABLE: bronze}
    if not strict:
        counted[QUARANTINE_TABLE] = store(silver.malformed_ids(bronze), QUARANTINE_TABLE)
    silver_df = store(silver.to_silver(bronze, as_of, strict=strict), SILVER_TABLE)
    csv_files.export_rag(silver_df, export_path)
    with storage.scratch(spark):
        stored = {name: store(df, name) for name, df in gold_tables(silver_df).items()}
    if target is not None:
        jdbc.publish(stored, target)
    return {
        "null_profile": audit.null_profile(bronze),
        "row_counts": tables.row_counts({**counted, SILVER_TABLE: silver_df, **stored}),
        "duplicates": audit.duplicate_keys(stored["gold_churn_risk"]),
    }
