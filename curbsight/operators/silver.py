"""Raw tickets to the silver table: rename, enrich, label.

Everything is a column expression, so the whole step is one narrow stage and
filters on derived columns still reach the scan through the projection.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import code_lookup, pick, property_number
from curbsight.sources.tables import mapping_table


def rename_columns(tickets: DataFrame) -> DataFrame:
    """Domain names for seven columns; all others stay as they are."""
    return tickets.withColumnsRenamed(fv.SILVER_RENAMES)


def property_name(
    property_id: Column, names: Sequence[str] = fv.PROPERTY_NAMES, strict: bool = True
) -> Column:
    return pick(names, F.pmod(property_number(property_id, strict), F.lit(len(names))))


def contract_value(property_id: Column) -> Column:
    return (F.abs(F.hash(property_id) % fv.CONTRACT_SPAN) + fv.CONTRACT_FLOOR).cast("int")


def missed_pickups(property_id: Column) -> Column:
    return F.abs(F.hash(property_id) % fv.MISSED_PICKUP_SPAN).cast("int")


def renewal_date(property_id: Column, as_of: dt.date) -> Column:
    return F.date_add(F.lit(as_of), F.abs(F.hash(property_id) % fv.RENEWAL_SPAN_DAYS).cast("int"))


def service_category(
    issue_type: Column,
    mapping: Mapping[str, str] = fv.SERVICE_CATEGORY_BY_ISSUE,
    default: str = fv.DEFAULT_SERVICE_CATEGORY,
) -> Column:
    return code_lookup(issue_type, mapping, default)


def ticket_risk_label(csat: Column, missed: Column) -> Column:
    """Label of one ticket. A missing score matches no score test."""
    return (
        F.when((csat <= 2) | (missed >= 8), "high")
        .when((csat == 3) | (missed >= 4), "medium")
        .otherwise("low")
    )


def to_silver(
    tickets: DataFrame,
    as_of: dt.date,
    names: Sequence[str] = fv.PROPERTY_NAMES,
    categories: Mapping[str, str] = fv.SERVICE_CATEGORY_BY_ISSUE,
    strict: bool = True,
) -> DataFrame:
    """All silver columns. ``as_of`` is the day renewals count from."""
    pid = F.col("property_id")
    return (
        rename_columns(tickets)
        .withColumns(
            {
                "property_name": property_name(pid, names, strict),
                "contract_value": contract_value(pid),
                "missed_pickups_30d": missed_pickups(pid),
                "renewal_date": renewal_date(pid, as_of),
                "service_category": service_category(F.col("issue_type"), categories),
            }
        )
        .withColumn("churn_risk_label", ticket_risk_label(F.col("csat_score"), F.col("missed_pickups_30d")))
    )


def malformed_ids(tickets: DataFrame, id_column: str = "customer_id") -> DataFrame:
    """Tickets whose id holds no number: the quarantine next to a lenient silver run."""
    return tickets.where(property_number(F.col(id_column), strict=False).isNull())


def category_table(
    spark: SparkSession, mapping: Mapping[str, str] = fv.SERVICE_CATEGORY_BY_ISSUE
) -> DataFrame:
    return mapping_table(spark, mapping, "issue_type", "service_category")


def with_category_from_table(
    tickets: DataFrame, categories: DataFrame, default: str = fv.DEFAULT_SERVICE_CATEGORY
) -> DataFrame:
    """The category as a lookup join, for mappings kept in a table.

    No hint: Spark broadcasts the table while its size allows, and shuffles
    otherwise.
    """
    joined = tickets.join(categories, "issue_type", "left")
    return joined.withColumn("service_category", F.coalesce("service_category", F.lit(default)))
