"""Silver tickets to the gold tables.

Two routes give equal rows. The direct functions aggregate silver once per
table. ``base_aggregate`` keeps unrounded sums and counts at the finest grain,
from which all three tables follow without another pass over silver.

All measures combine before the shuffle, so a property with a third of all
tickets costs each task one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.functions import ratio, snap_round

HEALTH_KEYS = ["property_id", "property_name", "property_type", "service_category"]
SERVICE_KEYS = ["service_category", "property_id", "property_name", "property_type"]
CHURN_KEYS = ["property_id", "property_name"]


def property_risk_label(avg_csat: Column, missed: Column) -> Column:
    """Label of one property, from its rounded average score."""
    return (
        F.when((avg_csat <= 2.5) | (missed >= 8), "high")
        .when((avg_csat <= 3.5) | (missed >= 4), "medium")
        .otherwise("low")
    )


def property_health(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*HEALTH_KEYS).agg(
        F.count("*").alias("total_complaints"),
        _average("csat_score").alias("avg_csat"),
        F.max("missed_pickups_30d").alias("total_missed_pickups"),
        _average("contract_value").alias("contract_value"),
    )


def churn_risk(silver: DataFrame) -> DataFrame:
    per_property = silver.groupBy(*CHURN_KEYS).agg(
        F.count("*").alias("complaint_count"),
        _average("csat_score").alias("avg_csat"),
        F.max("missed_pickups_30d").alias("missed_pickups_30d"),
        _average("contract_value").alias("contract_value"),
        F.max("renewal_date").alias("renewal_date"),
    )
    return _with_property_label(per_property)


def service_performance(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*SERVICE_KEYS).agg(
        F.count("*").alias("total_complaints"),
        _average("csat_score").alias("avg_csat"),
        _average("resolution_time_hours").alias("avg_resolution_time"),
        F.max("missed_pickups_30d").alias("total_missed_pickups"),
        _average("contract_value").alias("contract_value"),
    )


def base_aggregate(silver: DataFrame) -> DataFrame:
    """Sums, counts and maxima at the grain of the health and service tables."""
    return silver.groupBy(*HEALTH_KEYS).agg(
        F.count("*").alias("tickets"),
        F.sum("csat_score").alias("csat_sum"),
        F.count("csat_score").alias("csat_count"),
        F.sum("resolution_time_hours").alias("hours_sum"),
        F.count("resolution_time_hours").alias("hours_count"),
        F.sum("contract_value").alias("contract_sum"),
        F.count("contract_value").alias("contract_count"),
        F.max("missed_pickups_30d").alias("missed_pickups"),
        F.max("renewal_date").alias("renewal_date"),
    )


def health_from_base(base: DataFrame) -> DataFrame:
    return base.select(
        *HEALTH_KEYS,
        F.col("tickets").alias("total_complaints"),
        _base_average("csat").alias("avg_csat"),
        F.col("missed_pickups").alias("total_missed_pickups"),
        _base_average("contract").alias("contract_value"),
    )


def service_from_base(base: DataFrame) -> DataFrame:
    return base.select(
        *SERVICE_KEYS,
        F.col("tickets").alias("total_complaints"),
        _base_average("csat").alias("avg_csat"),
        _base_average("hours").alias("avg_resolution_time"),
        F.col("missed_pickups").alias("total_missed_pickups"),
        _base_average("contract").alias("contract_value"),
    )


def churn_from_base(base: DataFrame) -> DataFrame:
    sums = ["tickets", "csat_sum", "csat_count", "contract_sum", "contract_count"]
    per_property = base.groupBy(*CHURN_KEYS).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("missed_pickups").alias("missed_pickups_30d"),
        F.max("renewal_date").alias("renewal_date"),
    )
    return _with_property_label(
        per_property.select(
            *CHURN_KEYS,
            F.col("tickets").alias("complaint_count"),
            _base_average("csat").alias("avg_csat"),
            "missed_pickups_30d",
            _base_average("contract").alias("contract_value"),
            "renewal_date",
        )
    )


def _average(column: str) -> Column:
    return snap_round(F.avg(column), 2)


def _base_average(measure: str) -> Column:
    return snap_round(ratio(F.col(f"{measure}_sum"), F.col(f"{measure}_count")), 2)


def _with_property_label(per_property: DataFrame) -> DataFrame:
    label = property_risk_label(F.col("avg_csat"), F.col("missed_pickups_30d"))
    return per_property.withColumn("churn_risk_label", label)
