"""Frames behind the dashboard: KPIs, alerts, filters and chart inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import dollars, exact_mean, exact_sum, number_text


def churn_view(churn: DataFrame) -> DataFrame:
    """The dashboard's seven churn columns, the date as text."""
    return churn.select(
        "property_name",
        "churn_risk_label",
        "complaint_count",
        "avg_csat",
        "missed_pickups_30d",
        "contract_value",
        F.date_format("renewal_date", "yyyy-MM-dd").alias("renewal_date"),
    )


def kpi_cards(churn: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Portfolio figures, every property counting once: one row, or one per group of ``by``.

    Without properties the sums are 0, the averages null and their texts say so.
    """
    figures = churn.groupBy(*by).agg(
        _sum_or_zero(F.when(_high(), F.col("contract_value"))).alias("revenue_at_risk"),
        F.count(F.when(_high(), 1)).alias("high_risk_count"),
        exact_mean(F.col("avg_csat")).alias("avg_csat"),
        F.avg("missed_pickups_30d").alias("avg_missed_pickups"),
    )
    return figures.select(
        "*",
        dollars(F.col("revenue_at_risk")).alias("revenue_text"),
        F.concat(number_text(F.col("avg_csat"), 2), F.lit(" / 5.0")).alias("csat_text"),
        number_text(F.col("avg_missed_pickups"), 1).alias("missed_text"),
    )


def urgent_renewals(churn: DataFrame, as_of: dt.date, days: int = fv.RENEWAL_NOTICE_DAYS) -> DataFrame:
    """Count and revenue of high-risk properties whose renewal is at most ``days`` ahead."""
    urgent = churn.where(_high() & (F.col("renewal_date") <= F.date_add(F.lit(as_of), days)))
    return urgent.agg(
        F.count("*").alias("renewing_count"),
        _sum_or_zero(F.col("contract_value")).alias("renewing_revenue"),
    ).withColumn("renewing_revenue_text", dollars(F.col("renewing_revenue")))


def lowest_csat(churn: DataFrame) -> DataFrame:
    """The property with the lowest known score; unscored ones come last."""
    return (
        churn.orderBy(F.asc_nulls_last("avg_csat"), F.asc("property_id"))
        .limit(1)
        .select("property_id", "property_name", "avg_csat", "missed_pickups_30d")
    )


def bottleneck(rollup: DataFrame) -> DataFrame:
    """Category with most complaints, and the plain mean of the category resolution times."""
    first = F.struct(-F.col("total_complaints"), F.col("service_category"))
    return rollup.agg(
        F.min_by("service_category", first).alias("service_category"),
        F.max("total_complaints").alias("total_complaints"),
        F.avg("avg_resolution_time").alias("avg_resolution_time"),
    )


def filter_portfolio(
    churn: DataFrame, risks: Sequence[str] = ("high", "medium", "low"), search: str = "", regex: bool = False
) -> DataFrame:
    """Rows with one of the labels whose name holds the search text, upper or lower case.

    The text is taken literally; ``regex`` treats it as a pattern, and a
    broken pattern then fails the query.
    """
    kept = churn.where(F.col("churn_risk_label").isin(list(risks)))
    if not search.strip():
        return kept
    name = F.col("property_name")
    if regex:
        return kept.where(name.rlike(f"(?iu){search}"))
    return kept.where(F.contains(F.lower(name), F.lower(F.lit(search))))


def risk_distribution(churn: DataFrame) -> DataFrame:
    return churn.groupBy("churn_risk_label").agg(F.count("*").alias("count"))


def category_bars(rollup: DataFrame) -> DataFrame:
    return rollup.select("service_category", "total_complaints").orderBy("total_complaints", "service_category")


def scatter(churn: DataFrame) -> DataFrame:
    return churn.select("missed_pickups_30d", "avg_csat", "contract_value", "churn_risk_label", "property_name")


def missed_series(churn: DataFrame) -> DataFrame:
    return churn.select("property_name", "missed_pickups_30d")


def leaderboard(churn: DataFrame) -> DataFrame:
    """All properties, most complaints first, under display titles."""
    ranked = churn.orderBy(F.desc("complaint_count"), F.asc("property_id"))
    shown = ranked.withColumn("renewal_date", F.date_format("renewal_date", "yyyy-MM-dd"))
    return shown.select(*[F.col(c).alias(title) for c, title in fv.LEADERBOARD_TITLES.items()])


def _high() -> Column:
    return F.col("churn_risk_label") == "high"


def _sum_or_zero(value: Column) -> Column:
    return F.coalesce(exact_sum(value), F.lit(0.0))
