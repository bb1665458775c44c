"""The seven fixed questions over the gold tables.

Each report has a full order, kept in ``position``: ties fall back on the
property id and the place of nulls is spelled out. ``orderBy`` with ``limit``
plans as a top-k per task, so no report sorts a whole table; only the rows
that are left get numbered.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import exact_mean, snap_round
from curbsight.sources import storage


def high_churn(churn: DataFrame, n: int = fv.TOP_N) -> DataFrame:
    rows = churn.where(F.col("churn_risk_label") == "high").select(
        "property_id", "property_name", "churn_risk_label", "complaint_count", "avg_csat",
        "missed_pickups_30d", "contract_value",
    )
    return top(rows, [F.desc("complaint_count"), F.asc("property_id")], n)


def low_csat(churn: DataFrame, n: int = fv.TOP_N) -> DataFrame:
    rows = churn.select("property_id", "property_name", "avg_csat", "complaint_count", "churn_risk_label")
    return top(rows, [F.asc_nulls_first("avg_csat"), F.asc("property_id")], n)


def most_missed_pickups(churn: DataFrame, n: int = fv.TOP_N) -> DataFrame:
    rows = churn.select(
        "property_id", "property_name", "missed_pickups_30d", "churn_risk_label", "avg_csat", "complaint_count"
    )
    return top(rows, [F.desc_nulls_last("missed_pickups_30d"), F.asc("property_id")], n)


def contract_at_risk(churn: DataFrame, n: int = fv.TOP_N) -> DataFrame:
    rows = churn.where(F.col("churn_risk_label") == "high").select(
        "property_id", "property_name", "contract_value", "churn_risk_label", "avg_csat", "renewal_date"
    )
    return top(rows, [F.desc_nulls_last("contract_value"), F.asc("property_id")], n)


def renewing_soon(
    churn: DataFrame, as_of: dt.date, n: int = fv.TOP_N, days: int = fv.RENEWAL_NOTICE_DAYS
) -> DataFrame:
    """Renewals up to ``days`` ahead. Overdue ones count as soon; see :func:`renewal_window`."""
    return _renewals(churn.where(F.col("renewal_date") <= F.date_add(F.lit(as_of), days)), n)


def renewal_window(
    churn: DataFrame, as_of: dt.date, n: int = fv.TOP_N, days: int = fv.RENEWAL_NOTICE_DAYS
) -> DataFrame:
    """Renewals from ``as_of`` up to ``days`` ahead, overdue ones left out."""
    inside = F.col("renewal_date").between(F.lit(as_of), F.date_add(F.lit(as_of), days))
    return _renewals(churn.where(inside), n)


def service_rollup(service: DataFrame) -> DataFrame:
    """Measures per category. The averages are means of property averages, each property
    counting once whatever its ticket count, and missed pickups add up over all rows."""
    return service.groupBy("service_category").agg(
        F.sum("total_complaints").alias("total_complaints"),
        exact_mean(F.col("avg_csat")).alias("avg_csat"),
        exact_mean(F.col("avg_resolution_time")).alias("avg_resolution_time"),
        F.sum("total_missed_pickups").alias("total_missed_pickups"),
    )


def service_by_category(service: DataFrame) -> DataFrame:
    return top(service_rollup(service), [F.desc("total_complaints"), F.asc("service_category")], None)


def health_rollup(health: DataFrame) -> DataFrame:
    """Measures per name and type; properties that share a name fall together."""
    return health.groupBy("property_name", "property_type").agg(
        F.sum("total_complaints").alias("total_complaints"),
        exact_mean(F.col("avg_csat")).alias("avg_csat"),
        F.sum("total_missed_pickups").alias("total_missed_pickups"),
    )


def worst_health(health: DataFrame, n: int = fv.TOP_N) -> DataFrame:
    order = [F.desc("total_complaints"), F.asc("property_name"), F.asc("property_type")]
    return top(health_rollup(health), order, n)


def service_rollup_per_ticket(base: DataFrame) -> DataFrame:
    """Category measures that weigh every ticket alike and count each property's missed
    pickups once per category."""
    per_property = base.groupBy("service_category", "property_id").agg(
        *[F.sum(c).alias(c) for c in ("tickets", "csat_sum", "csat_count", "hours_sum", "hours_count")],
        F.max("missed_pickups").alias("missed_pickups"),
    )
    return per_property.groupBy("service_category").agg(
        F.sum("tickets").alias("total_complaints"),
        _weighted("csat").alias("avg_csat"),
        _weighted("hours").alias("avg_resolution_time"),
        F.sum("missed_pickups").alias("total_missed_pickups"),
    )


def top(rows: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows with their position; without ``n`` only for results that are small
    by nature, such as one row per category."""
    kept = rows if n is None else rows.orderBy(*order).limit(n)
    return kept.select(F.row_number().over(Window.orderBy(*order)).alias("position"), *rows.columns)


def numbered(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """All rows with their position in ``order``, which should end in a unique column.

    Rows are parted by ranges of the order and written with the number of their range, which
    keeps it the same when a task runs again. Each range is numbered by itself and starts
    after the rows of those before it; only one count per range reaches the driver. Rows that
    tie in all of ``order`` are in one range and get positions in any order. ``rows`` may have
    any columns, ``position`` is replaced; an empty table gives no rows.
    """
    rows = rows.drop("position")
    part, columns = "__range", [F.col(f"`{c}`") for c in rows.columns]
    ranged = rows.repartitionByRange(*order).select(F.spark_partition_id().alias(part), "*")
    ranged = storage.materialize(ranged, "ranges")
    counts = sorted(tuple(r) for r in ranged.groupBy(part).count().collect())  # one row per range
    before, offsets = 0, []
    for number, count in counts:
        offsets.append((number, before))
        before += count
    starts = rows.sparkSession.createDataFrame(offsets, f"{part} int, __before long")
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    placed = ranged.withColumn("__within", within).join(starts, part)
    return placed.select((F.col("__before") + F.col("__within")).alias("position"), *columns)


def portfolio_ranks(churn: DataFrame) -> DataFrame:
    """Every property with its place by complaints, not only the first ones."""
    rows = churn.select("property_id", "property_name", "churn_risk_label", "complaint_count", "avg_csat")
    return numbered(rows, [F.desc("complaint_count"), F.asc("property_id")])


def _renewals(churn: DataFrame, n: int) -> DataFrame:
    rows = churn.select(
        "property_id", "property_name", "renewal_date", "churn_risk_label", "contract_value", "avg_csat"
    )
    return top(rows, [F.asc("renewal_date"), F.asc("property_id")], n)


def _weighted(measure: str) -> Column:
    return snap_round(F.try_divide(F.sum(f"{measure}_sum").cast("double"), F.sum(f"{measure}_count")), 6)
