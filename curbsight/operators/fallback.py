"""Figures derived from the retrieval export alone, for when no gold table is at hand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import code_point_sum, pick


def property_name(
    property_id: Column,
    known: Mapping[str, str] = fv.KNOWN_FALLBACK_NAMES,
    prefixes: Sequence[str] = fv.FALLBACK_NAME_PREFIXES,
    suffixes: Sequence[str] = fv.FALLBACK_NAME_SUFFIXES,
) -> Column:
    """A stable name from the digits of an id, or from its characters if it has none.

    With ten prefixes and nine suffixes the number itself is not needed: its
    last digit picks the prefix, and what is left of it modulo nine, which is
    its digit sum modulo nine, picks the suffix. So ids of any length work.
    """
    if len(prefixes) != 10 or len(suffixes) != 9:
        raise ValueError("names need ten prefixes and nine suffixes")
    found = F.regexp_replace(property_id, "[^0-9]", "")
    digits = F.when(found != "", found).otherwise(code_point_sum(property_id).cast("string"))
    rest = F.regexp_replace(digits, "[0-9]$", "")
    digit_sum = code_point_sum(rest) - F.length(rest) * 48
    made = F.concat(
        pick(prefixes, F.substring(digits, -1, 1).cast("int")), F.lit(" "), pick(suffixes, digit_sum % 9)
    )
    if not known:
        return made
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[property_id], made)


def property_type(name: Column, types: Sequence[str] = fv.FALLBACK_PROPERTY_TYPES) -> Column:
    return pick(types, code_point_sum(name) % len(types))


def churn_counts(export: DataFrame, order: str) -> DataFrame:
    """Tickets and first label per property, under made-up names.

    ``order`` says which row comes first; "first" alone would depend on how
    the input happens to be split.
    """
    label = F.lower(F.coalesce("churn_risk_label", F.lit(fv.FALLBACK_LABEL)))
    # Per label first: that step hashes, and leaves a few rows per property for the
    # choice of a text, for which Spark has to sort.
    per_label = (
        export.where(F.col("property_id").isNotNull())
        .groupBy("property_id", label.alias("label"))
        .agg(F.count("*").alias("tickets"), F.min(order).alias("first_seen"))
    )
    per_property = per_label.groupBy("property_id").agg(
        F.sum("tickets").alias("complaint_count"), F.min_by("label", "first_seen").alias("churn_risk_label")
    )
    return per_property.withColumn("property_name", property_name(F.col("property_id"))).drop("property_id")


def service_counts(export: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Tickets per category. Rows without a category are left out, unless
    ``keep_missing`` books them under the default category."""
    if keep_missing:
        export = export.withColumn("service_category", F.coalesce("service_category", F.lit(fv.FALLBACK_CATEGORY)))
    else:
        export = export.where(F.col("service_category").isNotNull())
    return export.groupBy("service_category").agg(F.count("*").alias("total_complaints"))


def pickup_share(category: Column) -> Column:
    """Share of all missed pickups booked on a category, by the words in its name."""
    name = F.lower(category)
    share = F.when(F.lit(False), F.lit(0.0))
    for value, words in fv.PICKUP_SHARES:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(name, F.lit(word))
        share = share.when(hit, F.lit(value))
    return share.otherwise(F.lit(fv.OTHER_PICKUP_SHARE))


def category_pickups(categories: DataFrame, churn: DataFrame) -> DataFrame:
    """Missed pickups per category: its share of the portfolio total, cut to a whole number."""
    total = churn.agg(F.sum("missed_pickups_30d")).scalar()
    pickups = (total * pickup_share(F.col("service_category"))).cast("int")
    return categories.withColumn("total_missed_pickups", pickups)


def health(churn: DataFrame) -> DataFrame:
    """Health columns per churn row, not rolled up, with a type made from the name."""
    return churn.select(
        "property_name",
        property_type(F.col("property_name")).alias("property_type"),
        F.col("complaint_count").alias("total_complaints"),
        "avg_csat",
        F.col("missed_pickups_30d").alias("total_missed_pickups"),
    )
