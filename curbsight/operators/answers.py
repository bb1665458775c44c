"""Report rows as answer text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import dollars, rounded, text_or_none
from curbsight.sources.tables import mapping_table


def _line(*parts: tuple[str, Column]) -> Column:
    texts = [F.concat(F.lit(f"{title}: "), text_or_none(value)) for title, value in parts]
    return F.concat_ws(" | ", *texts)


def line_formats() -> dict[str, Column]:
    """Text of one report row, by intent."""
    col = F.col
    return {
        "high churn risk": _line(
            ("Property", col("property_name")),
            ("Complaints", col("complaint_count")),
            ("CSAT", col("avg_csat")),
            ("Missed Pickups", col("missed_pickups_30d")),
            ("Contract", dollars(col("contract_value"))),
        ),
        "low csat": _line(
            ("Property", col("property_name")),
            ("CSAT", col("avg_csat")),
            ("Complaints", col("complaint_count")),
            ("Risk", col("churn_risk_label")),
        ),
        "missed pickups": _line(
            ("Property", col("property_name")),
            ("Missed Pickups", col("missed_pickups_30d")),
            ("Risk", col("churn_risk_label")),
            ("CSAT", col("avg_csat")),
        ),
        "contract value at risk": _line(
            ("Property", col("property_name")),
            ("Contract", dollars(col("contract_value"))),
            ("CSAT", col("avg_csat")),
            ("Renewal", col("renewal_date")),
        ),
        "service performance": _line(
            ("Category", col("service_category")),
            ("Complaints", col("total_complaints")),
            ("CSAT", rounded(col("avg_csat"), 2)),
            ("Avg Resolution", F.concat(rounded(col("avg_resolution_time"), 1).cast("string"), F.lit("h"))),
        ),
        "property health": _line(
            ("Property", col("property_name")),
            ("Type", col("property_type")),
            ("Complaints", col("total_complaints")),
            ("CSAT", rounded(col("avg_csat"), 2)),
            ("Missed Pickups", col("total_missed_pickups")),
        ),
        "renewal timing": _line(
            ("Property", col("property_name")),
            ("Renewal", col("renewal_date")),
            ("Risk", col("churn_risk_label")),
            ("Contract", dollars(col("contract_value"))),
        ),
    }


def answer_lines(reports: dict[str, DataFrame]) -> DataFrame:
    """Numbered lines of all reports: ``(intent, position, line)``."""
    formats = line_formats()
    lines = [
        report.select(
            F.lit(name).alias("intent"),
            "position",
            F.concat(F.col("position").cast("string"), F.lit(". "), formats[name]).alias("line"),
        )
        for name, report in reports.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def answer_texts(lines: DataFrame, titles: dict[str, str] = fv.INTENT_TITLES) -> DataFrame:
    """One text per intent: title and lines in order, or a note that there is no data.

    A report has at most a handful of lines, so gathering them is safe.
    """
    names = mapping_table(lines.sparkSession, titles, "intent", "title")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "line"))), _text), "\n")
    gathered = lines.groupBy("intent").agg(body.alias("body"))
    found = F.concat("title", F.lit(":\n\n"), "body")
    missing = F.concat(F.lit("No data found for: "), "title")
    return names.join(gathered, "intent", "left").select(
        "intent", F.coalesce(found, missing).alias("sql_result")
    )


def _text(item: Column) -> Column:
    return item["line"]
