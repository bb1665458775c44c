"""Tickets to retrieval documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import strip_whitespace


def rag_projection(silver: DataFrame) -> DataFrame:
    return silver.select(*fv.RAG_COLUMNS)


def fill_nulls(tickets: DataFrame, defaults: Mapping[str, str] = fv.RAG_NULL_DEFAULTS) -> DataFrame:
    return tickets.fillna(dict(defaults))


def render(tickets: DataFrame) -> DataFrame:
    """Add ``page_content`` and ``metadata``; missing texts read as their defaults."""
    parts = [piece for heading, column in fv.DOCUMENT_PARTS for piece in (F.lit(heading), F.col(column))]
    return fill_nulls(tickets).withColumns(
        {
            "page_content": strip_whitespace(F.concat(*parts)),
            "metadata": F.create_map(
                F.lit("property_id"), F.col("property_id"),
                F.lit("service_category"), F.col("service_category"),
                F.lit("churn_risk"), F.col("churn_risk_label"),
            ),
        }
    )


def with_property_risk(tickets: DataFrame, churn: DataFrame) -> DataFrame:
    """Each ticket with the label of its property, null where the property is unknown.

    Labels are unique per property, so a property with very many tickets only
    lengthens the ticket side, which the adaptive skew join splits when the
    labels are too large to broadcast.
    """
    return tickets.join(churn.select("property_id", "churn_risk_label"), "property_id", "left")
