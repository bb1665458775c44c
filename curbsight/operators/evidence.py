"""Retrieved documents as context, evidence and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv

MAX_PUSHED_IDS = 1000

RAG_INSTRUCTION = (
    "Each record below is one exchange: what a resident wrote, what support replied, and the service it "
    "concerns. Use these records only. Name the records you rely on, and write \"no matching record\" "
    "where they are silent."
)
REPORT_INSTRUCTION = (
    "You advise on keeping customers. Study the findings and the complaint records, "
    "then write a specific report under these headings, in this order:"
)


def attach_documents(hits: DataFrame, documents: DataFrame, doc_id: str) -> DataFrame:
    """Hits with their documents.

    Hits are few per query; once they are written, Spark sees their size and
    ships them to the documents instead of moving the texts. Documents stored
    in order of their id are read only where hits can lie: the ids themselves
    go into the scan while they are few, their range otherwise.
    """
    ids = [row[0] for row in hits.select(doc_id).distinct().limit(MAX_PUSHED_IDS + 1).collect()]
    if len(ids) <= MAX_PUSHED_IDS:
        documents = documents.where(F.col(doc_id).isin(ids))
    else:
        low, high = hits.agg(F.min(doc_id), F.max(doc_id)).first()
        documents = documents.where(F.col(doc_id).between(low, high))
    return hits.join(documents, doc_id)


def previews(hits: DataFrame, chars: int = fv.PREVIEW_CHARS) -> DataFrame:
    """The start of every hit with its metadata."""
    return hits.select(
        "query_id",
        "position",
        F.substring("page_content", 1, chars).alias("preview"),
        F.col("metadata")["property_id"].alias("property_id"),
        F.col("metadata")["service_category"].alias("service_category"),
        F.col("metadata")["churn_risk"].alias("churn_risk"),
    )


def contexts(hits: DataFrame, separator: str = fv.CONTEXT_SEPARATOR) -> DataFrame:
    """One context text per query, best hit first. A query has at most ``k`` hits."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "page_content")))
    text = F.array_join(F.transform(ordered, lambda hit: hit["page_content"]), separator)
    return hits.groupBy("query_id").agg(text.alias("context"))


def rag_prompt(question: Column, context: Column, instruction: str = RAG_INSTRUCTION) -> Column:
    return F.concat(
        F.lit(f"{instruction}\n\nContext:\n"), _given(context),
        F.lit("\n\nQuestion: "), _given(question),
        F.lit("\n\nAnswer:\n"),
    )


def recommendation_prompt(
    question: Column,
    findings: Column,
    context: Column,
    instruction: str = REPORT_INSTRUCTION,
    sections: Sequence[str] = fv.REPORT_SECTIONS,
) -> Column:
    headings = "\n".join(f"{s}:" for s in sections)
    return F.concat(
        F.lit(f"{instruction}\n{headings}\n\nQuestion:\n"), _given(question),
        F.lit("\n\nFindings:\n"), _given(findings),
        F.lit("\n\nComplaint records:\n"), _given(context),
    )


def ranked_evidence(ranked: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every ticket of the ranked properties.

    A top-k report is one row per property and its limit bounds its size, so
    Spark ships it to the tickets without a hint.
    """
    best = ranked.select("position", "property_id", "property_name")
    return tickets.drop("position", "property_name").join(best, "property_id")


def properties_with_complaints(properties: DataFrame, tickets: DataFrame) -> DataFrame:
    return properties.join(_distinct_properties(tickets), "property_id", "left_semi")


def properties_without_complaints(properties: DataFrame, tickets: DataFrame) -> DataFrame:
    return properties.join(_distinct_properties(tickets), "property_id", "left_anti")


def _distinct_properties(tickets: DataFrame) -> DataFrame:
    # Combined within each task first, so a property with very many tickets moves few rows.
    return tickets.select("property_id").distinct()


def _given(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
