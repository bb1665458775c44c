"""Which report answers a question, and which steps a request runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv

Patterns = Mapping[str, Sequence[str]]


def can_handle(question: Column, patterns: Patterns = fv.INTENT_PATTERNS) -> Column:
    """Whether any pattern occurs in the question, upper or lower case; null asks nothing."""
    return intent(question, patterns).isNotNull()


def intent(question: Column, patterns: Patterns = fv.INTENT_PATTERNS) -> Column:
    """The first intent with a pattern inside the question, null if there is none."""
    text = F.lower(question)
    chosen = None
    for name, words in patterns.items():
        hit = _any_inside(text, words)
        chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
    return chosen if chosen is not None else F.lit(None).cast("string")


def route(mode: Column, question: Column) -> Column:
    """``full``, ``sql`` or ``rag``. An automatic request runs everything if the question can
    be handled, else it only retrieves."""
    return (
        F.when(mode == fv.MODE_FULL, "full")
        .when(mode == fv.MODE_SQL, "sql")
        .when(mode == fv.MODE_RAG, "rag")
        .when(can_handle(question), "full")
        .otherwise("rag")
    )


def routed(questions: DataFrame) -> DataFrame:
    """Each request with its intent, its route and the outputs the route returns.

    An automatic request that falls back to retrieval still carries the fixed
    answer saying that no report fits.
    """
    retrieval_only = F.coalesce(F.col("mode") == fv.MODE_RAG, F.lit(False))
    return questions.select(
        "*",
        intent(F.col("question")).alias("intent"),
        route(F.col("mode"), F.col("question")).alias("route"),
    ).select(
        "*",
        (~retrieval_only).alias("returns_findings"),
        (F.col("route") != "sql").alias("returns_context"),
        (F.col("route") == "full").alias("returns_report"),
        F.when(~retrieval_only & F.col("intent").isNull(), F.lit(fv.FALLBACK_ANSWER)).alias("fixed_answer"),
    )


def _any_inside(text: Column, words: Sequence[str]) -> Column:
    hit = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(text, F.lit(word))
    return hit
