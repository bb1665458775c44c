"""Ticket, conversation, question and vector views over the shared test tables.

The test tables come from another domain, so each view derives the columns
that the operators expect from whole tables, row by row where it can.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import pick

AS_OF = dt.date(2024, 2, 1)
CONVERSATION_PROPERTIES = 15

# One code of ten is unknown to the category mapping and one is missing.
ISSUE_CODES = [
    "billing_problem", "account_access", "performance", "bug", "security_concern",
    "feature_request", "how_to", "other", "unlisted",
]
SLA_PLANS = ["basic", "standard", "premium"]
SENTIMENTS = ["negative", "neutral", "positive"]
# One category of five is missing.
CONVERSATION_CATEGORIES = [
    "Doorstep Collection", "Maintenance Support", "Resident Amenities", "Pet Services",
]
MODES = [fv.MODE_AUTO, fv.MODE_FULL, fv.MODE_SQL, fv.MODE_RAG]

# Turn numbers of a conversation stay below this, so that one number can name conversation and turn.
TURNS = 1 << 20

# Short questions of every intent, some that fit two or match by accident, and blank ones.
QUESTIONS = [
    "Where is churn risk highest?",
    "List sites with low CSAT, please",
    "Who had a missed pickup last month?",
    "How much revenue at risk do we have?",
    "Compare service performance of all teams",
    "Name the worst property in the portfolio",
    "Who is renewing soon?",
    "Which CATEGORY draws most complaints?",
    "high churn and a renewal in sight",
    "Any job satisfaction surveys?",
    "Did a subcontractor reply?",
    "What did people say about the gym?",
    "  ",
    "",
    None,
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets_from_events(table(spark, sf_dir, "events"))


def tickets_from_events(events: DataFrame) -> DataFrame:
    """One raw ticket per event."""
    # In a step of its own, so that the text is parsed once per row.
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, event_id, user_id = F.col("k"), F.col("event_id"), F.col("user_id")
    score = F.least(
        F.lit(5).cast("bigint"),
        F.greatest(F.lit(1).cast("bigint"), 1 + (event_id * 31 + k) % 5 + user_id % 5 - 2),
    )
    return events.select(
        event_id.alias("ticket_id"),
        _property_id(user_id).alias("customer_id"),
        F.col("event_type").alias("customer_segment"),
        pick(SLA_PLANS, k % 3).alias("sla_plan"),
        F.col("props").alias("initial_message"),
        F.concat(F.lit("Seen, "), "event_type", F.lit("\nnext")).alias("agent_first_reply"),
        F.when(event_id % 7 != 0, F.concat(F.lit('closed "'), event_id.cast("string"), F.lit('"'))).alias(
            "resolution_summary"
        ),
        pick(SENTIMENTS, event_id % 3).alias("customer_sentiment"),
        pick(ISSUE_CODES, k % 10).alias("issue_type"),
        F.when(event_id % 11 != 0, score).alias("csat_score"),
        F.col("value").alias("resolution_time_hours"),
    )


def conversation_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets_from_conversations(table(spark, sf_dir, "conversations"))


def tickets_from_conversations(conversations: DataFrame) -> DataFrame:
    """One ticket per exchange: a user turn with the assistant turn that follows it.

    Turns without a partner are tickets too, so every user and assistant text
    is in one. The join goes by conversation and turn, which no conversation
    makes a hot key, and gathers nothing per conversation.
    """
    place = ["conv_id", "answered"]
    asked = conversations.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("answered"), F.col("text").alias("complaint_description")
    )
    replies = conversations.where("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("answered"), F.col("text").alias("service_response")
    )
    return asked.join(replies, place, "full").select(
        (F.col("conv_id") * TURNS + F.col("answered")).alias("ticket_id"),
        _property_id(F.col("conv_id") % CONVERSATION_PROPERTIES).alias("property_id"),
        "complaint_description",
        "service_response",
        F.lit(None).cast("string").alias("resolution_notes"),
        pick(CONVERSATION_CATEGORIES, F.col("conv_id") % 5).alias("service_category"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: every user turn as a question, and a short one per event; each asks for a mode."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    conv_id, turn, event_id = F.col("conv_id"), F.col("turn"), F.col("event_id")
    spoken = turns.select(
        (conv_id * TURNS + turn).alias("question_id"),
        pick(MODES, (conv_id + turn) % len(MODES)).alias("mode"),
        F.col("text").alias("question"),
    )
    short = table(spark, sf_dir, "events").select(
        (-1 - event_id).alias("question_id"),
        pick(MODES, event_id % len(MODES)).alias("mode"),
        pick(QUESTIONS, event_id % len(QUESTIONS)).alias("question"),
    )
    return spoken.unionByName(short)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def label_centroids(embeddings: DataFrame) -> DataFrame:
    """Mean vector of every label, as ``(query_id, embedding)``."""
    return embeddings.groupBy(F.col("label").alias("query_id")).agg(_mean_vector().alias("embedding"))


def overall_centroid(embeddings: DataFrame) -> DataFrame:
    return embeddings.agg(_mean_vector().alias("embedding")).select(F.lit(0).alias("query_id"), "embedding")


def _mean_vector() -> Column:
    return vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))


def _property_id(number: Column) -> Column:
    digits = number.cast("string")
    return F.concat(F.lit(fv.ID_PREFIX), F.lpad(digits, F.greatest(F.length(digits), F.lit(5)), F.lit("0")))
