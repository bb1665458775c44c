"""From questions to answers, contexts and prompts, for many questions at once."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import strip_whitespace
from curbsight.operators import answers, documents, evidence, nearest, reports, routing
from curbsight.operators.encoder import TermEncoder
from curbsight.sources import storage


@dataclass(frozen=True)
class DocumentIndex:
    """Rendered documents, their vectors under the same id, and the encoder that made them."""

    documents: DataFrame
    vectors: DataFrame
    encoder: TermEncoder
    doc_id: str = "ticket_id"

    def save(self, path: str) -> None:
        """Store the index in one new folder; its description comes last and marks it complete."""
        write_sorted(self.documents, self.doc_id, f"{path}/documents")
        self.vectors.write.parquet(f"{path}/vectors")
        self.encoder.save(f"{path}/encoder")
        named = self.documents.sparkSession.range(1).select(F.lit(self.doc_id).alias("doc_id"))
        named.write.parquet(f"{path}/description")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DocumentIndex:
        """A stored index, ready for questions; one that was not stored completely raises."""
        doc_id = spark.read.parquet(f"{path}/description").first()["doc_id"]
        texts, encoded = (spark.read.parquet(f"{path}/{part}") for part in ("documents", "vectors"))
        return cls(texts, encoded, TermEncoder.load(f"{path}/encoder"), doc_id)


def write_sorted(df: DataFrame, doc_id: str, path: str) -> None:
    """Rows in order of their id, within files and across them, so that a scan for few ids skips the rest."""
    df.repartitionByRange(doc_id).sortWithinPartitions(doc_id).write.parquet(path)


def build_index(tickets: DataFrame, churn: DataFrame, doc_id: str = "ticket_id") -> DocumentIndex:
    """Render and encode all tickets. Texts are stored once; a search reads vectors only."""
    spark = tickets.sparkSession
    labelled = documents.with_property_risk(tickets, churn)
    rendered = documents.render(labelled).select(doc_id, "page_content", "metadata")
    path = storage.new_location(spark, "documents")
    write_sorted(rendered, doc_id, path)
    rendered = spark.read.schema(rendered.schema).parquet(path)
    encoder = TermEncoder.fit(rendered)
    encoded = encoder.encode(rendered).select(doc_id, "embedding")
    return DocumentIndex(rendered, storage.materialize(encoded, "vectors"), encoder, doc_id)


def retrieve(index: DocumentIndex, questions: DataFrame, k: int = fv.RETRIEVAL_K) -> DataFrame:
    """The ``k`` nearest documents of each question: ``(query_id, position, d2, ...)``.

    ``questions`` has ``query_id`` and ``question``.
    """
    encoded = index.encoder.encode(questions, text="question").select("query_id", "embedding")
    hits = nearest.nearest(index.vectors, encoded, k, vec_id=index.doc_id)
    return evidence.attach_documents(storage.materialize(hits, "hits"), index.documents, index.doc_id)


def report_set(gold: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The report of every intent."""
    churn = gold["gold_churn_risk"]
    return {
        "high churn risk": reports.high_churn(churn),
        "low csat": reports.low_csat(churn),
        "missed pickups": reports.most_missed_pickups(churn),
        "contract value at risk": reports.contract_at_risk(churn),
        "service performance": reports.service_by_category(gold["gold_service_performance"]),
        "property health": reports.worst_health(gold["gold_property_health"]),
        "renewal timing": reports.renewing_soon(churn, as_of),
    }


def distinct_questions(questions: DataFrame) -> DataFrame:
    """Each question once with how often it was asked, so that one asked by everybody is
    answered once. Blank ones ask nothing."""
    stripped = questions.select(strip_whitespace(F.col("question")).alias("question"))
    asked = stripped.where(F.col("question") != "").groupBy("question").agg(F.count("*").alias("times_asked"))
    return asked.withColumn("query_id", F.sha2("question", 256))


def rag_prompts(questions: DataFrame, index: DocumentIndex) -> DataFrame:
    """The retrieval prompt of each distinct question."""
    asked = storage.materialize(distinct_questions(questions), "questions")
    found = evidence.contexts(retrieve(index, asked))
    prompt = evidence.rag_prompt(F.col("question"), F.col("context"))
    return asked.join(found, "query_id", "left").select("question", prompt.alias("rag_prompt"))


def question_state(
    questions: DataFrame, gold: dict[str, DataFrame], index: DocumentIndex, as_of: dt.date
) -> DataFrame:
    """Question, findings, retrieval prompt and report prompt, one row per distinct question."""
    return _answered(questions, gold, index, as_of).drop("query_id")


def request_answers(
    questions: DataFrame, gold: dict[str, DataFrame], index: DocumentIndex, as_of: dt.date
) -> DataFrame:
    """For each request (``question_id``, ``mode``, ``question``) the outputs that its route returns.

    ``findings`` is the report text or the fixed answer. A blank question gets
    the fixed answer where its mode asks for findings, and no prompts. Answers
    are unique per question, so a question that everybody asks only lengthens
    the side of the requests, which the adaptive skew join splits.
    """
    answered = storage.materialize(_answered(questions, gold, index, as_of), "answers")
    requests = routing.routed(questions).withColumn(
        "query_id", F.sha2(strip_whitespace(F.col("question")), 256)
    )
    findings = F.coalesce("sql_result", F.lit(fv.FALLBACK_ANSWER))
    return requests.join(answered.drop("question", "intent"), "query_id", "left").select(
        "question_id",
        "mode",
        "route",
        F.when(F.col("returns_findings"), findings).alias("findings"),
        F.when(F.col("returns_context"), F.col("rag_prompt")).alias("rag_prompt"),
        F.when(F.col("returns_report"), F.col("recommendation_prompt")).alias("recommendation_prompt"),
    )


def _answered(
    questions: DataFrame, gold: dict[str, DataFrame], index: DocumentIndex, as_of: dt.date
) -> DataFrame:
    asked = storage.materialize(distinct_questions(questions), "questions")
    texts = answers.answer_texts(answers.answer_lines(report_set(gold, as_of)))
    found = evidence.contexts(retrieve(index, asked))
    question = F.col("question")
    return (
        asked.withColumn("intent", routing.intent(question))
        .join(texts, "intent", "left")
        .join(found, "query_id", "left")
        .withColumn("sql_result", F.coalesce("sql_result", F.lit(fv.FALLBACK_ANSWER)))
        .select(
            "query_id",
            "question",
            "times_asked",
            "intent",
            "sql_result",
            evidence.rag_prompt(question, F.col("context")).alias("rag_prompt"),
            evidence.recommendation_prompt(question, F.col("sql_result"), F.col("context")).alias(
                "recommendation_prompt"
            ),
        )
    )
