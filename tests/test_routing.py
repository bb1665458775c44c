import pytest
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.operators import routing
from tests.helpers import plan, rows

TRUTH = [
    ("Which properties have high churn risk?", "high churn risk"),
    ("Which properties have the worst CSAT scores?", "low csat"),
    ("Show me properties with most missed pickups", "missed pickups"),
    ("What is the contract value at risk?", "contract value at risk"),
    ("Which service categories have most complaints?", None),
    ("Which service category has most complaints?", "service performance"),
    ("Which properties have the worst property health?", "property health"),
    ("Which properties are renewing soon?", "renewal timing"),
    ("What are the most common service complaints?", None),
    ("Give me a retention plan for low CSAT properties.", "low csat"),
    ("high churn accounts with renewal due", "high churn risk"),
    ("general dissatisfaction", "low csat"),
    ("the contractor left", "contract value at risk"),
    ("", None),
    (None, None),
]


def test_intents(spark):
    df = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(TRUTH)], "i int, q string")
    found = df.select("i", routing.intent(F.col("q")), routing.can_handle(F.col("q")))
    assert rows(found) == [(i, intent, intent is not None) for i, (_, intent) in enumerate(TRUTH)]


@pytest.mark.parametrize(
    "mode, question, route, findings, context, report, fallback",
    [
        (fv.MODE_FULL, "hello", "full", True, True, True, True),
        (fv.MODE_FULL, "low csat", "full", True, True, True, False),
        (fv.MODE_SQL, "hello", "sql", True, False, False, True),
        (fv.MODE_SQL, "low csat", "sql", True, False, False, False),
        (fv.MODE_RAG, "low csat", "rag", False, True, False, False),
        (fv.MODE_AUTO, "low csat", "full", True, True, True, False),
        (fv.MODE_AUTO, "hello", "rag", True, True, False, True),
        (None, "low csat", "full", True, True, True, False),
    ],
)
def test_routes(spark, mode, question, route, findings, context, report, fallback):
    df = routing.routed(spark.createDataFrame([(mode, question)], "mode string, question string"))
    row = df.first()
    assert (row.route, row.returns_findings, row.returns_context, row.returns_report) == (
        route, findings, context, report,
    )
    assert (row.fixed_answer == fv.FALLBACK_ANSWER) is fallback


def test_routing_is_narrow(spark):
    df = spark.createDataFrame([("a", "b")], "mode string, question string")
    assert "Exchange" not in plan(routing.routed(df))
