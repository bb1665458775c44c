import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.functions import number_text, rounded
from curbsight.operators import answers, dashboard, fallback, reports
from tests.helpers import plan, rows, values

AS_OF = dt.date(2024, 2, 1)
CHURN = """property_id string, property_name string, complaint_count bigint, avg_csat double,
    missed_pickups_30d int, contract_value double, renewal_date date, churn_risk_label string"""


def prop(pid, complaints=1, csat=3.0, missed=1, contract=100.0, renewal=AS_OF, label="high", name=None):
    return (pid, name or f"Name {pid}", complaints, csat, missed, contract, renewal, label)


def churn(spark, *props):
    return spark.createDataFrame(list(props), CHURN)


def test_ties_at_the_cut_go_to_the_lower_id(spark):
    df = churn(spark, *[prop(f"P{i:02}", complaints=5) for i in reversed(range(12))])
    assert rows(reports.high_churn(df).select("position", "property_id")) == [
        (i + 1, f"P{i:02}") for i in range(10)
    ]


def test_unscored_property_is_first_in_one_list_and_last_in_the_other(spark):
    df = churn(spark, prop("A", csat=1.0), prop("B", csat=None))
    assert values(reports.low_csat(df), "property_id") == ["B", "A"]
    assert values(dashboard.lowest_csat(df), "property_id") == ["A"]


def test_overdue_renewals(spark):
    days = dt.timedelta
    df = churn(
        spark, prop("late", renewal=AS_OF - days(5)), prop("now"), prop("edge", renewal=AS_OF + days(30)),
        prop("far", renewal=AS_OF + days(31)),
    )
    assert values(reports.renewing_soon(df, AS_OF), "property_id") == ["late", "now", "edge"]
    assert values(reports.renewal_window(df, AS_OF), "property_id") == ["now", "edge"]


def test_no_high_risk_property(spark):
    df = churn(spark, prop("A", label="low"))
    kpi = dashboard.kpi_cards(df).first()
    assert (kpi.revenue_at_risk, kpi.high_risk_count, kpi.revenue_text) == (0.0, 0, "$0")
    assert rows(dashboard.urgent_renewals(df, AS_OF)) == [(0, 0.0, "$0")]
    lines = answers.answer_lines({"high churn risk": reports.high_churn(df)})
    texts = answers.answer_texts(lines, {"high churn risk": "Title"})
    assert rows(texts) == [("high churn risk", "No data found for: Title")]


def test_kpi_figures(spark):
    df = churn(spark, prop("A", csat=2.0, missed=4, contract=1234.5), prop("B", csat=3.0, missed=5, contract=1.0),
               prop("C", csat=4.0, missed=0, contract=7.0, label="low"))
    kpi = dashboard.kpi_cards(df).first()
    assert (kpi.revenue_at_risk, kpi.high_risk_count, kpi.avg_csat, kpi.avg_missed_pickups) == (1235.5, 2, 3.0, 3.0)
    assert (kpi.revenue_text, kpi.csat_text, kpi.missed_text) == ("$1,236", "3.00 / 5.0", "3.0")


def test_kpi_means_do_not_depend_on_the_order_of_rows(spark):
    scores = [3.1, 3.25, 2.7, 3.65, 3.03, 3.32]
    for order in (scores, scores[::-1], sorted(scores), scores[3:] + scores[:3]):
        df = churn(spark, *(prop(f"P{i}", csat=v, missed=1, contract=0.1) for i, v in enumerate(order))).repartition(len(order))
        kpi = dashboard.kpi_cards(df).first()
        assert (kpi.avg_csat, kpi.csat_text) == (19.05 / 6, f"{19.05 / 6:.2f} / 5.0")
        assert dashboard.kpi_cards(df.coalesce(1)).first() == kpi


def test_bottleneck_tie_goes_to_the_first_name(spark):
    df = spark.createDataFrame([("b", 9, 1.0), ("a", 9, 2.0), ("c", 1, 6.0)],
                               "service_category string, total_complaints bigint, avg_resolution_time double")
    assert rows(dashboard.bottleneck(df)) == [("a", 9, 3.0)]


@pytest.mark.parametrize(
    "risks, search, regex, expected",
    [
        (["high", "low"], "", False, ["1", "2"]),
        (["high"], "  ", False, ["1"]),
        (["high", "low"], "OAK (", False, ["1"]),
        (["high", "low"], "oak|pine", True, ["1", "2"]),
        (["high", "low"], "oak|pine", False, []),
        ([], "", False, []),
    ],
)
def test_portfolio_filter(spark, risks, search, regex, expected):
    df = churn(spark, prop("1", name="Oak (North)"), prop("2", name="Pine", label="low"))
    assert sorted(values(dashboard.filter_portfolio(df, risks, search, regex), "property_id")) == expected


def test_broken_pattern_fails(spark):
    with pytest.raises(Exception):
        dashboard.filter_portfolio(churn(spark, prop("1")), search="oak (", regex=True).collect()


def test_rollup_counts_every_property_once(spark):
    df = spark.createDataFrame(
        [("x", "A", 3, 1.0, 10.0, 5), ("x", "B", 1, 4.0, 20.0, 2)],
        """service_category string, property_id string, total_complaints bigint, avg_csat double,
           avg_resolution_time double, total_missed_pickups int""",
    )
    assert rows(reports.service_rollup(df)) == [("x", 4, 2.5, 15.0, 7)]


def test_answer_text(spark):
    df = churn(spark, prop("A", complaints=85, csat=2.5, missed=2, contract=22724.0), prop("B", csat=None))
    texts = answers.answer_texts(
        answers.answer_lines({"high churn risk": reports.high_churn(df)}), {"high churn risk": "Top"}
    )
    assert values(texts, "sql_result") == [
        "Top:\n\n"
        "1. Property: Name A | Complaints: 85 | CSAT: 2.5 | Missed Pickups: 2 | Contract: $22,724\n"
        "2. Property: Name B | Complaints: 1 | CSAT: None | Missed Pickups: 1 | Contract: $100"
    ]


def test_reports_are_top_k_per_task(spark, sf_dir):
    df = churn(spark, prop("A"))
    for report in (reports.high_churn, reports.low_csat, reports.most_missed_pickups, reports.contract_at_risk):
        assert "TakeOrderedAndProject" in plan(report(df))
    assert "TakeOrderedAndProject" in plan(reports.renewing_soon(df, AS_OF))


# --- figures without gold tables ---


def plain_name(pid):
    digits = re.sub("[^0-9]", "", pid)
    tens, ones = divmod(int(digits or sum(map(ord, pid))), 10)
    return fv.FALLBACK_NAME_PREFIXES[ones] + " " + fv.FALLBACK_NAME_SUFFIXES[tens % 9]


def test_made_up_names(spark):
    ids = [f"CUST_{i:05}" for i in range(0, 3000, 7)] + ["abc", "x9", "7", "A1B2C3", "9" * 40 + "5", "Ünit"]
    ids = [i for i in ids if i not in fv.KNOWN_FALLBACK_NAMES]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    found = df.select("id", fallback.property_name(F.col("id")).alias("name"))
    assert rows(found) == [(i, plain_name(i)) for i in ids]


def test_known_names_win(spark):
    df = spark.createDataFrame([("CUST_00861",)], "id string")
    assert rows(df.select(fallback.property_name(F.col("id")))) == [("Silk Road Residences",)]


def test_made_up_types(spark):
    names = ["Oak Manor", "Pine Court", "River Heights", "Willow Suites"]
    types = fv.FALLBACK_PROPERTY_TYPES
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = values(df.select(fallback.property_type(F.col("name")).alias("t")), "t")
    assert found == [types[sum(map(ord, n)) % 4] for n in names]


def test_first_label_follows_the_stated_order(spark):
    df = spark.createDataFrame(
        [("CUST_00861", 3, "LOW"), ("CUST_00861", 1, None), ("CUST_00861", 2, "high"), (None, 0, "high")],
        "property_id string, at int, churn_risk_label string",
    ).repartition(3)
    assert rows(fallback.churn_counts(df, "at")) == [(3, "medium", "Silk Road Residences")]


def test_missing_categories(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "service_category string")
    assert rows(fallback.service_counts(df)) == [("a", 2)]
    assert sorted(rows(fallback.service_counts(df, keep_missing=True))) == [("General support", 1), ("a", 2)]


def test_pickup_shares_are_cut_and_may_exceed_the_total(spark):
    names = ["Doorstep Collection", "Late pickups", "Resident Amenities", "Pet Services"]
    categories = spark.createDataFrame([(n,) for n in names], "service_category string")
    found = fallback.category_pickups(categories, churn(spark, prop("A", missed=9), prop("B", missed=8)))
    assert dict(rows(found)) == {names[0]: 11, names[1]: 11, names[2]: 3, names[3]: 1}


@pytest.mark.parametrize(
    ("value", "places", "text"),
    [(4.25, 1, "4.2"), (2.675, 2, "2.67"), (0.125, 2, "0.12"), (0.375, 2, "0.38"), (12345.5, 0, "12346"), (None, 2, "n/a")],
)
def test_figures_round_like_the_reports_they_match(spark, value, places, text):
    df = spark.createDataFrame([(value,)], "x double")
    if places:
        assert values(df.select(number_text(F.col("x"), places).alias("t")), "t") == [text]
        assert values(df.select(rounded(F.col("x"), places).alias("t")), "t") == [None if value is None else float(text)]


def test_kpi_texts_on_ties_and_without_properties(spark):
    df = churn(spark, *[prop(f"P{i}", csat=c, missed=m) for i, (c, m) in enumerate([(2.0, 4), (2.25, 4), (2.0, 4), (2.25, 5)])])
    tie = dashboard.kpi_cards(df).first()
    assert (tie.csat_text, tie.missed_text) == ("2.12 / 5.0", "4.2")
    none = dashboard.kpi_cards(df.limit(0)).first()
    assert (none.revenue_text, none.csat_text, none.missed_text, none.high_risk_count) == ("$0", "n/a / 5.0", "n/a", 0)


def test_fixed_thresholds_and_orders():
    assert fv.CONTRACT_FLOOR == 10_000 and fv.RENEWAL_NOTICE_DAYS == 30 and fv.TOP_N == 10 and fv.RETRIEVAL_K == 5
    assert list(fv.INTENT_PATTERNS) == [
        "high churn risk", "low csat", "missed pickups", "contract value at risk", "service performance", "property health", "renewal timing",
    ]
    assert fv.DEFAULT_SERVICE_CATEGORY == "Doorstep Collection"


def test_a_whole_result_is_numbered_in_ranges(spark):
    rows_in = [(i, i * 7919 % 1000 // 10, None if i % 50 == 0 else i % 3, i) for i in range(5000)]
    df = spark.createDataFrame(rows_in, "id int, score int, other int, position int")
    order = [F.desc("score"), F.asc_nulls_last("other"), F.asc("id")]
    result = reports.numbered(df, order)
    want = sorted(rows_in, key=lambda r: (-r[1], r[2] is None, r[2] or 0, r[0]))
    assert result.columns == ["position", "id", "score", "other"]
    assert sorted(rows(result)) == [(i + 1, *r[:3]) for i, r in enumerate(want)]
    assert "SinglePartition" not in plan(result) and "SinglePartition" not in plan(reports.portfolio_ranks(churn(spark, prop("A"))))


def test_numbering_odd_tables(spark):
    df = spark.createDataFrame([(1, "a b")] * 300 + [(None, "c")], "`a.b` int, text string")
    result = rows(reports.numbered(df, [F.asc_nulls_first("`a.b`")]))
    assert sorted(r[0] for r in result) == list(range(1, 302)) and min(result)[1:] == (None, "c")
    assert rows(reports.numbered(df.limit(0), [F.asc("text")])) == []
