import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight.operators import documents, evidence, nearest, reports
from curbsight.operators.encoder import TermEncoder, encode_with_model
from curbsight.operators.gold import churn_risk
from curbsight.operators.silver import to_silver
from curbsight.plans import assistant
from curbsight.plans.queries import QUERIES
from curbsight.sources import adapters, storage
from tests.helpers import plan, rows, values


def frame(spark, ids, matrix, name, kind="bigint"):
    data = [(i, [float(x) for x in row]) for i, row in zip(ids, matrix)]
    return spark.createDataFrame(data, f"{name} {kind}, embedding array<float>")


def brute_force(corpus_ids, corpus, query_ids, queries, k):
    corpus, queries = np.float64(np.float32(corpus)), np.float64(np.float32(queries))
    found = []
    for q, vector in zip(query_ids, queries):
        d2 = ((corpus - vector) ** 2).sum(axis=1)
        best = sorted(zip(np.round(d2, 9), corpus_ids))[:k]
        found += [(q, i, position) for position, (_, i) in enumerate(best, 1)]
    return sorted(found)


def found_ids(df):
    return sorted(rows(df.select("query_id", "vec_id", "position")))


@pytest.mark.parametrize("max_shipped", [2048, 3])
@pytest.mark.parametrize("k", [1, 5])
def test_equals_brute_force_with_many_copies(spark, max_shipped, k):
    rng = np.random.default_rng(7)
    corpus = rng.normal(size=(300, 8))
    corpus[100:200] = corpus[100]  # a third of all rows are one and the same vector
    queries = np.vstack([rng.normal(size=(2, 8)), corpus[100:105]])
    ids = list(range(1000, 1300))
    df = frame(spark, ids, corpus, "vec_id").repartition(5)
    asked = frame(spark, range(7), queries, "query_id")
    found = nearest.nearest(df, asked, k, max_shipped=max_shipped, chunk_rows=64)
    assert found_ids(found) == brute_force(ids, corpus, range(7), queries, k)


@pytest.mark.parametrize("max_shipped", [2048, 7])
def test_queries_taken_from_the_corpus(spark, folder, max_shipped):
    vectors = np.random.default_rng(5).normal(size=(60, 4))
    frame(spark, range(60), vectors, "vec_id").write.parquet(folder + "/v")
    corpus = spark.read.parquet(folder + "/v")
    asked = corpus.where("vec_id < 20").select(F.col("vec_id").alias("query_id"), "embedding")
    found = nearest.nearest(corpus, asked, 3, max_shipped=max_shipped, chunk_rows=16)
    assert found_ids(found) == brute_force(range(60), vectors, range(20), vectors[:20], 3)


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(1)
    corpus = np.float32(1000 + rng.normal(size=(200, 4)))
    found = nearest.nearest(frame(spark, range(200), corpus, "vec_id"), frame(spark, [0], corpus[:1], "query_id"), 3)
    assert found_ids(found) == brute_force(range(200), corpus, [0], corpus[:1], 3)


@pytest.mark.parametrize("vector", [None, []])
@pytest.mark.parametrize("max_shipped", [10, 0])
def test_null_and_empty_vectors_are_refused(spark, vector, max_shipped):
    odd = spark.createDataFrame([(9, vector)], "id long, embedding array<float>")
    fine = frame(spark, [1, 2], [[1, 0], [0, 1]], "id")
    for corpus, queries in ((fine.unionByName(odd), fine), (fine, fine.unionByName(odd))):
        with pytest.raises(Exception, match="null or empty"):
            nearest.nearest(corpus, queries.withColumnRenamed("id", "query_id"), vec_id="id", max_shipped=max_shipped).collect()


def test_blocks_move_few_copies_of_the_corpus(spark):
    """A block is planned by what a task can hold, not by what can be shipped."""
    corpus = frame(spark, range(400), [[i, 1] for i in range(400)], "vec_id")
    queries = frame(spark, range(300), [[i, 0] for i in range(300)], "query_id")
    found = nearest.nearest(corpus, queries, 1, max_shipped=10, chunk_rows=600)
    assert sorted((r.query_id, r.vec_id) for r in found.collect()) == [(i, i) for i in range(300)]
    assert nearest._cuts(300, 600) == 1 and nearest._cuts(400, 600) == 2
    assert nearest._cuts(1_000_000, nearest.MAX_CHUNK_VALUES // 768) == 62


def test_every_block_meets_every_chunk_in_a_task_of_its_own(spark, monkeypatch):
    """Groups that are merged by their bytes keep few cores busy for long."""
    monkeypatch.setattr(nearest, "LEAST_CUT_ROWS", 20)
    rng = np.random.default_rng(2)
    corpus, queries = np.float32(rng.normal(size=(400, 4))), np.float32(rng.normal(size=(300, 4)))
    taken, grid = [], nearest._grid
    monkeypatch.setattr(nearest, "_grid", lambda *sizes: taken.append(grid(*sizes)) or taken[-1])
    found = nearest.nearest(frame(spark, range(400), corpus, "vec_id"), frame(spark, range(300), queries, "query_id"), 5, max_shipped=10)
    assert found_ids(found) == brute_force(range(400), corpus, range(300), queries, 5)
    (blocks, chunks), = taken
    assert blocks * chunks >= nearest.TASKS_PER_CORE * spark.sparkContext.defaultParallelism and blocks > chunks
    schema = T.StructType().add("query_id", "long").add("vec_id", "long").add("d2", "double")
    sides = frame(spark, range(400), corpus, "vec_id"), frame(spark, range(300), queries, "query_id")
    candidates = nearest._block_candidates(*sides, schema, 5, 50_000)
    tasks = candidates.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == blocks * chunks and sum(r["count"] for r in tasks) == 300 * chunks * 5


def test_blocks_and_chunks_follow_memory_then_cores():
    assert nearest._grid(300, 400, 600, 32) == (1, 2)  # too few rows to cut further
    assert nearest._grid(70_000, 70_000, 97_656, 24) == (8, 3)
    assert nearest._grid(1_000_000, 1_000_000, 97_656, 24) == (21, 21)


@pytest.mark.parametrize("name", ["index_roundtrip", "knn_text", "rag_context", "rag_prompt", "knn_preview", "request_answers", "question_state", "recommendation_prompt"])
def test_a_large_question_set_gives_the_same_rows(spark, sf_dir, name, monkeypatch):
    """The way of a question set too large to ship, cut for many tasks."""
    small = QUERIES[name](spark, sf_dir)
    small = sorted(map(str, rows(small)))
    monkeypatch.setattr(nearest, "MAX_SHIPPED_VALUES", 1)
    monkeypatch.setattr(nearest, "LEAST_CUT_ROWS", 5)
    taken, grid = [], nearest._grid
    monkeypatch.setattr(nearest, "_grid", lambda *sizes: taken.append(grid(*sizes)) or taken[-1])
    assert sorted(map(str, rows(QUERIES[name](spark, sf_dir)))) == small
    assert len(taken) == 1 and taken[0][0] * taken[0][1] > 8


def test_text_ids_and_small_corpus(spark):
    corpus = frame(spark, ["b", "a"], [[1, 0], [1, 0]], "vec_id", "string")
    found = nearest.nearest(corpus, frame(spark, ["q"], [[0, 0]], "query_id", "string"))
    assert rows(found.orderBy("position")) == [("q", "a", 1.0, 1), ("q", "b", 1.0, 2)]


def test_small_batches_agree(spark):
    rng = np.random.default_rng(3)
    corpus, queries = rng.normal(size=(500, 6)), rng.normal(size=(4, 6))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = nearest.nearest(frame(spark, range(500), corpus, "vec_id"), frame(spark, range(4), queries, "query_id"))
        assert found_ids(found) == brute_force(range(500), corpus, range(4), queries, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_queries(spark):
    corpus = frame(spark, [1], [[1, 0]], "vec_id")
    assert nearest.nearest(corpus, frame(spark, [], [], "query_id")).count() == 0


@pytest.mark.parametrize("vectors", [[[1, 0], [math.nan, 0]], [[1], [1, 0, 2]]])
def test_broken_vectors_fail(spark, vectors):
    corpus = frame(spark, [1, 2], vectors, "vec_id").coalesce(1)
    with pytest.raises(Exception, match="finite"):
        nearest.nearest(corpus, frame(spark, [0], [[0, 0]], "query_id")).collect()


def test_search_moves_only_candidates(spark):
    corpus = frame(spark, range(10), np.eye(10), "vec_id")
    text = plan(nearest.nearest(corpus, frame(spark, [0], [[0] * 10], "query_id")))
    assert "MapInArrow" in text and "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.index("Exchange") < text.index("MapInArrow")


# --- encoders ---


def murmur(data, seed=42):
    c1, c2, mask = 0xCC9E2D51, 0x1B873593, 0xFFFFFFFF
    rotate = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    h = seed
    for i in range(0, len(data) - len(data) % 4, 4):
        k = int.from_bytes(data[i : i + 4], "little") * c1 & mask
        h = rotate(h ^ (rotate(k, 15) * c2 & mask), 13) * 5 + 0xE6546B64 & mask
    tail = data[len(data) - len(data) % 4 :]
    h ^= rotate(int.from_bytes(tail, "little") * c1 & mask, 15) * c2 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_term_encoder_equals_brute_force(spark, folder):
    texts = ["Late pickup, late truck!", "Été à Paris — truck", "", None, "truck"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, page_content string")
    encoder = TermEncoder.fit(df, dimensions=64)
    encoder.save(folder + "/encoder")
    found = values(TermEncoder.load(folder + "/encoder").encode(df).orderBy("id"), "embedding")

    counts = [Counter(murmur(t.encode()) % 64 for t in re.findall(r"\w+", (x or "").lower())) for x in texts]
    seen = Counter(d for c in counts for d in c)
    for count, vector in zip(counts, found):
        expected = np.zeros(64)
        for d, n in count.items():
            expected[d] = n * math.log((len(texts) + 1) / (seen[d] + 1))
        norm = np.linalg.norm(expected)
        assert np.allclose(vector, expected / norm if norm else expected, atol=1e-6)


def test_encoding_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a b",)], "page_content string")
    assert "Python" not in plan(TermEncoder.fit(df).encode(df)).replace("PythonRDD", "")


def test_model_encoder_gets_bounded_batches(spark):
    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(25)], "id int, page_content string")

    def load_model():
        def model(texts):
            assert len(texts) <= 10
            return np.array([[len(t), len(texts) <= 10] for t in texts])

        return model

    found = encode_with_model(df.coalesce(1), load_model, batch_rows=10)
    assert dict(found.dtypes)["embedding"] == "array<float>"
    assert rows(found.select("id", F.col("embedding")[0])) == [(i, float(i)) for i in range(25)]


# --- documents, prompts, evidence ---


@pytest.fixture(scope="module")
def churn(spark, sf_dir):
    return churn_risk(to_silver(adapters.tickets(spark, sf_dir), adapters.AS_OF))


def test_context_follows_the_ranking(spark):
    hits = spark.createDataFrame(
        [("q", i, f"doc {i}") for i in (3, 1, 5, 2, 4)], "query_id string, position int, page_content string"
    ).repartition(4)
    assert values(evidence.contexts(hits), "context") == ["\n\n---\n\n".join(f"doc {i}" for i in range(1, 6))]


def test_prompts(spark):
    df = spark.createDataFrame([("Q?", "F", None)], "q string, f string, c string")
    row = df.select(
        evidence.rag_prompt(F.col("q"), F.col("c"), "Do.").alias("rag"),
        evidence.recommendation_prompt(F.col("q"), F.col("f"), F.col("c"), "Do:", ["A", "B"]).alias("report"),
    ).first()
    assert row.rag == "Do.\n\nContext:\n\n\nQuestion: Q?\n\nAnswer:\n"
    assert row.report == "Do:\nA:\nB:\n\nQuestion:\nQ?\n\nFindings:\nF\n\nComplaint records:\n"


def test_report_prompt_names_four_sections(spark):
    prompt = spark.range(1).select(evidence.recommendation_prompt(F.lit("q"), F.lit("f"), F.lit("c"))).first()[0]
    at = [prompt.index(s) for s in ("KEY FINDINGS:", "ROOT CAUSE:", "RISK ASSESSMENT:", "RECOMMENDED ACTIONS:")]
    assert at == sorted(at)


def test_preview_length(spark):
    hits = spark.createDataFrame(
        [("q", 1, "x" * 400, {"property_id": "P", "service_category": "s", "churn_risk": "low"})],
        "query_id string, position int, page_content string, metadata map<string,string>",
    )
    assert rows(evidence.previews(hits)) == [("q", 1, "x" * 300, "P", "s", "low")]


def test_ranked_side_travels_whatever_the_size_of_the_gold_table(spark, churn, sf_dir):
    # Below the size of the event file, above ten report rows.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5KB")
    try:
        tickets = to_silver(adapters.tickets(spark, sf_dir), adapters.AS_OF)
        assert "BroadcastHashJoin" in plan(evidence.ranked_evidence(reports.high_churn(churn), tickets))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_evidence_of_a_hot_property_is_whole(spark, churn):
    ranked = reports.high_churn(churn)
    first = ranked.first().property_id
    tickets = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, first).otherwise(F.concat(F.lit("X"), "id")).alias("property_id"), "id"
    )
    assert evidence.ranked_evidence(ranked, tickets).count() == 3000


def test_label_join_splits_a_hot_property(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 500))
        tickets = spark.range(0, 60_000, 1, 12).select(hot.alias("property_id"), "id")
        known = tickets.select("property_id").distinct().withColumn("churn_risk_label", F.lit("low"))
        known = storage.materialize(known, "labels")
        joined = documents.with_property_risk(tickets, known)
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_properties_split_by_complaints(spark, churn):
    tickets = spark.createDataFrame([("CUST_00001",)] * 50 + [("CUST_00002",), (None,)], "property_id string")
    kept = evidence.properties_with_complaints(churn, tickets)
    left = evidence.properties_without_complaints(churn, tickets)
    assert sorted(values(kept, "property_id")) == ["CUST_00001", "CUST_00002"]
    assert kept.count() + left.count() == churn.count()
    assert "Cartesian" not in plan(left)


def test_questions_are_answered_once(spark):
    df = spark.createDataFrame([("a ",), ("a",), ("",), (None,), (" \n",), ("b",)], "question string")
    found = assistant.distinct_questions(df)
    assert sorted(rows(found.select("question", "times_asked"))) == [("a", 2), ("b", 1)]


# --- stored index ---


def test_stored_index_answers_without_writing_texts_again(spark, sf_dir, folder):
    tickets = adapters.conversation_tickets(spark, sf_dir)
    churn = spark.createDataFrame([("CUST_00001", "high")], "property_id string, churn_risk_label string")
    assistant.build_index(tickets, churn).save(folder + "/index")
    index = assistant.DocumentIndex.load(spark, folder + "/index")
    texts = index.documents.collect()
    asked = spark.createDataFrame([("q", texts[3].page_content)], "query_id string, question string")
    found = assistant.retrieve(index, asked, 1)
    assert values(found, "ticket_id") == [texts[3].ticket_id]
    assert "In(ticket_id" in plan(found) or "EqualTo(ticket_id" in plan(found)
    wrote = []
    original = storage.materialize
    try:
        storage.materialize = lambda df, name: wrote.append(name) or original(df, name)
        assistant.retrieve(index, asked, 1).collect()
    finally:
        storage.materialize = original
    assert wrote == ["hits"]


def test_many_hits_read_a_range_of_ids(spark, folder, monkeypatch):
    monkeypatch.setattr(evidence, "MAX_PUSHED_IDS", 2)
    assistant.write_sorted(spark.range(100).selectExpr("id", "'t' AS page_content"), "id", folder + "/texts")
    hits = spark.createDataFrame([(i,) for i in (40, 45, 50)], "id long")
    found = evidence.attach_documents(hits, spark.read.parquet(folder + "/texts"), "id")
    assert "GreaterThanOrEqual(id,40)" in plan(found) and sorted(values(found, "id")) == [40, 45, 50]


def test_an_index_without_description_is_not_loaded(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        assistant.DocumentIndex.load(spark, folder)
