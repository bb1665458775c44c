"""Every operator as a named query over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight import fixed_values as fv
from curbsight.operators import (
    answers,
    audit,
    cells,
    dashboard,
    documents,
    evidence,
    fallback,
    gold,
    nearest,
    reports,
    routing,
    silver,
)
from curbsight.operators.encoder import encode_with_model
from curbsight.plans import assistant, medallion
from curbsight.sources import adapters, csv_files, snapshots, storage, tables, vectors
from curbsight.sources.adapters import AS_OF
from curbsight.streaming import gold_stream, silver_stream

Query = Callable[[SparkSession, str], DataFrame]

SEARCH_TEXT = "maple"
SEARCH_RISKS = ["high", "medium"]
SILVER_KEYS = ["ticket_id", "property_id"]
RETRIEVAL_KEYS = ["ticket_id", *fv.RAG_COLUMNS]


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.to_silver(adapters.tickets(spark, sf), AS_OF)


def _churn(spark: SparkSession, sf: str) -> DataFrame:
    return gold.churn_risk(_silver(spark, sf))


def _health(spark: SparkSession, sf: str) -> DataFrame:
    return gold.property_health(_silver(spark, sf))


def _service(spark: SparkSession, sf: str) -> DataFrame:
    return gold.service_performance(_silver(spark, sf))


def _rollup(spark: SparkSession, sf: str) -> DataFrame:
    return reports.service_rollup(_service(spark, sf))


def _gold(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return medallion.gold_tables(_silver(spark, sf))


def _labelled_conversations(spark: SparkSession, sf: str) -> DataFrame:
    tickets = adapters.conversation_tickets(spark, sf)
    return documents.with_property_risk(tickets, _churn(spark, sf)).select(*RETRIEVAL_KEYS)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages of averages keep their noise in the operators; round it off for comparison."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources, sinks, catalog ---


def bronze_csv_scan(spark, sf):
    path = storage.new_location(spark, "tickets-csv")
    csv_files.write_tickets(adapters.tickets(spark, sf), path)
    return csv_files.read_tickets(spark, path)


def bronze_csv_by_name(spark, sf):
    """Files whose columns lie in another order, with one more than the declared ones."""
    path = storage.new_location(spark, "tickets-by-name")
    tickets = adapters.tickets(spark, sf).withColumn("batch", F.concat(F.lit("batch "), (F.col("ticket_id") % 3).cast("string")))
    csv_files.write_tickets(tickets.select(*reversed(tickets.columns)), path)
    return csv_files.read_tickets(spark, path)


def bronze_csv_rejects(spark, sf):
    """Some scores are no numbers: their records are set aside and counted."""
    path = storage.new_location(spark, "tickets-rejects")
    score = F.when(F.col("ticket_id") % 13 == 5, "x2").otherwise(F.col("csat_score").cast("string"))
    csv_files.write_tickets(adapters.tickets(spark, sf).withColumn("csat_score", score), path)
    good, rejected = csv_files.split_rejects(csv_files.read_tickets(spark, path, rejects=True))
    figures = [F.count("*").alias("tickets"), F.sum("ticket_id").alias("id_sum"), F.count("csat_score").alias("scores")]
    kept = good.agg(F.lit("kept").alias("outcome"), *figures)
    return kept.union(rejected.agg(F.lit("rejected").alias("outcome"), *figures)).where("tickets > 0")


def bronze_table_roundtrip(spark, sf):
    tables.write_table(
        adapters.tickets(spark, sf), "bronze_tickets", storage.new_location(spark, "bronze-tickets")
    )
    return tables.read_table(spark, "bronze_tickets")


def silver_scan(spark, sf):
    tables.write_table(_silver(spark, sf), "silver_tickets", storage.new_location(spark, "silver-tickets"))
    return tables.read_table(spark, "silver_tickets")


def gold_table_roundtrip(spark, sf):
    tables.write_table(_service(spark, sf), "gold_performance", storage.new_location(spark, "gold-performance"))
    return tables.read_table(spark, "gold_performance")


def catalog_tables(spark, sf):
    for name, df in _gold(spark, sf).items():
        tables.write_table(df, name, storage.new_location(spark, name))
    counts = tables.row_counts({n: tables.read_table(spark, n) for n in medallion.GOLD_TABLES})
    return tables.list_tables(spark, medallion.GOLD_TABLES).join(counts, "table_name")


def describe_gold(spark, sf):
    tables.write_table(_churn(spark, sf), "gold_churn", storage.new_location(spark, "gold-churn"))
    written = tables.read_table(spark, "gold_churn")
    return audit.column_report(written, tables.describe_table(spark, "gold_churn"))


def sql_text(spark, sf):
    """A SQL text over a registered view."""
    _silver(spark, sf).createOrReplaceTempView("silver_view")
    return tables.run_query(
        spark,
        """
        SELECT service_category, churn_risk_label, count(*) AS tickets
        FROM silver_view GROUP BY service_category, churn_risk_label
        """,
    )


def rag_export_roundtrip(spark, sf):
    path = storage.new_location(spark, "rag-export")
    csv_files.export_rag(_labelled_conversations(spark, sf), path)
    return csv_files.read_rag(spark, path)


def rag_source_scan(spark, sf):
    path = storage.new_location(spark, "rag-source")
    csv_files.export_rag(documents.rag_projection(_silver(spark, sf)), path)
    export = csv_files.read_rag(spark, path, ["property_id", "service_category", "churn_risk_label"])
    return export.groupBy(*export.columns).agg(F.count("*").alias("tickets"))


def vector_roundtrip(spark, sf):
    path = storage.new_location(spark, "vectors")
    vectors.write_vectors(adapters.vectors(spark, sf), path)
    stored = vectors.read_vectors(spark, path)
    return stored.select("vec_id", "label", F.posexplode("embedding").alias("dimension", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


def vector_scan(spark, sf):
    squares = F.aggregate(
        F.col("embedding").cast("array<double>"), F.lit(0.0), lambda total, x: total + x * x
    )
    return adapters.vectors(spark, sf).select(
        "vec_id", "label", F.size("embedding").alias("dimensions"), F.round(squares, 6).alias("squared_norm")
    )


def row_counts(spark, sf):
    silver_df = _silver(spark, sf)
    return tables.row_counts({"silver": silver_df, **medallion.gold_tables(silver_df)})


# --- silver ---


def silver_rename(spark, sf):
    return silver.rename_columns(adapters.tickets(spark, sf))


def _silver_column(column: str) -> Query:
    return lambda spark, sf: _silver(spark, sf).select(*SILVER_KEYS, column)


def _with_bad_ids(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.concat(F.lit("BAD_"), "customer_id")
    return adapters.tickets(spark, sf).withColumn(
        "customer_id", F.when(F.col("ticket_id") % 17 == 3, bad).otherwise(F.col("customer_id"))
    )


def silver_quarantine(spark, sf):
    return silver.malformed_ids(_with_bad_ids(spark, sf)).select("ticket_id", "customer_id")


def silver_lenient(spark, sf):
    """Tickets with malformed ids stay in a lenient run, without a name."""
    return silver.to_silver(_with_bad_ids(spark, sf), AS_OF, strict=False).select("ticket_id", "property_name")


def lookup_join_category(spark, sf):
    joined = silver.with_category_from_table(adapters.tickets(spark, sf), silver.category_table(spark))
    return joined.select("ticket_id", "issue_type", "service_category")


def gold_incremental(spark, sf):
    """Churn risk from the mergeable state that a stream of ticket files has built up."""
    files, root = storage.new_location(spark, "ticket-files"), storage.new_location(spark, "gold-state")
    adapters.tickets(spark, sf).repartition(6, "ticket_id").write.parquet(files)
    stream = silver_stream.read_ticket_stream(spark, files, adapters.tickets(spark, sf).schema, files_per_batch=2)
    gold_stream.update_gold(stream, AS_OF, root, storage.new_location(spark, "gold-state-progress"))
    return gold_stream.gold_tables(spark, root)["gold_churn_risk"]


def gold_snapshot(spark, sf):
    """A table published twice; readers see the second version."""
    root = storage.new_location(spark, "snapshots")
    churn = storage.materialize(_churn(spark, sf), "churn")
    snapshots.publish(churn.where("churn_risk_label = 'high'"), "gold_churn_published", root)
    snapshots.publish(churn, "gold_churn_published", root)
    return tables.read_table(spark, "gold_churn_published")


def silver_stream_table(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = silver_stream.read_ticket_stream(
        spark, f"{sf}/events*.parquet", schema, adapters.tickets_from_events
    )
    path = storage.new_location(spark, "silver-stream")
    silver_stream.append_silver(stream, AS_OF, path, storage.new_location(spark, "silver-stream-progress"))
    return spark.read.parquet(path)


# --- gold and audits ---


def base_aggregate(spark, sf):
    return _rounded(gold.base_aggregate(_silver(spark, sf)), "hours_sum")


def gold_churn_from_base(spark, sf):
    return _gold(spark, sf)["gold_churn_risk"]


def gold_service_from_base(spark, sf):
    return _gold(spark, sf)["gold_service_performance"]


def bronze_null_profile(spark, sf):
    return audit.null_profile(adapters.tickets(spark, sf))


def gold_duplicate_check(spark, sf):
    return audit.duplicate_keys(_churn(spark, sf))


def name_duplicate_check(spark, sf):
    return audit.duplicate_keys(_churn(spark, sf), ["property_name"])


def preview(spark, sf):
    return audit.preview(_silver(spark, sf), ["ticket_id"])


# --- reports ---


def intent_service_performance(spark, sf):
    return _rounded(reports.service_by_category(_service(spark, sf)), "avg_csat", "avg_resolution_time")


def intent_property_health(spark, sf):
    return _rounded(reports.worst_health(_health(spark, sf)), "avg_csat")


def service_performance_deduped(spark, sf):
    return reports.service_rollup_per_ticket(gold.base_aggregate(_silver(spark, sf)))


def answer_lines(spark, sf):
    return answers.answer_lines(assistant.report_set(_gold(spark, sf), AS_OF))


def answer_texts(spark, sf):
    return answers.answer_texts(answer_lines(spark, sf))


# --- dashboard ---


def kpi_cards(spark, sf):
    return _rounded(dashboard.kpi_cards(_churn(spark, sf)), "avg_csat", "avg_missed_pickups")


def kpi_by_name(spark, sf):
    return _rounded(dashboard.kpi_cards(_churn(spark, sf), ["property_name"]), "avg_csat", "avg_missed_pickups")


def kpi_no_match(spark, sf):
    return dashboard.kpi_cards(dashboard.filter_portfolio(_churn(spark, sf), search="no such name"))


def alert_bottleneck(spark, sf):
    return _rounded(dashboard.bottleneck(_rollup(spark, sf)), "avg_resolution_time")


def dash_filtered(spark, sf):
    return dashboard.filter_portfolio(_churn(spark, sf), SEARCH_RISKS)


def dash_name_search(spark, sf):
    return dashboard.filter_portfolio(_churn(spark, sf), SEARCH_RISKS, SEARCH_TEXT)


def dash_health(spark, sf):
    return _rounded(reports.health_rollup(_health(spark, sf)), "avg_csat")


def _shown(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the portfolio that a user has filtered."""
    return dashboard.filter_portfolio(_churn(spark, sf), SEARCH_RISKS, SEARCH_TEXT)


# --- derived without gold ---


def fallback_property_name(spark, sf):
    ids = _silver(spark, sf).select("property_id").distinct()
    return ids.withColumn("property_name", fallback.property_name(F.col("property_id")))


def fallback_property_type(spark, sf):
    names = fallback_property_name(spark, sf)
    return names.withColumn("property_type", fallback.property_type(F.col("property_name")))


def fallback_churn(spark, sf):
    return fallback.churn_counts(_silver(spark, sf), "ticket_id")


def fallback_churn_from_export(spark, sf):
    path = storage.new_location(spark, "churn-export")
    csv_files.export_rag(_silver(spark, sf), path)
    return fallback.churn_counts(csv_files.read_rag_in_order(spark, path), "ingest_order")


def _service_counts(keep_missing: bool) -> Query:
    return lambda spark, sf: fallback.service_counts(adapters.conversation_tickets(spark, sf), keep_missing)


def fallback_pickup_share(spark, sf):
    counts = fallback.service_counts(_silver(spark, sf))
    return fallback.category_pickups(counts, _churn(spark, sf))


# --- documents, vectors, retrieval ---


def rag_documents(spark, sf):
    return documents.render(_labelled_conversations(spark, sf)).select("ticket_id", "page_content")


def rag_metadata(spark, sf):
    metadata = documents.render(_labelled_conversations(spark, sf)).select("ticket_id", "metadata")
    return metadata.select("ticket_id", F.explode("metadata").alias("name", "value"))


def _index(spark, sf) -> assistant.DocumentIndex:
    return assistant.build_index(adapters.conversation_tickets(spark, sf), _churn(spark, sf))


def embed_documents(spark, sf):
    """Non-zero weights of every document, which is all of each vector."""
    weights = _index(spark, sf).vectors.select(
        "ticket_id", F.posexplode("embedding").alias("dimension", "weight")
    )
    return weights.where(F.col("weight") != 0).withColumn("weight", F.round(F.col("weight").cast("double"), 6))


def embed_with_model(spark, sf):
    """The model plug, with letter counts in place of a sentence model."""

    def load_model():
        letters = [chr(code) for code in range(ord("a"), ord("z") + 1)]
        return lambda texts: [[text.count(letter) for letter in letters] for text in texts]

    encoded = encode_with_model(documents.render(_labelled_conversations(spark, sf)), load_model)
    return encoded.select("ticket_id", F.posexplode("embedding").alias("dimension", "weight")).withColumn(
        "weight", F.col("weight").cast("double")
    )


def _distances(hits: DataFrame) -> DataFrame:
    return _rounded(hits, "d2")


def knn_top5(spark, sf):
    corpus = adapters.vectors(spark, sf)
    return _distances(nearest.nearest(corpus, adapters.overall_centroid(corpus)))


def knn_cells(spark, sf):
    """The vectors stored by cell; every question reads only the cells that may hold its nearest ones."""
    corpus = adapters.vectors(spark, sf)
    index = cells.build(corpus, storage.new_location(spark, "cell-index"), cells=16)
    return _distances(cells.search(index, adapters.label_centroids(corpus)))


def knn_batch(spark, sf):
    corpus = adapters.vectors(spark, sf)
    return _distances(nearest.nearest(corpus, adapters.label_centroids(corpus)))


def knn_blocks(spark, sf):
    """The way a query set too large to ship takes, forced by a small limit."""
    corpus = adapters.vectors(spark, sf)
    return _distances(
        nearest.nearest(corpus, adapters.label_centroids(corpus), max_shipped=4, chunk_rows=200)
    )


def _hits(spark, sf) -> DataFrame:
    asked = storage.materialize(assistant.distinct_questions(adapters.questions(spark, sf)), "questions")
    return assistant.retrieve(_index(spark, sf), asked)


def knn_text(spark, sf):
    return _distances(_hits(spark, sf)).select("query_id", "position", "ticket_id", "d2")


def knn_preview(spark, sf):
    return evidence.previews(_hits(spark, sf))


def rag_context(spark, sf):
    return evidence.contexts(_hits(spark, sf))


def index_roundtrip(spark, sf):
    """Questions to an index that was stored and loaded."""
    path = storage.new_location(spark, "index")
    _index(spark, sf).save(path)
    asked = storage.materialize(assistant.distinct_questions(adapters.questions(spark, sf)), "questions")
    hits = assistant.retrieve(assistant.DocumentIndex.load(spark, path), asked)
    return hits.select("query_id", "position", "ticket_id", "page_content")


def rag_prompt(spark, sf):
    return assistant.rag_prompts(adapters.questions(spark, sf), _index(spark, sf))


def question_state(spark, sf):
    gold_set = _gold(spark, sf)
    index = assistant.build_index(adapters.conversation_tickets(spark, sf), gold_set["gold_churn_risk"])
    return assistant.question_state(adapters.questions(spark, sf), gold_set, index, AS_OF)


def request_answers(spark, sf):
    gold_set = _gold(spark, sf)
    index = assistant.build_index(adapters.conversation_tickets(spark, sf), gold_set["gold_churn_risk"])
    return assistant.request_answers(adapters.questions(spark, sf), gold_set, index, AS_OF)


def recommendation_prompt(spark, sf):
    return question_state(spark, sf).select("question", "recommendation_prompt")


def evidence_join(spark, sf):
    ranked = reports.high_churn(_churn(spark, sf))
    return evidence.ranked_evidence(ranked, _silver(spark, sf)).select(
        "position", "property_id", "property_name", "ticket_id", "complaint_description", "resolution_notes"
    )


def properties_without_complaints(spark, sf):
    kept = evidence.properties_without_complaints(
        _churn(spark, sf), adapters.conversation_tickets(spark, sf)
    )
    return kept.select("property_id", "property_name", "churn_risk_label")


def properties_with_complaints(spark, sf):
    kept = evidence.properties_with_complaints(_churn(spark, sf), adapters.conversation_tickets(spark, sf))
    return kept.select("property_id", "property_name", "churn_risk_label")


# --- routing ---


def route_can_handle(spark, sf):
    asked = adapters.questions(spark, sf)
    return asked.select("question_id", routing.can_handle(F.col("question")).alias("can_handle"))


def route_intent(spark, sf):
    asked = adapters.questions(spark, sf)
    return asked.select("question_id", "question", routing.intent(F.col("question")).alias("intent"))


def route_mode(spark, sf):
    return routing.routed(adapters.questions(spark, sf)).drop("question")


def _on(source: Query, step: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: step(source(spark, sf), *args)


QUERIES: dict[str, Query] = {
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_csv_by_name": bronze_csv_by_name,
    "bronze_csv_rejects": bronze_csv_rejects,
    "bronze_table_roundtrip": bronze_table_roundtrip,
    "silver_scan": silver_scan,
    "gold_table_roundtrip": gold_table_roundtrip,
    "catalog_tables": catalog_tables,
    "describe_gold": describe_gold,
    "sql_text": sql_text,
    "rag_export_roundtrip": rag_export_roundtrip,
    "rag_source_scan": rag_source_scan,
    "vector_roundtrip": vector_roundtrip,
    "vector_scan": vector_scan,
    "row_counts": row_counts,
    "silver_rename": silver_rename,
    "silver_property_name": _silver_column("property_name"),
    "silver_contract_value": _silver_column("contract_value"),
    "silver_missed_pickups": _silver_column("missed_pickups_30d"),
    "silver_renewal_date": _silver_column("renewal_date"),
    "silver_service_category": _silver_column("service_category"),
    "silver_churn_label": _silver_column("churn_risk_label"),
    "silver_quarantine": silver_quarantine,
    "silver_lenient": silver_lenient,
    "silver_stream": silver_stream_table,
    "gold_incremental": gold_incremental,
    "gold_snapshot": gold_snapshot,
    "lookup_join_category": lookup_join_category,
    "rag_projection": _on(_silver, documents.rag_projection),
    "base_aggregate": base_aggregate,
    "gold_churn_risk": _churn,
    "gold_property_health": _health,
    "gold_service_performance": _service,
    "gold_churn_from_base": gold_churn_from_base,
    "gold_service_from_base": gold_service_from_base,
    "bronze_null_profile": bronze_null_profile,
    "gold_duplicate_check": gold_duplicate_check,
    "name_duplicate_check": name_duplicate_check,
    "preview": preview,
    "intent_high_churn": _on(_churn, reports.high_churn),
    "portfolio_ranks": _on(_churn, reports.portfolio_ranks),
    "intent_low_csat": _on(_churn, reports.low_csat),
    "intent_missed_pickups": _on(_churn, reports.most_missed_pickups),
    "intent_contract_at_risk": _on(_churn, reports.contract_at_risk),
    "intent_service_performance": intent_service_performance,
    "intent_property_health": intent_property_health,
    "intent_renewal": _on(_churn, reports.renewing_soon, AS_OF),
    "renewal_window": _on(_churn, reports.renewal_window, AS_OF),
    "service_performance_deduped": service_performance_deduped,
    "answer_lines": answer_lines,
    "answer_texts": answer_texts,
    "kpi_cards": kpi_cards,
    "kpi_by_name": kpi_by_name,
    "kpi_no_match": kpi_no_match,
    "alert_urgent_renewals": _on(_churn, dashboard.urgent_renewals, AS_OF),
    "alert_lowest_csat": _on(_churn, dashboard.lowest_csat),
    "alert_bottleneck": alert_bottleneck,
    "dashboard_churn": _on(_churn, dashboard.churn_view),
    "dash_health": dash_health,
    "dash_filtered": dash_filtered,
    "dash_name_search": dash_name_search,
    "dash_risk_distribution": _on(_churn, dashboard.risk_distribution),
    "dash_category_bars": _on(_rollup, dashboard.category_bars),
    "dash_scatter": _on(_churn, dashboard.scatter),
    "dash_scatter_filtered": _on(_shown, dashboard.scatter),
    "dash_leaderboard_filtered": _on(_shown, dashboard.leaderboard),
    "dash_missed_series": _on(_churn, dashboard.missed_series),
    "dash_leaderboard": _on(_churn, dashboard.leaderboard),
    "fallback_property_name": fallback_property_name,
    "fallback_property_type": fallback_property_type,
    "fallback_churn": fallback_churn,
    "fallback_churn_from_export": fallback_churn_from_export,
    "fallback_service_counts": _service_counts(False),
    "fallback_service_counts_filled": _service_counts(True),
    "fallback_pickup_share": fallback_pickup_share,
    "fallback_health": _on(_churn, fallback.health),
    "rag_fill_nulls": _on(_labelled_conversations, documents.fill_nulls),
    "rag_documents": rag_documents,
    "rag_metadata": rag_metadata,
    "embed_documents": embed_documents,
    "embed_with_model": embed_with_model,
    "knn_top5": knn_top5,
    "knn_batch": knn_batch,
    "knn_cells": knn_cells,
    "knn_blocks": knn_blocks,
    "knn_text": knn_text,
    "knn_preview": knn_preview,
    "rag_context": rag_context,
    "rag_prompt": rag_prompt,
    "recommendation_prompt": recommendation_prompt,
    "question_state": question_state,
    "request_answers": request_answers,
    "index_roundtrip": index_roundtrip,
    "evidence_join": evidence_join,
    "properties_without_complaints": properties_without_complaints,
    "properties_with_complaints": properties_with_complaints,
    "route_can_handle": route_can_handle,
    "route_intent": route_intent,
    "route_mode": route_mode,
}
