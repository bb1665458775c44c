"""Ticket and retrieval CSV files.

Quotes are doubled, as most CSV tools expect, and records may hold line ends.
A file with line ends inside records is read by one task, so exports keep the
files small and large feeds should arrive as many files. Where the producer
guarantees one line per record, ``multi_line=False`` lets Spark split files.

Columns are found by the names in the header, whatever their order. A missing
column fails; columns beyond the expected ones are kept as text. The files of
one load share a header, which Spark checks. A cell that its column can't hold
fails the load too, unless the load asks for ``rejects``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight import fixed_values as fv

TICKET_SCHEMA = T.StructType(
    [
        T.StructField("ticket_id", T.LongType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("sla_plan", T.StringType()),
        T.StructField("initial_message", T.StringType()),
        T.StructField("agent_first_reply", T.StringType()),
        T.StructField("resolution_summary", T.StringType()),
        T.StructField("customer_sentiment", T.StringType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("csat_score", T.LongType()),
        T.StructField("resolution_time_hours", T.DoubleType()),
    ]
)

RAG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in fv.RAG_COLUMNS])

ROWS_PER_FILE = 200_000


REJECTED = "_rejected"


def read_tickets(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TICKET_SCHEMA,
    multi_line: bool = True,
    rejects: bool = False,
) -> DataFrame:
    """Raw tickets with declared types, so that loads cannot drift and need one pass.

    With ``rejects`` a record that does not fit its types is kept, with its
    text in the column ``_rejected``, for :func:`split_rejects`.
    """
    return _read(spark, path, schema, multi_line, rejects)


def split_rejects(tickets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records without the column of rejected texts, and the rejected ones with it.

    Both frames scan the files; write ``tickets`` to a table first to parse once.
    Either side has the same records for any columns that are selected from it.
    """
    # Spark converts only the cells it is asked for, so the condition asks for all that can be bad.
    good = F.when(_read_at_all(tickets), F.col(REJECTED)).isNull()
    return tickets.where(good).drop(REJECTED), tickets.where(~good)


def write_tickets(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    _write(df, path, rows_per_file)


def export_rag(
    df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, single_file: bool = False
) -> None:
    """Export the retrieval columns. ``single_file`` funnels all rows through one task; keep it
    for hand-offs that are known to be small."""
    out = df.select(*fv.RAG_COLUMNS)
    if single_file:
        _write(out.coalesce(1), path, 0)
    else:
        _write(out, path, rows_per_file)


def read_rag(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    null_words: Sequence[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Retrieval export; only ``columns`` are parsed. ``null_words`` (say ``NA``) also count as null."""
    names = list(columns) if columns is not None else fv.RAG_COLUMNS
    df = _read(spark, path, RAG_SCHEMA, multi_line).select(*names)
    if not null_words:
        return df
    words = list(null_words)
    return df.select(*[F.when(~F.col(c).isin(words), F.col(c)).alias(c) for c in names])


def read_rag_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Retrieval export with ``ingest_order``, which sorts records as they lie in the files.

    One task reads a whole file from its start, so file and the counter within
    the task order the records without moving any row. Files go by the numbers
    in their names, part and file of the part, as numbers.
    """
    file = F.col("_metadata.file_name")
    return _read(spark, path, RAG_SCHEMA, True).select(
        *fv.RAG_COLUMNS,
        F.struct(
            _number(file, r"part-(\d+)").alias("part"),
            _number(file, r"-c(\d+)").alias("part_file"),
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("position"),
        ).alias("ingest_order"),
    )


def _number(text: Column, pattern: str) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit("9" * 18)).cast("long")


def _read(
    spark: SparkSession, path: str, expected: T.StructType, multi_line: bool, rejects: bool = False
) -> DataFrame:
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    found = spark.read.options(**options).csv(path).columns  # the header only
    missing = [f.name for f in expected if f.name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    known = {f.name: f for f in expected}
    fields = [known.get(name, T.StructField(name, T.StringType())) for name in found]
    names = [*expected.names, *(name for name in found if name not in known)]
    options["enforceSchema"] = False  # header and schema must agree in every file
    options["columnPruning"] = False  # too few or many cells are noticed whichever are asked for
    if rejects:
        fields.append(T.StructField(REJECTED, T.StringType()))
        names.append(REJECTED)
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    else:
        options["mode"] = "FAILFAST"
    read = spark.read.options(**options).schema(T.StructType(fields)).csv(path).select(*names)
    if rejects:
        return read
    # A bad record fails any use of the frame, also one that needs none of its columns.
    return read.where(_read_at_all(read))


def _read_at_all(df: DataFrame) -> Column:
    """True for every record, in a way that has Spark convert all cells that may not fit."""
    typed = [f.name for f in df.schema if f.dataType != T.StringType()] or df.columns[:1]
    return F.length(F.concat_ws(",", *(F.col(f"`{c}`").cast("string") for c in typed))) >= 0


def _write(df: DataFrame, path: str, rows_per_file: int) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
