"""Chat formatting after collapsing cumulative snapshots.

Logs often hold a conversation many times, each time with more turns. A
conversation goes when its turns are the beginning of another one's, or equal
to those of one with a smaller id. What stays is rendered turn by turn.

Every turn is hashed together with its number; the rolling hash of a prefix is
the sum of its turns' hashes, two independent 64-bit ones added up exactly.
The sum runs over blocks of turn numbers first and over the blocks' totals
then, so one conversation with a large share of all turns is spread out.
Anti-joins meet distinct hashes on both sides. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight.sources.storage import materialize

#: Turn numbers per block of the rolling sum, and per part of a rendered conversation.
BLOCK = 256
PART = 64
#: Turns without a number come last.
LAST = (1 << 62) - 1


def turns(df: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` without nulls, but for the id."""
    return df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def prefixes(df: DataFrame) -> DataFrame:
    """Per conversation and turn number the hashes ``h1``, ``h2`` of all up to there, and whether it is the ``last``."""

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "turn", "role", "text").cast("decimal(20,0)")

    steps = (
        turns(df)
        .select("conv_id", "turn", hashed(1).alias("h1"), hashed(2).alias("h2"))
        .distinct()
        .groupBy("conv_id", "turn")
        .agg(*(F.sum(h).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")))
        .withColumn("block", F.floor(F.col("turn") / BLOCK))
    )
    steps = materialize(steps, "turn-hashes")
    by_block = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = steps.groupBy("conv_id", "block").agg(*(F.sum(h).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")), F.max("turn").alias("end"))
    blocks = blocks.select(
        F.col("conv_id").alias("conv"),
        F.col("block").alias("of_block"),
        *(F.coalesce(F.sum(h).over(by_block), F.lit(0)).cast("decimal(38,0)").alias(f"{h}_before") for h in ("h1", "h2")),
        F.max("end").over(Window.partitionBy("conv_id")).alias("conv_end"),
    )
    by_turn = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = steps.select("conv_id", "block", "turn", *(F.sum(h).over(by_turn).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")))
    joined = rolled.join(blocks, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("block") == F.col("of_block")))
    return joined.select(
        "conv_id",
        "turn",
        *((F.col(h) + F.col(f"{h}_before")).cast("decimal(38,0)").alias(h) for h in ("h1", "h2")),
        (F.col("turn") == F.col("conv_end")).alias("last"),
    )


def maximal(df: DataFrame) -> DataFrame:
    """The conversations that stay: ``conv_id`` and ``copies``, how many have exactly these turns."""
    rolled = materialize(prefixes(df), "prefixes")
    keys = ["turn", "h1", "h2"]
    whole = rolled.where("last").groupBy(*keys).agg(F.min_by("conv_id", F.coalesce("conv_id", F.lit(-(1 << 63)))).alias("conv_id"), F.count("*").alias("copies"))
    inner = rolled.where("NOT last").select(*keys).distinct()
    return whole.join(inner, keys, "left_anti").select("conv_id", "copies")


def rendered_turn() -> Column:
    role = F.when(F.col("role") == "", "unknown").otherwise(F.lower(F.trim("role")))
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))


def render(df: DataFrame) -> DataFrame:
    """Maximal conversations as text: ``conv_id``, ``part``, ``n_turns``, ``text``, ``copies``.

    A part holds the turns of PART successive numbers, so most conversations
    have one, and a very long one is never gathered in one row; its text is
    that of its parts in order. Turns go by number, those without one come
    last in a part of their own. Turns that repeat in all columns count once;
    other turns of one number go by role and text. Null text counts as empty,
    a null or empty role as ``unknown``, and rows without ``conv_id`` are one
    conversation with a null id, which counts as the smallest. Texts stay
    whole. Extra columns play no part; an empty table gives no rows.
    """
    kept = materialize(maximal(df), "maximal").select(F.col("conv_id").alias("kept_id"), "copies")
    said = turns(df).join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    said = said.withColumn("part", F.when(F.col("turn") < LAST, F.floor(F.col("turn") / PART)).otherwise(LAST // PART))
    parts = said.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_set(F.struct("turn", "role", "text", rendered_turn().alias("out")))).alias("turns"), F.first("copies").alias("copies")
    )
    return parts.select(
        "conv_id",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("text"),
        "copies",
    )
