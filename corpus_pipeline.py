"""From raw documents to packed training sequences.

Each stage takes the stored result of the one before, with the columns of
``documents``, and decides about all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm import line_dedup, near_dedup, packing, quality
from curbsight.llm.common import read
from curbsight.llm.queries import WORD_VOCABULARY, vocabulary
from curbsight.sources.storage import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from four fifths of ``labels``."""
    return quality.accepted(docs, read(spark, sf_dir, "labels").where(~quality.held_out()))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated passages, ``n_chars`` made to fit.

    A whole copy is left with an empty text; the next stage keeps one of those.
    """
    cut = line_dedup.clean(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return near_dedup.representatives(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, cut into pieces and packed into sequences."""
    return packing.pack(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("quality_classifier", good),
    ("line_dedup", without_repeats),
    ("minhash_near_dedup", one_of_each),
    ("best_fit_packing", pack),
]
#: Learned scores, sketches and tokenizers can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each on the stored result of the one before."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
