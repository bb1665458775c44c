"""The operators of this subpackage as named queries over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbsight.llm import bpe, chat, codes, exact_dedup, fixity, licences, line_dedup, mixture, near_dedup, packing, quality, top_k, whitening
from curbsight.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """The content of a public vocabulary file."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def chat_texts(spark: SparkSession, sf: str) -> DataFrame:
    return chat.render(read(spark, sf, "conversations"))


def nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20."""
    vectors = top_k.quantised(read(spark, sf, "embeddings"))
    return top_k.search(vectors.where("vec_id % 20 = 0"), vectors, 20)


def damaged_records(spark: SparkSession, sf: str) -> DataFrame:
    """An archive of all pages against a replica in which some records, chosen by their content, are damaged or gone."""
    records = fixity.warc_records(read(spark, sf, "pages"))
    chosen = F.substring(F.sha2("record", 256), 1, 2)
    damaged = F.concat(F.col("record"), F.lit(b"?"))
    replica = records.where(chosen >= "04").withColumn("record", F.when(chosen >= "fc", damaged).otherwise(F.col("record")))
    return fixity.audit(records, replica)


def licences_found(spark: SparkSession, sf: str) -> DataFrame:
    return licences.recognise(read(spark, sf, "documents"))


def near_copies(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf, "documents"))


def exact_copies(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.deduplicate(read(spark, sf, "documents"))


def packed_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"), vocabulary(WORD_VOCABULARY))


def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents; a fifth of the labels, by id, stays unseen."""
    labels = read(spark, sf, "labels").where(~quality.held_out())
    return quality.scored(read(spark, sf, "documents"), labels).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.clean(read(spark, sf, "documents")).select("doc_id", "text", "removed_lines")


def bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    model = vocabulary(BYTE_VOCABULARY)
    return bpe.decode(bpe.encode(read(spark, sf, "documents"), model), model).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


def whitened_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"))


def vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.encode(read(spark, sf, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def mixed_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Every sequence has each source in its share of all tokens."""
    return mixture.pack(read(spark, sf, "documents"), vocabulary(WORD_VOCABULARY))


QUERIES: dict[str, Query] = {
    "op1_chat_formatting": chat_texts,
    "op2_exact_top_k": nearest_vectors,
    "op3_warc_fixity": damaged_records,
    "op4_licence_scan": licences_found,
    "op5_order_minhash": near_copies,
    "op6_exact_dedup": exact_copies,
    "op7_best_fit_packing": packed_sequences,
    "op8_quality_classifier": quality_scores,
    "op9_line_dedup": repeated_lines,
    "op10_bpe_round_trip": bpe_round_trip,
    "op11_whitening": whitened_vectors,
    "op12_vector_codes": vector_codes,
    "op13_mixture_packing": mixed_sequences,
}
