"""Text to vectors.

``TermEncoder`` needs no model file: hashed terms weighted by rarity and
scaled to unit length, all inside the JVM. ``encode_with_model`` plugs in any
sentence model instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight import fixed_values as fv

DIMENSIONS = 512


class TermEncoder:
    """Fitted once over the documents; the same instance then encodes the questions."""

    def __init__(self, model: PipelineModel):
        self.model = model

    @classmethod
    def fit(cls, documents: DataFrame, text: str = "page_content", dimensions: int = DIMENSIONS) -> TermEncoder:
        """One pass over the texts; what reaches the driver is one count per dimension."""
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_terms", pattern=r"[\p{L}\p{N}]+", gaps=False),
            HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=dimensions),
            IDF(inputCol="_counts", outputCol="_weights"),
            Normalizer(inputCol="_weights", outputCol="_unit", p=2.0),
        ]
        return cls(Pipeline(stages=stages).fit(_with_text(documents.select(text), text)))

    def encode(self, df: DataFrame, text: str = "page_content", out: str = "embedding") -> DataFrame:
        """Add an ``array<float>`` column. A text without terms gets the zero vector."""
        encoded = self.model.transform(_with_text(df, text))
        return encoded.select(*df.columns, vector_to_array("_unit", "float32").alias(out))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> TermEncoder:
        return cls(PipelineModel.load(path))


def encode_with_model(
    df: DataFrame,
    load_model: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    text: str = "page_content",
    out: str = "embedding",
    batch_rows: int = fv.EMBEDDING_BATCH_ROWS,
) -> DataFrame:
    """Add vectors from a model. ``load_model`` runs once per task and returns a function
    from a list of texts to a matrix with one row per text."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            rows = []
            for start in range(0, len(texts), batch_rows):
                matrix = model(texts.iloc[start : start + batch_rows].tolist())
                rows.extend(np.asarray(matrix, dtype=np.float32))
            yield pd.Series(rows, dtype=object)

    return df.withColumn(out, encode(F.coalesce(text, F.lit(""))))


def _with_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_text", F.coalesce(text, F.lit("")))
