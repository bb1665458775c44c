"""Vectors as numpy blocks, for the operators that compute on whole numbers of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components beyond this count as this, so that exact sums have a known number of digits.
LARGEST = 2.0**45
BLOCK_ROWS = 4096


def finite(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The rows whose vector has components, all of them finite numbers, of the length that most such rows have.

    Of equally frequent lengths the greater one counts: vectors of several
    lengths have no common axes. The vector comes as a further column ``x`` of
    doubles, its components clipped to LARGEST on both sides.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    clipped = F.transform("x", lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c)))
    rows = df.withColumn("x", x).where((F.size("x") > 0) & whole).withColumn("x", clipped)
    length = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("x") == (length["n"] if length else 0))


def scaled(column: pa.Array, by: float) -> np.ndarray:
    """floor(by * component) of vectors of one length, a row each; exact, since ``by`` is a power of two."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(values * by).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
