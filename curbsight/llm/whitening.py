"""Whitening of embeddings from an exact scatter matrix by bit slices.

Components become whole numbers. Within a block of rows each dimension is
shifted by its least value there, and the bits of what is left are sliced: a
plane holds one bit of one dimension, 64 rows to a word. The sum of products
of two dimensions is the sum over pairs of their planes of the number of rows
that have both bits, popcount(a AND b), times 2 to the sum of the bits'
places; shifts are added back. So count, sums and cross-products are exact,
whatever the order of rows, tasks or blocks.

Each task adds its blocks up and gives one row per pair of dimensions; Spark
sums them. What reaches the driver has the size of the covariance matrix. It
is centred there in whole numbers and decomposed once; its eigenvectors go to
the tasks, which project every row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import importable, to_batch
from curbsight.llm.vectors import blocks, finite, scaled
from curbsight.sources.storage import materialize

SCALE = 64.0
SHIFT = 1_000_000
COMPONENTS = 32
#: Weighted popcounts of a block stay within 64 bits up to so many planes per dimension.
NARROW_PLANES = 24
#: Exact sums travel as two decimals: high * 2**60 + low.
LIMB = 60
#: Eigenvalues under this share of the largest are rounding noise of a matrix without full rank.
NO_VARIANCE = 1e-13
LONGEST = (1 << 63) - 1


def planes(y: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of ``y`` (whole numbers of 0 and more), 64 rows to a word: dimension, place of the bit, word."""
    places = max(1, int(y.max(initial=0)).bit_length())
    rows = -(-max(1, len(y)) // 64) * 64
    sliced = np.empty((y.shape[1], places, rows // 8), np.uint8)
    for place in range(places):
        bits = np.zeros((y.shape[1], rows), np.uint8)
        bits[:, : len(y)] = (y.T >> place) & 1
        sliced[:, place] = np.packbits(bits, axis=1)
    return sliced.view(np.uint64)


def products(y: np.ndarray) -> np.ndarray:
    """Sums over rows of the products of each two columns, by AND and popcount of their planes."""
    sliced = planes(y)
    size, places, _ = sliced.shape
    flat = sliced.reshape(size * places, -1)
    counts = np.empty((len(flat), len(flat)), np.int64)
    for at, own in enumerate(flat):
        both = np.bitwise_count(flat[at:] & own).sum(axis=1, dtype=np.int64)
        counts[at, at:] = counts[at:, at] = both
    if places > NARROW_PLANES:
        counts = counts.astype(object)
    weights = np.array([1 << place for place in range(places)], counts.dtype)
    by_pair = counts.reshape(size, places, size, places)
    return np.tensordot(np.tensordot(by_pair, weights, (3, 0)), weights, (1, 0))


class Scatter:
    """Count, sums and cross-products of rows of whole numbers, in Python integers."""

    def __init__(self, size: int):
        self.n, self.sums, self.cross = 0, np.zeros(size, object), np.zeros((size, size), object)

    def add(self, x: np.ndarray) -> None:
        shift = x.min(axis=0)
        y = x - shift
        of_y, shift, n = y.sum(axis=0).astype(object), shift.astype(object), len(x)
        self.cross = self.cross + products(y).astype(object) + np.outer(of_y, shift) + np.outer(shift, of_y) + n * np.outer(shift, shift)
        self.sums = self.sums + of_y + n * shift
        self.n += n


def whole_numbers(column: pa.Array) -> np.ndarray:
    return scaled(column, SCALE) + SHIFT


def scatter(vectors: DataFrame) -> Scatter | None:
    """Of all rows of ``x``, vectors of one length; None without rows.

    The sums of dimension i stand beside the cross-products as row (i, -1),
    the count as (-1, -1).
    """

    def run(batches):
        own = None
        for batch in blocks(batches):
            x = whole_numbers(batch.column("x"))
            own = own or Scatter(x.shape[1])
            own.add(x)
        if own is None:
            return
        rows = [(-1, -1, own.n), *((i, -1, s) for i, s in enumerate(own.sums))]
        rows += [(i, j, own.cross[i, j]) for i in range(len(own.sums)) for j in range(i + 1)]
        yield to_batch([(i, j, int(v) >> LIMB, int(v) & ((1 << LIMB) - 1)) for i, j, v in rows], arrow)

    arrow = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))])
    parts = vectors.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    # One row per pair of dimensions, whatever the number of vectors.
    totals = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    values = {(r["i"], r["j"]): (int(r["high"]) << LIMB) + int(r["low"]) for r in totals}
    if not values:
        return None
    result = Scatter(max(i for i, _ in values) + 1)
    result.n = values[-1, -1]
    for i in range(len(result.sums)):
        result.sums[i] = values[i, -1]
        for j in range(i + 1):
            result.cross[i, j] = result.cross[j, i] = values[i, j]
    return result


class Whitener(NamedTuple):
    """Learnt from a scatter: ``sums`` and ``n`` for centring, ``axes`` (columns, each over the root of its eigenvalue)."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def learn(found: Scatter, components: int = COMPONENTS) -> Whitener:
    """Eigenvectors by falling eigenvalue. Components without variance have an axis of nan, and ``explained`` 0."""
    n = found.n
    centred = n * found.cross - np.outer(found.sums, found.sums)  # n * n times the covariance, whole numbers
    covariance = np.array([[v / (n * n) for v in row] for row in centred.tolist()], float)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = np.trace(covariance)
    good = values > max(values.max(initial=0.0), 0.0) * NO_VARIANCE
    scaled_axes = np.full(axes.shape, np.nan)
    scaled_axes[:, good] = axes[:, good] / np.sqrt(values[good])
    projected = scaled_axes[:, good].T @ covariance @ scaled_axes[:, good]
    error = float(np.abs(projected - np.eye(len(projected))).max(initial=0.0))
    explained = np.where(good, values, 0.0) / trace if trace > 0 else np.zeros(len(values))
    return Whitener(n, [int(s) for s in found.sums], scaled_axes, explained, error)


def centred(x: np.ndarray, model: Whitener) -> tuple[np.ndarray, list[int | None]]:
    """x - S/n, rounded once, and the exact sum of squares of n x - S for each row; None where it exceeds 64 bits."""
    largest = max(model.n * (int(np.abs(x).max(initial=0)) + 1), max(map(abs, model.sums)))
    narrow = (2 * largest) ** 2 * x.shape[1] <= LONGEST
    if not narrow:  # the differences themselves are mostly small
        x = x.astype(object)
    differences = x * model.n - np.array(model.sums, x.dtype)
    if not narrow and differences.size and (int(np.abs(differences).max()) ** 2) * x.shape[1] <= LONGEST:
        differences = differences.astype(np.int64)
    squares = (differences * differences).sum(axis=1)
    return differences.astype(float) / model.n, [int(s) if s <= LONGEST else None for s in squares]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold null or non-finite components take no part,
    nor do empty ones and those of another length than most (see
    :func:`curbsight.llm.vectors.finite`). ``deviation`` is null where the
    exact sum exceeds 64 bits; a component without variance has a null
    ``whitened`` and explains 0. Components are as many as dimensions at most.
    Repeated rows count and come out each time, null ids stay null, other
    columns play no part. An empty table gives no rows.
    """
    importable(df.sparkSession)
    chosen = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    vectors = materialize(finite(chosen, "vector").select("vec_id", "x"), "finite-vectors")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = scatter(vectors)
    if found is None:
        return df.sparkSession.createDataFrame([], schema)
    model = learn(found, components)
    size = model.axes.shape[1]

    def run(batches):
        for batch in blocks(batches):
            offsets, deviations = centred(whole_numbers(batch.column("x")), model)
            rows = batch.num_rows
            whitened = (offsets @ model.axes).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), size))),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * size, model.n, np.int64)),
                    pa.array(deviations, pa.int64()).take(pa.array(np.repeat(np.arange(rows), size))),
                    pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * size, model.identity_error)),
                ],
                [c.split()[0] for c in schema.split(", ")],
            )

    return vectors.mapInArrow(run, schema)
