"""An inverted-file index of vectors: exact nearest neighbours from few cells.

Centres are fitted on a bounded sample. Every vector is stored under the cell
of its nearest centre, the cell being the partition column, and each cell
keeps its radius, the greatest distance from its centre. By the triangle
inequality nothing in a cell is nearer to a query than the query's distance to
the centre less the radius.

A search first reads, for each query, its most promising cells until these
hold ``k`` vectors. The k-th distance found there is a bound; all further cells
that may hold something as near are read in a second pass, and no others, by
partition pruning. So results are exact and equal those of
:func:`curbsight.operators.nearest.nearest`.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from curbsight import fixed_values as fv
from curbsight.operators import nearest as plain
from curbsight.operators.nearest import SCORE_CELLS, _Best, _ids, _matrix
from curbsight.sources.storage import materialize

# The helpers below travel with the task, so executors need no copy of this package. In tasks they
# go by their own names: a module that is named there travels whole, with all that it imports.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Centres are fitted on so many vectors at most, those of least id hash.
SAMPLE = 20_000
FIT_ROUNDS = 8
MAX_CELLS = 4096
VECTORS_PER_CELL = 2_000
#: Bounds give way by this share, so that rounding never hides a cell.
SLACK = 1e-9


def fit_centres(vectors: DataFrame, cells: int | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> np.ndarray:
    """Centres from a bounded sample: farthest-first starts, then rounds of means. Fewer where the sample has fewer different vectors."""
    sample = vectors.orderBy(F.xxhash64(vec_id)).limit(SAMPLE).select(embedding).toArrow().column(0).combine_chunks()
    points = np.unique(_matrix(sample), axis=0)
    wanted = cells or max(1, min(MAX_CELLS, vectors.count() // VECTORS_PER_CELL, len(points) // 8))
    order = np.random.default_rng(7).permutation(len(points))
    centres = points[order[:wanted]]
    for _ in range(FIT_ROUNDS):
        own = nearest_centre(points, centres)[0]
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point its nearest centre and the distance to it."""
    own, distance = np.zeros(len(points), np.int64), np.zeros(len(points))
    step = max(1, SCORE_CELLS // max(1, len(centres)))
    norms = np.einsum("ij,ij->i", centres, centres)
    for at in range(0, len(points), step):
        part = points[at : at + step]
        best = np.argmin(norms - 2.0 * (part @ centres.T), axis=1)
        own[at : at + step] = best
        distance[at : at + step] = np.sqrt(((part - centres[best]) ** 2).sum(axis=1))
    return own, distance


def build(vectors: DataFrame, path: str, cells: int | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> CellIndex:
    """Store the vectors by cell under ``path``, with a table of the cells.

    A null or empty vector fails, as do unequal lengths and values that are
    not finite. A cell with very many vectors is written by many tasks and
    searched in many.
    """
    spark, chosen = vectors.sparkSession, vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    centres = fit_centres(chosen, cells)
    shipped = spark.sparkContext.broadcast(centres)  # MAX_CELLS at most
    schema = T.StructType([*chosen.schema.fields, T.StructField("distance", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    out = to_arrow_schema(schema)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance = nearest_centre(_matrix(batch.column(1)), shipped.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(distance), pa.array(own.astype(np.int32))], schema=out)

    # Sorted within tasks: each writes one file per cell it meets, without moving vectors.
    stored = chosen.mapInArrow(placed, schema).sortWithinPartitions("cell")
    stored.write.mode("errorifexists").partitionBy("cell").parquet(f"{path}/vectors")
    by_cell = spark.read.parquet(f"{path}/vectors").groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("size"))
    rows = [(r.cell, r.radius, r.size, centres[r.cell].tolist()) for r in by_cell.orderBy("cell").collect()]
    spark.createDataFrame(rows, "cell int, radius double, size long, centre array<double>").coalesce(1).write.parquet(f"{path}/cells")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> CellIndex:
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # MAX_CELLS at most
    return CellIndex(
        spark.read.parquet(f"{path}/vectors"),
        np.array([r.cell for r in rows], np.int64),
        np.array([r.radius for r in rows]),
        np.array([r.size for r in rows], np.int64),
        np.array([r.centre for r in rows], float).reshape(len(rows), -1),
    )


class CellIndex(NamedTuple):
    """Stored vectors (``vec_id``, ``embedding``, ``distance``, ``cell``) and, per cell that has any, number, radius, size and centre."""

    vectors: DataFrame
    cells: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    centres: np.ndarray


def _bounds(points: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Per query and cell: no vector of the cell is nearer than this."""
    to_centres = np.sqrt(np.maximum(((points[:, None, :] - centres[None]) ** 2).sum(axis=2), 0.0))
    return np.maximum(to_centres * (1 - SLACK) - radii * (1 + SLACK) - SLACK, 0.0)


def search(index: CellIndex, queries: DataFrame, k: int = fv.RETRIEVAL_K, query_id: str = "query_id", embedding: str = "embedding", visits: int | None = None) -> DataFrame:
    """The ``k`` nearest stored vectors of every query: ``(query_id, vec_id, d2, position)``, as the full search gives them.

    ``visits`` makes the search approximate: no query reads more cells than
    that. It is off by default. Query ids are unique.
    """
    queries = queries.select(F.col(query_id).alias("query_id"), F.col(embedding).alias("embedding"))
    if not len(index.cells):
        return plain.nearest(index.vectors, queries, k).withColumnRenamed("query_id", query_id)
    first = materialize(_wanted(index, queries, k, visits), "first-cells")
    found = materialize(_met(index, first, k), "first-candidates")
    if visits is None:
        ranked = plain._merge(found, k, "query_id", "vec_id")
        worst = ranked.where(F.col("position") == k).select("query_id", F.col("d2").alias("worst"))
        further = materialize(_wanted(index, queries.join(worst, "query_id", "left"), k, None, first_seen=True), "further-cells")
        found = found.unionByName(_met(index, further, k))
    return plain._merge(found, k, "query_id", "vec_id").withColumnRenamed("query_id", query_id)


def cells_read(index: CellIndex, wanted: DataFrame) -> list[int]:
    return sorted(r.cell for r in wanted.select("cell").distinct().collect())  # MAX_CELLS at most


def _wanted(index: CellIndex, queries: DataFrame, k: int, visits: int | None, first_seen: bool = False) -> DataFrame:
    """``query_id``, ``embedding`` and ``cell``: the cells of least bound that hold ``k`` vectors, or, once these are seen, all others within the bound.

    Which cells a query has seen follows from the query alone, so it is worked out again.
    """
    # Arrays only: a broadcast names the classes of its value, which executors without this package don't know.
    shipped = queries.sparkSession.sparkContext.broadcast((index.cells, index.radii, index.sizes, index.centres))
    fields = [queries.schema["query_id"], queries.schema["embedding"], T.StructField("cell", T.IntegerType())]
    schema = T.StructType(fields)
    out = to_arrow_schema(schema)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, radii, sizes, centres = shipped.value
        for whole in batches:
            step = max(1, SCORE_CELLS // centres.size)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                points = _matrix(batch.column(1))
                bounds = _bounds(points, centres, radii)
                middle = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
                order = np.lexsort((middle, bounds), axis=1)
                held = np.cumsum(sizes[order], axis=1)
                seen = np.concatenate([np.zeros((len(points), 1), bool), held[:, :-1] >= k], axis=1) == 0
                if visits is not None:
                    seen = np.arange(len(cells))[None] < visits
                    seen = np.broadcast_to(seen, order.shape)
                if first_seen:
                    worst = np.array([np.inf if w is None else w for w in batch.column(2).to_pylist()])
                    near = np.take_along_axis(bounds, order, axis=1) ** 2 <= worst[:, None] * (1 + SLACK)
                    seen = ~seen & near
                row, place = np.nonzero(seen)
                chosen = cells[order[row, place]].astype(np.int32)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(chosen)], schema=out)

    columns = ["query_id", "embedding", *(["worst"] if first_seen else [])]
    return queries.select(*columns).mapInArrow(choose, schema)


def _met(index: CellIndex, wanted: DataFrame, k: int) -> DataFrame:
    """Candidates ``query_id``, ``vec_id``, ``d2``: every query meets the vectors of the cells it wants.

    Cells and the queries that want them are cut into pieces of bounded size;
    only cells that some query wants are read.
    """
    read = cells_read(index, wanted)
    rows = max(1, min(plain.CHUNK_ROWS, plain.MAX_CHUNK_VALUES // index.centres.shape[1]))
    asked = {r.cell: r["count"] for r in wanted.groupBy("cell").count().collect()}
    sizes = dict(zip(index.cells.tolist(), index.sizes.tolist()))
    cuts = lambda counts: F.create_map(*(F.lit(v) for c in read for v in (c, plain._cuts(counts[c], rows)))) if read else F.create_map(F.lit(0), F.lit(1))
    chunks, blocks = cuts(sizes), cuts(asked)
    left = wanted.select(
        F.col("query_id").alias("asked_id"),
        F.col("embedding").alias("asked_vector"),
        "cell",
        F.pmod(F.xxhash64("query_id"), blocks[F.col("cell")]).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), chunks[F.col("cell")] - 1)).alias("chunk"),
    )
    right = index.vectors.where(F.col("cell").isin(read)).select(
        "vec_id",
        "embedding",
        "cell",
        F.explode(F.sequence(F.lit(0), blocks[F.col("cell")] - 1)).alias("block"),
        F.pmod(F.xxhash64("vec_id"), chunks[F.col("cell")]).cast("int").alias("chunk"),
    )
    schema = T.StructType(
        [
            T.StructField("query_id", wanted.schema["query_id"].dataType),
            T.StructField("vec_id", index.vectors.schema["vec_id"].dataType),
            T.StructField("d2", T.DoubleType()),
        ]
    )
    out = to_arrow_schema(schema)

    def meet(block: pa.Table, chunk: pa.Table) -> pa.Table:
        if block.num_rows == 0 or chunk.num_rows == 0:
            return out.empty_table()
        block, chunk = block.combine_chunks(), chunk.combine_chunks()
        best = _Best(_matrix(block.column(1).chunk(0)), k)
        best.add(_ids(chunk.column(0).chunk(0)), _matrix(chunk.column(1).chunk(0)))
        return best.table(block.column(0).chunk(0), out)

    keys = ["cell", "block", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
