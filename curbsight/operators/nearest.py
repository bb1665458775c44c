"""Exact nearest neighbours by squared Euclidean distance.

Each task keeps only its best ``k`` rows per query while it streams through
its part of the corpus; a salted ranking then merges the tasks' candidates.
No pair of a query and a vector leaves the task that scored it unless it is
among that task's best.

A query set of checked size is shipped to the tasks. A larger one is cut into
blocks, and bounded blocks of queries meet bounded chunks of the corpus in a
shuffle, so neither side has to fit anywhere whole. Each block and chunk make a
task of their own.

Every pair is compared: by a product in single precision, whose error has a
bound. Only what may be among the best by that bound is measured exactly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cached_property
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from curbsight import fixed_values as fv
from curbsight.sources.storage import materialize

# The helpers below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_SHIPPED_QUERIES = 2048
MAX_SHIPPED_VALUES = 4_000_000
CHUNK_ROWS = 50_000
MAX_CHUNK_VALUES = 25_000_000
#: So many tasks a core, unless blocks and chunks would have fewer rows than that.
TASKS_PER_CORE = 4
LEAST_CUT_ROWS = 1000
#: Queries that are scored at once, and pairs.
PART_QUERIES = 512
SCORE_CELLS = 2_000_000
MANY_TIES = 8
#: Twice the rounding error of a single-precision operation; squares that its range surely holds.
ROUGH = 2.0**-23
ROUGH_RANGE = 1e-30, 1e30
MERGE_SALTS = 32


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = fv.RETRIEVAL_K,
    vec_id: str = "vec_id",
    query_id: str = "query_id",
    embedding: str = "embedding",
    max_shipped: int = MAX_SHIPPED_QUERIES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query: ``(query_id, vec_id, d2, position)``.

    Ids are unique on each side. Equal distances fall back on the vector id.
    A null or empty vector on either side fails the search, as do unequal
    lengths and values that are not finite.
    """
    corpus, queries = corpus.select(vec_id, embedding), queries.select(query_id, embedding)
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(vec_id, corpus.schema[vec_id].dataType),
            T.StructField("d2", T.DoubleType()),
        ]
    )

    shipped = queries.limit(max_shipped + 1).collect()
    if not shipped:
        candidates = corpus.sparkSession.createDataFrame([], schema)
    else:
        dimensions = max(1, len(shipped[0][1] or ()))
        if len(shipped) <= min(max_shipped, MAX_SHIPPED_VALUES // dimensions):
            candidates = _scan_candidates(corpus, shipped, schema, k)
        else:
            rows = max(1, min(chunk_rows, MAX_CHUNK_VALUES // dimensions))
            candidates = _block_candidates(corpus, materialize(queries, "queries"), schema, k, rows)
    return _merge(candidates, k, query_id, vec_id)


def _scan_candidates(corpus: DataFrame, queries: list[Row], schema: T.StructType, k: int) -> DataFrame:
    """One pass over the corpus with all queries at hand in every task; nothing is shuffled."""
    query_ids = [row[0] for row in queries]
    if not all(row[1] for row in queries):
        raise ValueError("vectors must not be null or empty")
    matrix = np.array([row[1] for row in queries], dtype=np.float64)
    shipped = corpus.sparkSession.sparkContext.broadcast((query_ids, matrix))
    out = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        best = _Best(vectors, k)
        for batch in batches:
            best.add(_ids(batch.column(0)), _vectors(batch.column(1)))
        yield from best.table(pa.array(ids, out.field(0).type), out).to_batches()

    return corpus.mapInArrow(search, schema)


def _block_candidates(
    corpus: DataFrame, queries: DataFrame, schema: T.StructType, k: int, rows: int
) -> DataFrame:
    """Every block of queries meets every chunk of the corpus once, in a task of its own.

    A shuffle by their number deals them out: hashed keys would meet in some
    tasks, and merging by bytes would put many into few.
    """
    query_id, vec_id, _ = schema.names
    if all("array<float>" in dict(side.dtypes).values() for side in (queries, corpus)):
        rows *= 2  # four bytes a value, not eight
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    blocks, chunks = _grid(queries.count(), corpus.count(), rows, TASKS_PER_CORE * cores)
    block, chunk = (F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))) for cuts in (blocks, chunks))
    # New names, as queries taken from the corpus itself would share its columns.
    left = queries.select(
        F.lit(True).alias("asks"),
        F.col(query_id).alias("asked_id"),
        F.lit(None).cast(schema[vec_id].dataType).alias("met_id"),
        F.col(queries.columns[1]).alias("vector"),
        F.pmod(F.xxhash64(query_id), F.lit(blocks)).cast("int").alias("block"),
        chunk.alias("chunk"),
    )
    right = corpus.select(
        F.lit(False).alias("asks"),
        F.lit(None).cast(schema[query_id].dataType).alias("asked_id"),
        F.col(vec_id).alias("met_id"),
        F.col(corpus.columns[1]).alias("vector"),
        block.alias("block"),
        F.pmod(F.xxhash64(vec_id), F.lit(chunks)).cast("int").alias("chunk"),
    )
    number = (F.col("block") * chunks + F.col("chunk")).alias("number")
    both = left.unionByName(right).select("asks", "asked_id", "met_id", "vector", number)
    out = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for number in batch.column(4).unique().to_pylist():
                asked, met = held.setdefault(number, ([], []))
                own = pc.equal(batch.column(4), number)
                for asks, kept in ((pc.and_(own, batch.column(0)), asked), (pc.and_not(own, batch.column(0)), met)):
                    part = batch if pc.all(asks).as_py() else batch.filter(asks)
                    if part.num_rows:
                        kept.append((part.column(1 if kept is asked else 2), _vectors(part.column(3))))
        while held:
            asked, met = held.popitem()[1]
            if asked and met:
                yield from _met(asked, met, k, out).to_batches()

    return both.repartitionById(blocks * chunks, F.col("number")).mapInArrow(search, schema)


def _met(asked: list, met: list, k: int, out: pa.Schema) -> pa.Table:
    """Candidates of some queries among some rows, both as lists of ids and vectors."""
    if len({vectors.shape[1] for _, vectors in asked + met}) > 1:
        raise ValueError("vectors must be finite and of one length")
    ids = pa.concat_arrays([part for part, _ in asked])
    best = _Best(np.concatenate([vectors for _, vectors in asked]), k)
    asked.clear()
    for row_ids, vectors in met:
        best.add(_ids(row_ids), vectors)
    return best.table(ids, out)


def _grid(queries: int, corpus: int, rows: int, tasks: int) -> tuple[int, int]:
    """Blocks and chunks: as few as tasks can hold, or more to have so many tasks.

    Rather more blocks than chunks, as every chunk finds ``k`` rows for each query.
    """
    blocks, chunks = _cuts(queries, rows), _cuts(corpus, rows)
    most_blocks, most_chunks = (max(1, count // LEAST_CUT_ROWS) for count in (queries, corpus))
    while blocks * chunks < tasks and (blocks < most_blocks or chunks < most_chunks):
        if blocks < most_blocks and (blocks < 3 * chunks or chunks >= most_chunks):
            blocks += 1
        else:
            chunks += 1
    return blocks, chunks


def _cuts(count: int, rows: int) -> int:
    """Blocks or chunks of so many ids.

    Ids are dealt by hash, so cuts are planned for half of what a task may
    hold. They are as few as that allows: each block of queries costs a copy
    of the corpus in the shuffle.
    """
    return max(1, ceil(count / ceil(rows / 2)))


def _merge(candidates: DataFrame, k: int, query_id: str, vec_id: str) -> DataFrame:
    """Overall best ``k``: first within salts of a query, then among the salts' winners."""
    order = [F.asc("d2"), F.asc(vec_id)]
    rank = F.row_number()
    salt = F.pmod(F.xxhash64(vec_id), F.lit(MERGE_SALTS))
    winners = (
        candidates.withColumn("salt", salt)
        .withColumn("position", rank.over(Window.partitionBy(query_id, "salt").orderBy(*order)))
        .where(F.col("position") <= k)
    )
    return (
        winners.select(query_id, vec_id, "d2")
        .withColumn("position", rank.over(Window.partitionBy(query_id).orderBy(*order)))
        .where(F.col("position") <= k)
    )


class _Best:
    """The best ``k`` rows per query seen so far within one task."""

    def __init__(self, queries: np.ndarray, k: int):
        self.k, self.size = k, max(1, min(PART_QUERIES, len(queries)))
        self.parts = [_Part(queries[at : at + self.size], k) for at in range(0, len(queries), self.size)]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, SCORE_CELLS // self.size)
        for start in range(0, len(ids), step):
            rows = _Rows(ids[start : start + step], vectors[start : start + step], self.k)
            for part in self.parts:
                part.add(rows)

    def table(self, query_ids: pa.Array, schema: pa.Schema) -> pa.Table:
        found = [(at * self.size, part) for at, part in enumerate(self.parts) if part.ids is not None]
        if not found:
            return schema.empty_table()
        columns = [
            query_ids.take(pa.array(np.concatenate([part.query + first for first, part in found]))),
            pa.array(np.concatenate([part.ids for _, part in found]).tolist(), schema.field(1).type),
            pa.array(np.concatenate([part.d2 for _, part in found]), pa.float64()),
        ]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


class _Rows:
    """Some rows of the corpus, with what all queries need to know of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = _norms(vectors)

    @cached_property
    def rough(self) -> np.ndarray:
        return self.vectors.astype(np.float32, copy=False)

    @cached_property
    def half(self) -> np.ndarray:
        return (self.norms / 2).astype(np.float32)

    @cached_property
    def first_copies(self) -> np.ndarray:
        """Rows among the ``k`` lowest ids of their vector. Copies tie for every query, so no
        other copy can be among the best."""
        by_id = np.argsort(self.ids, kind="stable")
        whole = np.ascontiguousarray(self.vectors[by_id])
        whole = whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1])))
        _, group = np.unique(whole.ravel(), return_inverse=True)
        by_group = np.argsort(group, kind="stable")
        sorted_group = group[by_group]
        copy = np.arange(len(group)) - np.searchsorted(sorted_group, sorted_group)
        first = np.empty(len(self.ids), dtype=bool)
        first[by_id[by_group]] = copy < self.k
        return first


class _Part:
    """Queries that are scored at once, and the best rows of each."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.norms = _norms(queries)
        self.bound = np.full(len(queries), np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.d2 = np.empty(0)
        self.ids = None

    @cached_property
    def rough(self) -> np.ndarray:
        return self.queries.astype(np.float32, copy=False)

    def add(self, rows: _Rows) -> None:
        query, row = self._near(rows)
        if not len(row):
            return
        d2 = [self._distance(rows.vectors, row[part], query[part]) for part in self._slices(len(row))]
        query = np.concatenate([self.query, query])
        d2 = np.concatenate([self.d2, *d2])
        ids = rows.ids[row] if self.ids is None else np.concatenate([self.ids, rows.ids[row]])
        order = np.lexsort((ids, d2, query))
        query, d2, ids = query[order], d2[order], ids[order]
        position = np.arange(len(query)) - np.searchsorted(query, query)
        keep = position < self.k
        self.query, self.d2, self.ids = query[keep], d2[keep], ids[keep]
        full = position == self.k - 1
        self.bound[query[full]] = d2[full]

    def _near(self, rows: _Rows) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a row that may be among its best: all that are, and few others."""
        squares = self.norms.max() + rows.norms.max()
        if ROUGH_RANGE[0] < squares < ROUGH_RANGE[1]:
            query, row = self._screened(rows, self.rough, rows.rough, rows.half, ROUGH)
            if len(row) <= MANY_TIES * self.k * len(self.queries):
                return query, row
        queries, vectors = self.queries.astype(np.float64, copy=False), rows.vectors.astype(np.float64, copy=False)
        return self._screened(rows, queries, vectors, rows.norms / 2, 2.0**-52)

    def _screened(
        self, rows: _Rows, queries: np.ndarray, vectors: np.ndarray, half: np.ndarray, rounding: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The product only screens; by its precision no score is off by more than the slack.

        A score is half of what the query's square exceeds the distance by.
        """
        scores = queries @ vectors.T
        scores -= half
        slack = rounding * (queries.shape[1] + 8) * (self.norms + rows.norms.max())
        floor = (self.norms - self.bound) / 2 - slack
        near = scores >= _below(floor, scores.dtype)
        few = self.k * len(self.queries)
        if len(rows.ids) > self.k and np.count_nonzero(near) > 2 * few:
            worst = len(rows.ids) - self.k
            floor = np.maximum(floor, np.partition(scores, worst, axis=1)[:, worst] - 2 * slack)
            near = scores >= _below(floor, scores.dtype)
        query, row = np.divmod(np.flatnonzero(near), len(rows.ids))
        if len(row) > few:
            first = rows.first_copies[row]
            query, row = query[first], row[first]
        return query, row

    def _slices(self, pairs: int) -> list[slice]:
        step = max(1, SCORE_CELLS // self.queries.shape[1])
        return [slice(start, start + step) for start in range(0, pairs, step)]

    def _distance(self, vectors: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
        difference = np.subtract(vectors[row], self.queries[query], dtype=np.float64)
        return np.einsum("ij,ij->i", difference, difference)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)


def _below(floor: np.ndarray, kind: np.dtype) -> np.ndarray:
    """A column of the next lower numbers of that kind."""
    return np.nextafter(floor.astype(kind), kind.type(-np.inf))[:, None]


def _ids(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.asarray(column.to_pylist())


def _matrix(column: pa.Array) -> np.ndarray:
    return _vectors(column).astype(np.float64, copy=False)


def _vectors(column: pa.Array) -> np.ndarray:
    """One row per vector, in the column's own precision."""
    if len(column) == 0:
        return np.empty((0, 1))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if lengths.min() == 0:
        raise ValueError("vectors must not be null or empty")
    values = column.flatten().to_numpy(zero_copy_only=False)
    if values.dtype not in (np.float32, np.float64):
        values = values.astype(np.float64)
    if lengths.min() != lengths.max() or not np.isfinite(values).all():
        raise ValueError("vectors must be finite and of one length")
    return values.reshape(len(column), -1)
