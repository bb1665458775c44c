"""Exact top-k by inner product: columnar branch and bound.

Vectors lie in chunks by dimension, so the products of a block of dimensions
are one small matrix product over whole columns. After each block a candidate
whose sum so far, plus the most that the remaining mass of both vectors allows
(the product of their remaining norms), stays under the k-th best score is
out for that query; chunks are compacted to candidates that some query of the
block still needs. The first bound of a query comes from a bounded sample of
real candidates.

Chunks are dealt into groups of bounded size. Query blocks are copied to every
group and stream past its chunks, which are all that a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbsight.sources.storage import materialize

CHUNK = 4096
GROUP_CHUNKS = 8
QUERY_BLOCK = 256
DIMENSIONS = 16
SEEDS = 2048
#: Products and their sums are exact in a double below this.
EXACT = float(1 << 53)
LARGEST = (1 << 63) - 1
CHUNK_SCHEMA = "dim int, n int, ids binary, columns binary"


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, floor(64 x) of each component; without vectors that are null, empty or hold null or non-finite components."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & whole)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * 64.0)).alias("v"))


def chunked(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors of one length in vertical layout: ``ids`` and, dimension by dimension, ``columns``, as 64-bit integers."""

    def run(batches):
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                ids, vs = waiting.setdefault(len(v), ([], []))
                ids.append(vec_id)
                vs.append(v)
                if len(ids) == rows:
                    yield to_row(*waiting.pop(len(v)))
        for ids, vs in waiting.values():
            yield to_row(ids, vs)

    def to_row(ids: list[int], vs: list[list[int]]) -> pa.RecordBatch:
        columns = np.ascontiguousarray(np.array(vs, np.int64).T)
        return pa.RecordBatch.from_arrays(
            [pa.array([len(columns)], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()]), pa.array([columns.tobytes()])],
            ["dim", "n", "ids", "columns"],
        )

    return vectors.mapInArrow(run, CHUNK_SCHEMA)


class Chunk:
    """Vectors in vertical layout, with the norm that remains after each block of dimensions."""

    def __init__(self, dim: int, n: int, ids: bytes, columns: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = np.frombuffer(columns, np.int64).reshape(dim, n)
        self.x = self.exact.astype(float)
        squares = np.cumsum((self.x * self.x)[::-1], axis=0)[::-1]
        # A little more than the norms, so that rounding never loses a candidate.
        self.remaining = [np.sqrt(squares[at]) * (1 + 1e-9) for at in range(0, dim, DIMENSIONS)] + [np.zeros(n)]
        self.largest = np.abs(self.x).max(initial=0)


def scores(queries: Chunk, candidates: Chunk, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the candidates (indexes, scores) that reach its ``least``; its own row is no candidate."""
    dim = len(queries.x)
    if queries.largest * candidates.largest * dim >= EXACT:
        for q, own in enumerate(queries.ids):
            products = queries.exact[:, q].astype(object) @ candidates.exact.astype(object)
            found = np.clip(products, -LARGEST, LARGEST).astype(np.int64)
            at = np.flatnonzero((found >= least[q]) & (candidates.ids != own))
            yield at, found[at]
        return
    alive = np.arange(len(candidates.ids))
    columns = candidates.x
    partial = np.zeros((len(queries.ids), len(alive)))
    for block, at in enumerate(range(0, dim, DIMENSIONS)):
        partial += queries.x[at : at + DIMENSIONS].T @ columns[at : at + DIMENSIONS]
        most = np.multiply.outer(queries.remaining[block + 1], candidates.remaining[block + 1][alive])
        most += partial
        needed = (most >= least[:, None]).any(axis=0)
        if needed.mean() < 0.75:
            alive, partial, columns = alive[needed], partial[:, needed], columns[:, needed]
    for q, own in enumerate(queries.ids):
        at = np.flatnonzero((partial[q] >= least[q]) & (candidates.ids[alive] != own))
        yield alive[at], partial[q, at].astype(np.int64)


class Best:
    """The k best of each query so far: highest score first, then smallest id."""

    def __init__(self, queries: Chunk, k: int, least: np.ndarray):
        self.queries, self.k, self.least = queries, k, least.copy()
        empty = np.zeros(0, np.int64)
        self.rows = [(empty, empty)] * len(queries.ids)

    def meet(self, candidates: Chunk) -> None:
        for q, (at, found) in enumerate(scores(self.queries, candidates, self.least)):
            if not len(at):
                continue
            ids, values = self.rows[q]
            ids, values = np.concatenate([ids, candidates.ids[at]]), np.concatenate([values, found])
            if len(ids) > self.k:
                best = np.lexsort((ids, -values))[: self.k]
                ids, values = ids[best], values[best]
            self.rows[q] = ids, values
            if len(ids) == self.k:
                self.least[q] = max(self.least[q], values.min())


def search(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of ``corpus`` for each row of ``queries``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both hold ``vec_id`` and ``v``, integers. Only vectors of a query's own
    length meet it; a row of the query's id is no candidate. Ties go to the
    smaller id; fewer rows come out where there are fewer candidates. Rows
    that repeat an id are candidates (or queries) each of their own, but for
    ``rank`` a query of a repeated id counts once. Empty tables give no rows.
    """
    seeds = corpus.orderBy(F.xxhash64("vec_id")).limit(SEEDS)
    sample = _sample_chunks(seeds.collect())  # a fixed number of rows
    chunks = materialize(chunked(corpus, CHUNK), "chunks")
    blocks = materialize(chunked(queries.dropDuplicates(["vec_id"]), QUERY_BLOCK), "query-blocks")
    groups = max(1, -(-chunks.count() // GROUP_CHUNKS))
    dealt = chunks.withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups))).withColumn("is_query", F.lit(False))
    copied = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("is_query", F.lit(True))
    # Within a task a group's chunks come first, then the query blocks that pass them.
    met = dealt.unionByName(copied.withColumn("group", F.col("group").cast("long"))).repartition("group").sortWithinPartitions("group", "is_query")

    def run(batches):
        group, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                dim, n, ids, columns, number, is_query = (c[at].as_py() for c in batch.columns)
                if number != group:
                    group, held = number, []
                chunk = Chunk(dim, n, ids, columns)
                if not is_query:
                    held.append(chunk)
                    continue
                first = Best(chunk, k, np.full(n, -np.inf))
                for candidates in sample:
                    if len(candidates.x) == dim:
                        first.meet(candidates)
                best = Best(chunk, k, first.least)
                for candidates in held:
                    if len(candidates.x) == dim:
                        best.meet(candidates)
                counts = [len(ids) for ids, _ in best.rows]
                arrays = [np.repeat(chunk.ids, counts), *(np.concatenate(x) for x in zip(*best.rows))]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["query_id", "vec_id", "score"])

    found = met.select(*CHUNK_COLUMNS, "group", "is_query").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


CHUNK_COLUMNS = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]


def _sample_chunks(rows: list) -> list[Chunk]:
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["v"]), []).append(row)
    return [
        Chunk(dim, len(own), np.array([r["vec_id"] for r in own], np.int64).tobytes(), np.ascontiguousarray(np.array([r["v"] for r in own], np.int64).T).tobytes())
        for dim, own in by_length.items()
    ]
