"""Vector codes: product quantisation with LAESA pivots.

Vectors of whole numbers are cut into parts, each with a codebook of its own,
refined by rounds of assignment and means. For each part position a few
entries of the first codebook, far from each other, are pivots that stay
fixed. The distances of every part to its pivots are computed once and stored
beside the vectors. In a round only the distances from pivots to entries are
new; by the triangle inequality the difference of the two distances is a lower
bound on that of part and entry. A part meets entries in order of their
bounds, each by an exact evaluation in whole numbers, until the next bound
exceeds the best distance found.

Rounds read the stored vectors; per task and entry only counts and sums are
shuffled, and the driver holds just the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import importable, to_batch
from curbsight.llm.vectors import BLOCK_ROWS, blocks, finite, scaled
from curbsight.sources.storage import materialize

SCALE = 4096.0
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
#: Squared distances of parts fit 64 bits while whole numbers are no larger than this.
NARROW = 1 << 27
#: Bounds give way by this much, so that rounding never prunes an entry that is as near.
SLACK = 1e-9
LONGEST = (1 << 63) - 1

#: Codebooks by part position: entries by components, whole numbers. Pivots alike.
Books = list[np.ndarray]


def narrow(x: np.ndarray) -> np.ndarray:
    """``x`` itself, or as Python integers where squares could exceed 64 bits."""
    return x if int(np.abs(x).max(initial=0)) <= NARROW else x.astype(object)


def parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows cut into equal parts (row, part, component); zeros fill the last ones of a length that isn't divisible."""
    width = -(-x.shape[1] // parts)
    padded = np.zeros((len(x), parts * width), np.int64)
    padded[:, : x.shape[1]] = x
    return padded.reshape(len(x), parts, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    both = narrow(np.concatenate([a.ravel(), b.ravel()]))
    difference = a.astype(both.dtype) - b.astype(both.dtype)
    return (difference * difference).sum(axis=-1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to points, as doubles."""
    return np.sqrt(squared(x[:, None], points[None]).astype(float))


def pivots_among(entries: np.ndarray, number: int = PIVOTS) -> np.ndarray:
    """The first entry, and then ever the one that is farthest from those taken."""
    taken = [0]
    nearest = squared(entries, entries[:1])
    while len(taken) < min(number, len(entries)) and nearest.max() > 0:
        taken.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, squared(entries, entries[taken[-1] :][:1]))
    return entries[taken]


def assign(x: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the nearest entry (the first of several), its squared distance, and how many entries were evaluated."""
    between = distances(pivots, entries)
    bounds = np.abs(to_pivots[:, :, None] - between[None]).max(axis=1)
    scale = to_pivots.max(axis=1, initial=0.0)[:, None] + between.max(initial=0.0)
    bounds = np.maximum(bounds - SLACK * (scale + 1), 0.0)
    order = np.argsort(bounds, axis=1, kind="stable")
    ordered = np.take_along_axis(bounds, order, axis=1)
    nearest = order[:, 0].copy()
    best = squared(x, entries[nearest])
    evaluated = np.ones(len(x), np.int64)
    for step in range(1, len(entries)):
        left = np.flatnonzero(ordered[:, step] ** 2 * (1 - SLACK) <= best.astype(float))
        if not len(left):
            break
        tried = order[left, step]
        found = squared(x[left], entries[tried])
        evaluated[left] += 1
        better = ((found < best[left]) | ((found == best[left]) & (tried < nearest[left]))).astype(bool)
        nearest[left[better]], best[left[better]] = tried[better], found[better]
    return nearest, best, evaluated


def first_entries(vectors: DataFrame, number: int, parts: int) -> Books:
    """Codebooks of the vectors of smallest id, null ids first; of equal ids the smaller vector goes first."""
    rows = vectors.orderBy("vec_id", "x").limit(number).select("x").toArrow()  # as many rows as entries
    x = parts_of(scaled(rows.column("x").combine_chunks(), SCALE), parts)
    return [np.ascontiguousarray(x[:, part]) for part in range(parts)]


def with_pivots(vectors: DataFrame, pivots: Books) -> DataFrame:
    """Blocks of rows: ``n``, ``x`` (64-bit whole numbers) and ``near`` (distances to pivots), each as bytes, with lists of ids and labels."""
    parts = len(pivots)
    schema = "n int, width int, ids array<long>, labels array<string>, x binary, near binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in blocks(batches, BLOCK_ROWS):
            x = parts_of(scaled(batch.column("x"), SCALE), parts)
            near = [distances(x[:, part], pivots[part]) for part in range(parts)]
            lists = [pa.array([batch.column(c).to_pylist()], t) for c, t in (("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())))]
            stored = [pa.array([x.tobytes()]), pa.array([b"".join(d.tobytes() for d in near)])]
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.shape[2]], pa.int32()), *lists, *stored], names)

    return vectors.mapInArrow(run, schema)


def assigned(batch: pa.RecordBatch, pivots: Books, books: Books) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, ...]]]]:
    """Per stored block its place in the batch, its parts, and the assignment of each part position."""
    for at in range(batch.num_rows):
        n, width = batch.column("n")[at].as_py(), batch.column("width")[at].as_py()
        x = np.frombuffer(batch.column("x")[at].as_py(), np.int64).reshape(n, len(books), width)
        near = np.frombuffer(batch.column("near")[at].as_py())
        done, start = [], 0
        for part, own in enumerate(pivots):
            to_pivots = near[start : start + n * len(own)].reshape(n, len(own))
            start += n * len(own)
            done.append(assign(x[:, part], to_pivots, own, books[part]))
        yield at, x, done


def refined(stored: DataFrame, pivots: Books, books: Books) -> Books:
    """Each entry replaced by the floored mean of the parts that are nearest to it; one without parts stays."""
    fields = [("part", pa.int32()), ("entry", pa.int32()), ("component", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))]

    def run(batches):
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, x, done in assigned(batch, pivots, books):
                for part, (nearest, _, _) in enumerate(done):
                    for entry in np.unique(nearest).tolist():
                        own = x[nearest == entry, part]
                        at = sums.setdefault((part, entry), [0, np.zeros(own.shape[1], object)])
                        at[0] += len(own)
                        at[1] = at[1] + own.sum(axis=0)  # no block's sum of clipped components exceeds 64 bits
        rows = [(part, entry, c, n, int(t)) for (part, entry), (n, totals) in sums.items() for c, t in enumerate(totals)]
        if rows:
            yield to_batch(rows, pa.schema(fields))

    sums = stored.select("n", "width", "x", "near").mapInArrow(run, "part int, entry int, component int, n long, total decimal(38,0)")
    result = [book.copy() for book in books]
    # As many rows as the codebooks have components.
    for r in sums.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        result[r["part"]][r["entry"], r["component"]] = int(r["total"]) // r["n"]
    return result


def digest(books: Books) -> str:
    """SHA-256 of all entries' components in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def encode(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """A row per vector: ``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``, ``evaluations``.

    ``code`` has two hex digits per part, ``error`` is the sum of squared
    distances of the parts to their entries, ``label_error`` that of all
    vectors of an equal label (null labels are equal), ``evaluations`` how many
    distances the last assignment took. Vectors that are null or hold null or
    non-finite components take no part, nor do empty ones and those of another
    length than most (:func:`curbsight.llm.vectors.finite`). A length that
    parts don't divide is filled up with zeros. With fewer vectors than
    ``entries`` codebooks are as short. Errors beyond 64 bits are null.
    Repeated rows count and come out each time; null ids stay null and count as
    the smallest. Other columns play no part; an empty table gives no rows.
    """
    importable(df.sparkSession)
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string, evaluations long"
    chosen = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    vectors = materialize(finite(chosen, "vector").select("vec_id", "label", "x"), "finite-vectors")
    books = first_entries(vectors, entries, parts) if not vectors.isEmpty() else []
    if not books:
        return df.sparkSession.createDataFrame([], schema)
    pivots = [pivots_among(book) for book in books]
    stored = materialize(with_pivots(vectors, pivots), "parts-and-pivot-distances")
    for _ in range(rounds):
        books = refined(stored, pivots, books)

    def run(batches):
        for batch in batches:
            for at, _, done in assigned(batch, pivots, books):
                nearest = np.stack([d[0] for d in done], axis=1).astype(np.uint8)
                errors = [int(e) for e in sum(d[1].astype(object) for d in done)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("ids")[at].as_py(), pa.int64()),
                        pa.array(batch.column("labels")[at].as_py(), pa.string()),
                        pa.array([row.tobytes().hex() for row in nearest]),
                        pa.array(errors, pa.decimal128(38, 0)),
                        pa.array(sum(d[2] for d in done)),
                    ],
                    ["vec_id", "label", "code", "error", "evaluations"],
                )

    coded = materialize(stored.mapInArrow(run, "vec_id long, label string, code string, error decimal(38,0), evaluations long"), "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    long_or_null = lambda c: F.when(F.col(c) <= LONGEST, F.col(c).cast("long")).alias(c)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", long_or_null("error"), long_or_null("label_error"), F.lit(digest(books)).alias("codebooks_sha256"), "evaluations"
    )
