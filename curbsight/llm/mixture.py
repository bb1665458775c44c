"""Mixture-controlled packing by deficit round-robin over source queues.

Every source has a queue; the most frequent ones have their own, all others
share one. Documents are tokenised and stand in their source's queue as one
line of tokens, so packing is a matter of positions. The whole packing is split
into partitions of bounded size, each taking from every queue the tokens that
its target share entitles it to. What a queue is entitled to by the end of a
partition is a closed formula of the queues' lengths and shares, so any task
finds the partitions of its documents by itself; the fraction of a token that a
partition could not take is the deficit with which the next one begins.

Within a partition, windows are filled in turn. Each queue adds its quantum to
its deficit and gives as many tokens; a queue with less than LEAST waits. Room left
over is lent by the queues that gave, LEAST tokens each, and then goes to those
that wait, so deficits may go below zero.
Deficits go on from window to window. When a source runs out, the others keep
their proportions among each other. Tokens left at the end of a partition fill
windows of falling powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight.llm.common import blocks, importable, map_rows
from curbsight.llm.packing import BLOCK_CHARS, TOKENS, WordTokenizer
from curbsight.sources.storage import materialize

WINDOW = 4096
PARTITION_WINDOWS = 256
#: Sources with a queue of their own.
QUEUES = 64
#: A queue gives no fewer tokens at a time, unless it has no more.
LEAST = 32
#: Sequences of a partition are numbered within so many.
NUMBERS = 1 << 20


class Schedule:
    """How many tokens each queue has given by the end of each partition, for exact shares.

    At time ``t`` a queue has given ``weight * t`` tokens, or all that it has.
    """

    def __init__(self, lengths: list[int], weights: list[Fraction], partition: int):
        self.lengths, self.weights, self.partition = lengths, weights, partition
        self.total = sum(lengths)
        ends = sorted({Fraction(n) / w for n, w in zip(lengths, weights)} | {Fraction(0)})
        #: Per phase: its first time, the tokens given until then, and the weight of the queues that last longer.
        self._phases = [(t, self._given(t), sum(w for n, w in zip(lengths, weights) if Fraction(n) / w > t)) for t in ends]
        self._known: dict[int, tuple[list[int], list[Fraction]]] = {}

    def _given(self, time: Fraction) -> Fraction:
        return sum((min(Fraction(n), w * time) for n, w in zip(self.lengths, self.weights)), Fraction(0))

    def start(self, partition: int) -> tuple[list[int], list[Fraction]]:
        """Per queue the tokens that earlier partitions take, and the fraction of one that they still owe."""
        if partition not in self._known:
            tokens = min(max(partition, 0) * self.partition, self.total)
            time, given, weight = next(p for p in reversed(self._phases) if p[1] <= tokens)
            if weight:
                time += (tokens - given) / weight
            shares = [min(Fraction(n), w * time) for n, w in zip(self.lengths, self.weights)]
            if len(self._known) > 4096:
                self._known.clear()
            self._known[partition] = [int(s) for s in shares], [s - int(s) for s in shares]
        return self._known[partition]

    def of(self, queue: int, position: int, near: int | None = None) -> int:
        """The partition that takes the token at a position of a queue; ``near`` is a guess."""
        if near is None:
            near = int(self._given(Fraction(position) / self.weights[queue]) / self.partition)
        while self.start(near)[0][queue] > position:
            near -= 1
        while self.start(near + 1)[0][queue] <= position:
            near += 1
        return near


def windows(sizes: list[int], owed: list[Fraction], capacity: int, least: int = LEAST) -> Iterator[list[tuple[int, int]]]:
    """Deficit round-robin: for each window the queues and numbers of tokens, in their order.

    All tokens are given; all windows but those of the end, powers of two, have ``capacity`` tokens.
    """
    total = sum(sizes)
    left, to_go = list(sizes), total
    deficits = [int(o * total) for o in owed]  # in parts of a token, ``total`` to one
    turn = 0
    while to_go:
        room = size = capacity if to_go >= capacity else 1 << (to_go.bit_length() - 1)
        taken = [0] * len(sizes)

        def give(queue: int, tokens: int) -> None:
            nonlocal room
            tokens = min(tokens, left[queue], room)
            taken[queue] += tokens
            left[queue] -= tokens
            deficits[queue] -= tokens * total
            room -= tokens

        order, waiting = [(turn + k) % len(sizes) for k in range(len(sizes))], set()
        for queue in order:
            deficits[queue] += size * sizes[queue]
            due = deficits[queue] // total
            if due >= min(least, left[queue]):
                give(queue, due)
            else:
                waiting.add(queue)
        for queue in sorted(order, key=lambda q: -deficits[q]):
            if queue not in waiting:
                give(queue, max(0, least + deficits[queue] // total))
        for queue in sorted(waiting, key=lambda q: -deficits[q]):
            give(queue, least)
        for queue in order:
            give(queue, room)
        yield [(queue, taken[queue]) for queue in order if taken[queue]]
        to_go -= size
        turn += 1


def frequent_sources(docs: DataFrame, number: int = QUEUES) -> list[str]:
    """The sources with most documents, ``number`` of them at most; no text is read for that."""
    counted = docs.groupBy("source").count()
    return [r["source"] for r in counted.orderBy(F.desc("count"), "source").limit(number).collect()]


def queue_of(names: list[str]) -> Column:
    """The number of a source's queue; sources that aren't named have the one after the last."""
    if not names:
        return F.lit(0)
    numbers = F.create_map(*(F.lit(v) for pair in zip(names, range(len(names))) for v in pair))
    return F.coalesce(F.try_element_at(numbers, F.col("source")), F.lit(len(names)))


def lines(docs: DataFrame, names: list[str], model: str, end_id: int) -> DataFrame:
    """Tokenised documents: ``task``, ``queue``, ``before`` (tokens of this task and queue before it), ``doc_id``, ``n`` and ``ids``.

    Ids take two bytes where the vocabulary allows.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(model)  # a file of a few MB, whatever the input

    def start():
        tokenizer = WordTokenizer.of(vocabulary.value)
        end, kind = int(end_id).to_bytes(4, "little"), id_type(tokenizer, end_id)

        def run(rows):
            task, before = TaskContext.get().partitionId(), {}
            for block in blocks((((doc_id, queue), text) for doc_id, queue, text in rows), BLOCK_CHARS):
                for ((doc_id, queue), _), ids in zip(block, tokenizer.encode([text for _, text in block])):
                    ids = np.frombuffer(ids + end, "<u4")
                    at = before.get(queue, 0)
                    before[queue] = at + len(ids)
                    yield task, queue, at, doc_id, len(ids), ids.astype(kind).tobytes()

        return run

    fields = [("task", pa.int32()), ("queue", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())]
    chosen = docs.select("doc_id", queue_of(names).alias("queue"), "text")
    return map_rows(chosen, start, "task int, queue int, before long, doc_id long, n long, ids binary", fields, 512, TOKENS)


def id_type(tokenizer: WordTokenizer, end_id: int) -> str:
    return "<u2" if max(tokenizer.size, end_id + 1) <= 1 << 16 else "<u4"


def parts(tokens: DataFrame, firsts: DataFrame, schedule: Schedule) -> DataFrame:
    """Documents cut where partitions begin: ``packing``, ``queue``, ``position``, ``doc_id``, ``start``, ``doc_tokens``, ``ids``."""

    def start():
        def run(rows):
            near: dict[int, int] = {}
            for queue, position, doc_id, n, ids in rows:
                width, at = len(ids) // n, 0
                while at < n:
                    near[queue] = packing = schedule.of(queue, position + at, near.get(queue))
                    end = min(n, schedule.start(packing + 1)[0][queue] - position)
                    yield packing, queue, position + at, doc_id, at, n, ids[at * width : end * width]
                    at = end

        return run

    fields = [
        ("packing", pa.int64()), ("queue", pa.int32()), ("position", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
        ("doc_tokens", pa.int64()), ("ids", pa.binary()),
    ]
    placed = tokens.join(firsts, ["task", "queue"]).select("queue", (F.col("first") + F.col("before")).alias("position"), "doc_id", "n", "ids")
    return map_rows(placed, start, "packing long, queue int, position long, doc_id long, start long, doc_tokens long, ids binary", fields, 512)


class Line:
    """One queue's documents within a partition, taken from the front."""

    def __init__(self) -> None:
        self._docs: list[list] = []
        self._at = 0

    def append(self, doc_id: int | None, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        self._docs.append([doc_id, start, doc_tokens, ids])

    def take(self, tokens: int) -> Iterator[tuple[int | None, int, int, int, int]]:
        """Pieces: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``."""
        while tokens:
            doc = self._docs[self._at]
            doc_id, start, doc_tokens, ids = doc
            part = ids[:tokens]
            yield doc_id, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), doc_tokens
            tokens -= len(part)
            if len(part) == len(ids):
                self._docs[self._at] = None
                self._at += 1
            else:
                doc[1], doc[3] = start + len(part), ids[len(part) :]


def pack(
    df: DataFrame, model: str, end_id: int = 2, capacity: int = WINDOW, targets: dict[str | None, float] | None = None, source_col: str = "source"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``source``.

    ``targets`` are the shares of sources in every sequence, any positive
    numbers. Sources that it doesn't name go together as one, named None; it
    has the smallest share given if its own isn't. Without targets each source
    has the share of tokens that it has in all documents (the QUEUES ones of
    most documents; all others go together), and all run out at the same time.
    ``source`` names the queue a piece came from, null for the common one.

    Sequences hold ``capacity`` tokens, or a smaller power of two, so none needs
    padding. Null and empty texts hold only ``end_id``; a null source counts as
    an empty one, as do all sources if there is no such column. A repeated row
    is packed again under the same id, null ids stay null, long texts are cut.
    Columns other than these three play no part. An empty table gives no rows.
    """
    if targets is not None and (not targets or min(targets.values()) <= 0):
        raise ValueError("targets are positive shares of sources")
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("")) if source_col in df.columns else F.lit("")
    importable(df.sparkSession)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), source.alias("source"))
    names = frequent_sources(docs) if targets is None else [name for name in targets if name is not None]
    tokens = materialize(lines(docs, names, model, end_id), "token-lines")
    by_task = materialize(tokens.groupBy("queue", "task").agg(F.sum("n").alias("n")), "task-tokens")
    # A row per queue and task of the step before: short, whatever documents hold.
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_task.select("task", "queue", F.coalesce(before, F.lit(0)).alias("first"))
    lengths = [0] * (len(names) + 1)
    for r in by_task.groupBy("queue").agg(F.sum("n").alias("n")).collect():  # QUEUES + 1 rows at most
        lengths[r["queue"]] = r["n"]
    if targets is None:
        weights = [Fraction(max(n, 1)) for n in lengths]
    else:
        shares = [targets[name] for name in names] + [targets.get(None, min(targets.values()))]
        weights = [Fraction(s).limit_denominator(10**6) or Fraction(1, 10**6) for s in shares]
    schedule = Schedule(lengths, weights, PARTITION_WINDOWS * capacity)
    dealt = parts(tokens, firsts, schedule).repartition("packing").sortWithinPartitions("packing", "queue", "position")

    def start():
        def run(rows):
            for packing, group in groupby(rows, lambda r: r[0]):
                (first, owed), (end, _) = schedule.start(packing), schedule.start(packing + 1)
                sizes = [b - a for a, b in zip(first, end)]
                own = [Line() for _ in sizes]
                for _, queue, position, doc_id, at, doc_tokens, ids in group:
                    length = min(doc_tokens - at, end[queue] - position)
                    own[queue].append(doc_id, at, doc_tokens, np.frombuffer(ids, f"<u{len(ids) // length}"))
                for number, turns in enumerate(windows(sizes, owed, capacity)):
                    offset = 0
                    for queue, count in turns:
                        for piece in own[queue].take(count):
                            yield *piece, packing * NUMBERS + number, offset, names[queue] if queue < len(names) else None
                            offset += piece[2]

        return run

    fields = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("source", pa.string())]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    return map_rows(dealt, start, schema, fields)
