"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from weakref import WeakSet

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Rows = Iterable[tuple]


def importable(spark: SparkSession) -> None:
    """Have Python workers find this package where the driver has it, if nothing else was set.

    That serves local sessions started in any folder; a cluster gets the
    package by ``--py-files`` or an installed copy, which come first.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` and ``text``; null text counts as empty, other columns stay behind."""
    importable(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))


def map_rows(df: DataFrame, start: Callable[[], Callable[[Iterator[tuple]], Rows]], schema: str, fields: list[tuple[str, pa.DataType]], rows_per_batch: int = 4096, memory: str = "") -> DataFrame:
    """A generator over the rows of a partition, moved in Arrow batches.

    ``start`` runs once in each task and gives the generator. Rows are taken
    from the batches one by one and go out in batches of bounded length, so a
    task holds one batch in and one out. ``memory`` is the kind of memos that
    the tasks use; a worker forgets all others.
    """
    arrow = pa.schema(fields)

    def run(batches):
        Memo.forget_but(memory)

        def rows():
            for batch in batches:
                columns = batch.columns
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*(c.slice(at, 256).to_pylist() for c in columns))

        out: list[tuple] = []
        for row in start()(rows()):
            out.append(row)
            if len(out) >= rows_per_batch:
                yield to_batch(out, arrow)
                out = []
        if out:
            yield to_batch(out, arrow)

    return df.mapInArrow(run, schema)


def to_batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


class Memo:
    """What ``compute`` gives for keys, remembered in ``known`` within a budget of bytes.

    Kept per worker process, so tasks that run there later find it filled.
    Only speed depends on it: when it is full, it forgets what was asked for
    just once since the last time, or all but what is asked for just then if
    that isn't enough.
    """

    #: What a key and its value take beside their contents.
    ENTRY = 200

    _made: WeakSet[Memo] = WeakSet()

    def __init__(self, compute: Callable[[list[str]], Iterable[bytes]], budget: int, kind: str = ""):
        self.known: dict[str, bytes] = {}
        self._kind = kind
        self._made.add(self)
        self._again: set[str] = set()
        self._compute, self._budget, self._size = compute, budget, 0

    def learn(self, lists: list[list[str]]) -> None:
        """Have all keys of these lists in ``known``."""
        asked = set().union(*lists)
        new = asked.difference(self.known)
        coming = self._weight(new) * 2  # values are about as long as their keys
        if self._size + coming > self._budget:
            kept = self._again | (asked - new)
            if self._weight(kept) * 2 + coming > self._budget:
                kept = asked - new
            self.known = {k: self.known[k] for k in kept}
            self._again = set()
            self._size = sum(map(len, self.known.values())) + self._weight(kept)
        else:
            self._again |= asked - new
        if new:
            own = dict(zip(keys := list(new), self._compute(keys)))
            self._size += self._weight(new) + sum(map(len, own.values()))
            self.known.update(own)

    @staticmethod
    def forget_but(kind: str) -> None:
        """Empty the memos of other kinds that earlier tasks have filled in this worker."""
        for memo in [*Memo._made, *Remembered.made]:
            if memo._kind != kind:
                memo.forget()

    def forget(self) -> None:
        self.known, self._again, self._size = {}, set(), 0

    def _weight(self, keys: set[str]) -> int:
        return sum(map(len, keys)) + self.ENTRY * len(keys)

    def joined(self, lists: list[list[str]]) -> list[bytes]:
        """Per list, what is known of its keys, one after the other."""
        self.learn(lists)
        return [b"".join(map(self.known.__getitem__, own)) for own in lists]


class Remembered(dict):
    """What ``compute`` gives for a key, computed when it is asked for first, within a budget of bytes.

    Like :class:`Memo`, for what is computed key by key: known keys cost one
    lookup each. When half of the budget is full, all that is known grows old;
    what is asked for again stays, the rest goes when that happens next.
    """

    made: list[Remembered] = []

    def __init__(self, compute: Callable[[str], bytes], budget: int, kind: str = ""):
        super().__init__()
        self._compute, self._half, self._kind = compute, budget // 2, kind
        self._old: dict[str, bytes] = {}
        self._size = 0
        self.made.append(self)

    def __missing__(self, key: str) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        self._size += len(key) + len(value) + Memo.ENTRY
        if self._size > self._half:
            self._old = dict(self)
            self.clear()
            self._size = len(key) + len(value) + Memo.ENTRY
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self._old, self._size = {}, 0

    def joined(self, keys: list[str]) -> bytes:
        """What is known of the keys, one after the other."""
        return b"".join(map(self.__getitem__, keys))


def blocks(rows: Iterable[tuple], chars: int) -> Iterator[list[tuple[int, str]]]:
    """Rows ``(id, text)`` in lists of about so many characters, one row at least."""
    block, size = [], 0
    for row in rows:
        block.append(row)
        size += len(row[1]) + 64
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block
