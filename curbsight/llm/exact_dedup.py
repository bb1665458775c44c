"""Exact de-duplication over a cuckoo-filter index of live digests.

Each task first combines what it has read, so a text with a third of all rows
reaches the index as one row per task. Equal digests then meet in one
partition, whose index holds a live entry per digest: a short tag in a cuckoo
filter of four-slot buckets, with the whole digest stored beside it. A tag hit
is verified against the stored digest. When a larger id of a known digest
arrives, its live entry is deleted and the new one inserted; a full table is
rebuilt at twice the size from the digests it stores.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import documents, map_rows
from curbsight.sources.storage import materialize

SLOTS = 4
MAX_KICKS = 200
COMBINE_ROWS = 50_000


class CuckooIndex:
    """Live digests with a value each; supports insertion, lookup and deletion.

    The bucket pair of a digest is ``i`` and ``i ^ spread(tag)``, so an entry
    can move to its other bucket knowing only its tag.
    """

    def __init__(self, buckets: int = 64):
        self._clear(buckets)

    def __len__(self) -> int:
        return self._live

    @property
    def buckets(self) -> int:
        return len(self._tags)

    def get(self, digest: bytes):
        at = self._find(digest)
        return None if at is None else self._stored[at[0]][at[1]][1]

    def insert(self, digest: bytes, value) -> None:
        """Add a digest that isn't live."""
        if not self._place(digest, value):
            self._grow()

    def delete(self, digest: bytes):
        """Remove a live digest and give its value back; ``KeyError`` if it isn't live."""
        at = self._find(digest)
        if at is None:
            raise KeyError(digest)
        bucket, slot = at
        self._tags[bucket].pop(slot)
        self._live -= 1
        return self._stored[bucket].pop(slot)[1]

    def items(self):
        for bucket in self._stored:
            yield from bucket

    def _clear(self, buckets: int) -> None:
        self._tags: list[list[int]] = [[] for _ in range(buckets)]
        self._stored: list[list[tuple]] = [[] for _ in range(buckets)]
        self._live = 0

    def _where(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little")
        first = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ ((tag + 1) * 0x9E3779B1 & (self.buckets - 1))

    def _find(self, digest: bytes) -> tuple[int, int] | None:
        tag, first, second = self._where(digest)
        for bucket in (first, second):
            if tag in self._tags[bucket]:
                for slot, (stored, _) in enumerate(self._stored[bucket]):
                    if stored == digest:
                        return bucket, slot
        return None

    def _place(self, digest: bytes, value) -> bool:
        """False if the last entry moved out found no room; it then stands in an overfull bucket."""
        tag, first, second = self._where(digest)
        self._live += 1
        bucket = first if len(self._tags[first]) < SLOTS else second
        entry = (digest, value)
        for kick in range(MAX_KICKS):
            if len(self._tags[bucket]) < SLOTS:
                break
            slot = kick % SLOTS
            self._tags[bucket][slot], tag = tag, self._tags[bucket][slot]
            self._stored[bucket][slot], entry = entry, self._stored[bucket][slot]
            bucket = self._other(bucket, tag)
        self._tags[bucket].append(tag)
        self._stored[bucket].append(entry)
        return len(self._tags[bucket]) <= SLOTS

    def _grow(self) -> None:
        """Rebuild from the stored digests, doubling until all find room."""
        entries = list(self.items())
        buckets = self.buckets
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(*entry) for entry in entries):
                return


def digests(df: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of each text with A-Z, and only those, in lower case."""

    def start():
        def run(rows):
            for doc_id, text in rows:
                yield doc_id, hashlib.sha256(text.encode().lower()).digest()  # bytes.lower() knows ASCII only

        return run

    return map_rows(df, start, "doc_id long, digest binary", [("doc_id", pa.int64()), ("digest", pa.binary())])


def keepers(digested: DataFrame) -> DataFrame:
    """Per digest the row that stays: ``digest``, ``keep_id``, ``group_size``."""
    fields = [("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())]
    schema = "digest binary, keep_id long, group_size long"

    def combining():
        def run(rows):
            seen: dict[bytes, tuple] = {}
            for doc_id, digest in rows:
                keep, size = seen.get(digest, (doc_id, 0))
                seen[digest] = (_larger(keep, doc_id), size + 1)
                if len(seen) >= COMBINE_ROWS:
                    yield from ((d, *v) for d, v in seen.items())
                    seen = {}
            yield from ((d, *v) for d, v in seen.items())

        return run

    def indexing():
        def run(rows):
            index = CuckooIndex()
            for digest, keep_id, size in rows:
                live = index.get(digest)
                if live is not None:
                    index.delete(digest)
                    keep_id, size = _larger(live[0], keep_id), live[1] + size
                index.insert(digest, (keep_id, size))
            yield from ((d, *v) for d, v in index.items())

        return run

    combined = map_rows(digested.select("doc_id", "digest"), combining, schema, fields)
    return map_rows(combined.repartition("digest"), indexing, schema, fields)


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null text counts as empty, a null id as smaller than any other. Rows that
    repeat an id with the same text count in ``group_size`` and are kept or
    dropped together. An empty table gives an empty result. Other columns,
    whatever their names, play no part. Texts are hashed whole.
    """
    digested = materialize(digests(documents(df, id_col, text_col)), "digests")
    return digested.join(keepers(digested), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
