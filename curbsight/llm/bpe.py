"""Byte-level BPE by a pair occurrence index.

A vocabulary's merges are applied to all distinct words of a batch at once.
The words' bytes lie one after the other in a single linked array; an index
maps each mergeable pair, named by its rank, to all positions where it occurs.
Ranks that occur are taken in ascending order: every occurrence is merged in
one vectorised step, and the neighbours that the merge has made go into the
position lists of their ranks, which are always higher. What is left when no
rank is active are the tokens.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from curbsight.llm.common import Memo, blocks, documents, map_rows

#: Bytes of known words that a worker remembers.
MEMORY = 90_000_000
BLOCK_CHARS = 4_000_000
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: how byte-level vocabularies split text before merging.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NONE = -1


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class PairIndex:
    """The merges of a vocabulary, applied to many words together."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]):
        letters = byte_letters()
        self._of_byte = np.array([vocabulary[letters[b]] for b in range(256)], np.int64)
        self._size = max(vocabulary.values()) + 1
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges)))
        self._left, self._right, self._made = left, right, made
        keys = left * self._size + right
        self._rank_of = np.argsort(keys, kind="stable")
        self._keys = keys[self._rank_of]

    def encode(self, pieces: list[list[str]]) -> list[bytes]:
        """The ids of each piece, a list of words, as little-endian unsigned 32-bit integers."""
        words = [w.encode() for own in pieces for w in own]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        ids = self._of_byte[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, len(ids) + 1)
        before = np.arange(-1, len(ids) - 1)
        full = lengths > 0
        after[ends[full] - 1] = NONE
        before[(ends - lengths)[full]] = NONE
        self._merge(ids, after, before)
        left = ids >= 0
        tokens = ids[left].astype("<u4").tobytes()
        at = 4 * np.concatenate([[0], np.cumsum(left)])
        last_words = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        bounds = at[np.concatenate([[0], ends])[np.concatenate([[0], last_words])]].tolist()
        return [tokens[a:b] for a, b in zip(bounds, bounds[1:])]

    def _merge(self, ids: np.ndarray, after: np.ndarray, before: np.ndarray) -> None:
        occurs: dict[int, list[np.ndarray]] = defaultdict(list)
        active: list[int] = []
        fresh = np.zeros(len(ids), bool)

        def note(at: np.ndarray) -> None:
            """Put positions whose pair can merge into the list of its rank."""
            keys = ids[at] * self._size + ids[after[at]]
            found = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            known = self._keys[found] == keys
            ranks, at = self._rank_of[found[known]], at[known]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            starts = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
            for rank, positions in zip(ranks[starts].tolist(), np.split(at, starts[1:])):
                if rank not in occurs:
                    heapq.heappush(active, rank)
                occurs[rank].append(positions)

        note(np.flatnonzero(after != NONE))
        while active:
            rank = heapq.heappop(active)
            lists = occurs.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self._left[rank], self._right[rank]
            at = at[(ids[at] == a) & (after[at] != NONE)]
            at = at[ids[after[at]] == b]
            if a == b:
                at = self._every_other(np.sort(at), after)
            if not len(at):
                continue
            gone = after[at]
            ids[at], ids[gone] = self._made[rank], NONE
            after[at] = after[gone]
            inner = at[after[at] != NONE]
            before[after[inner]] = inner
            outer = before[at]
            fresh[at] = True
            outer = outer[(outer != NONE) & ~fresh[outer]]
            fresh[at] = False
            note(np.concatenate([inner, outer]))

    @staticmethod
    def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of occurrences that overlap in a chain (a a a), the first, third and so on."""
        if len(at) < 2:
            return at
        number = np.arange(len(at))
        chained = np.concatenate([[False], after[at[:-1]] == at[1:]])
        first = np.maximum.accumulate(np.where(chained, 0, number))
        return at[(number - first) % 2 == 0]


class ByteBpe:
    """Encodes and decodes like the vocabulary file (as JSON text) says."""

    _made: dict[str, ByteBpe] = {}

    @classmethod
    def of(cls, model: str) -> ByteBpe:
        """The one for this file, made once per process."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        spec = json.loads(model)
        vocabulary = spec["model"]["vocab"]
        self._special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        longest_first = sorted(self._special, key=len, reverse=True)
        self._split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self._split, self._odd_space = regex.compile(SPLIT), re.compile(r"\s ")
        self._index = PairIndex(vocabulary, (tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]))
        byte_of = {c: b for b, c in byte_letters().items()}
        self._bytes = {i: bytes(map(byte_of.__getitem__, token)) for token, i in vocabulary.items()}
        self._bytes |= {i: token.encode() for token, i in self._special.items()}
        self._memo = Memo(self._encode_pieces, MEMORY, "bytes")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        return self._memo.joined([self._pieces(t) for t in texts])

    def decode(self, ids: bytes) -> str:
        """Special tokens stay; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")

    def _pieces(self, text: str) -> list[str]:
        """The text cut where no word of the split pattern can cross.

        A space after a non-space begins a new word, so a text without longer
        runs of white space that hold a space at their end is cut at spaces.
        """
        if self._split_special and any(s in text for s in self._special):
            return [p for i, part in enumerate(self._split_special.split(text)) for p in ([part] if i % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if self._odd_space.search(text):
            return self._split.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def _encode_pieces(self, pieces: list[str]) -> Iterable[bytes]:
        ids = self._index.encode([[] if p in self._special else self._split.findall(p) for p in pieces])
        return [self._special[p].to_bytes(4, "little") if p in self._special else own for p, own in zip(pieces, ids)]


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit integers) and ``n_tokens``.

    ``model`` is the content of a byte-level vocabulary file. Whole texts are
    encoded; null and empty texts have no ids. Special tokens written out in a
    text are read as such. One row per row, repeated ones too, ids as they
    are, null included; other columns play no part.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(model)  # a file of a few MB, whatever the input

    def start():
        bpe = ByteBpe.of(vocabulary.value)

        def run(rows):
            for block in blocks(rows, BLOCK_CHARS):
                for (doc_id, _), ids in zip(block, bpe.encode([text for _, text in block])):
                    yield doc_id, ids, len(ids) // 4

        return run

    fields = [("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64())]
    return map_rows(documents(df, id_col, text_col), start, "doc_id long, ids binary, n_tokens long", fields, 256, "bytes")


def decode(df: DataFrame, model: str) -> DataFrame:
    """``encode``'s rows with their ``text``; null ids give an empty text."""
    vocabulary = df.sparkSession.sparkContext.broadcast(model)

    def start():
        bpe = ByteBpe.of(vocabulary.value)

        def run(rows):
            for doc_id, ids, n_tokens in rows:
                yield doc_id, ids, n_tokens, bpe.decode(ids or b"")

        return run

    fields = [("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("text", pa.string())]
    return map_rows(df.select("doc_id", "ids", "n_tokens"), start, "doc_id long, ids binary, n_tokens long, text string", fields, 256, "bytes")
