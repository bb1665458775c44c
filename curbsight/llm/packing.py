"""Best-fit packing of documents into sequences by bin completion.

Documents are tokenised and cut into pieces no longer than a sequence. Whole
sequences need no packing; the rest is dealt into groups of bounded size by
hash, each packed by itself, so that a group fits in any task.

Within a group a bin starts with the longest piece left. Branch and bound
looks for what completes it: fillings that cannot take a further piece, in
order of waste, where one that leaves no waste dominates all others. The
best-fit packing is the incumbent. If the first completion sequence needs more
bins than the sum of lengths demands, other fillings are tried, and a branch
is pruned as soon as its waste exceeds what a better packing could afford.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.bpe import SPACE, byte_letters
from curbsight.llm.common import Remembered, blocks, documents, map_rows
from curbsight.sources.storage import materialize

SEQUENCE = 2048
GROUP_PIECES = 8192
#: Bytes of known runs and words that a worker remembers.
MEMORY = 240_000_000
TOKENS = "tokens"
#: Fixed value: the words of the vocabulary, in lower case.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
BLOCK_CHARS = 4_000_000
BRANCHES = 400
FILLINGS = 4
TRIES = 300
PIECE_FIELDS = [
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("deal", pa.int64()), ("row", pa.int64()),
]
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long, row long"


class WordTokenizer:
    """Ids of texts by a vocabulary whose words never hold white space.

    Such a vocabulary gives a text the ids of its runs of non-white space, one
    after the other, so each distinct run is coded once. A run of Latin-1
    letters needs no normalising but lower case; its words, which are runs
    themselves, go to the library's model directly, each distinct one once.
    Any other run, and one that may hold a special token, goes through the
    library as it is.
    """

    _made: dict[str, WordTokenizer] = {}

    @classmethod
    def of(cls, model: str) -> WordTokenizer:
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the machine already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(model)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        self._letters = {b: ord(c) for b, c in byte_letters().items()}
        self.size = self._tokenizer.get_vocab_size()
        self._as_bytes = [n.to_bytes(4, "little") for n in range(self.size)]
        self._words = regex.compile(WORDS)
        self._known = Remembered(self._encode_run, MEMORY, TOKENS)  # a word is a run, too
        # str.split() also parts at these four, which Unicode doesn't count as white space
        self._separators = re.compile("[\x1c-\x1f]")
        self._white = re.compile(f"[{SPACE}]+")

    def encode(self, texts: list[str]) -> list[bytes]:
        runs = (t.split() if not self._separators.search(t) else [r for r in self._white.split(t) if r] for t in texts)
        return list(map(self._known.joined, runs))

    def _encode_run(self, run: str) -> bytes:
        if not self._is_plain(run):
            return self._by_library(run)
        lower = run.lower()
        if lower.isalpha():
            return self._encode_word(run) if lower == run else self._known[lower]
        if lower[:-1].isalpha():  # with one mark or figure at its end
            return self._known[lower[:-1]] + self._known[lower[-1]]
        words = self._words.findall(lower)
        return self._encode_word(run) if words == [run] else self._known.joined(words)

    def _encode_word(self, word: str) -> bytes:
        as_bytes = self._as_bytes
        letters = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self._letters)
        return b"".join([as_bytes[t.id] for t in self._model.tokenize(letters)])

    def _by_library(self, run: str) -> bytes:
        (coded,) = self._tokenizer.encode_batch_fast([run], add_special_tokens=False)
        return np.array(coded.ids, "<u4").tobytes()

    @staticmethod
    def _is_plain(run: str) -> bool:
        if "<|" in run:
            return False
        try:
            run.isascii() or run.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True


def pieces(df: DataFrame, model: str, end_id: int = 0, capacity: int = SEQUENCE) -> DataFrame:
    """Each document's ids and then ``end_id``, cut into pieces where longer than ``capacity``.

    ``start`` counts the document's ids before the piece, ``ids_crc32`` is over
    its ids as little-endian unsigned 32-bit integers. ``deal``, by content, and
    ``row``, the number of the piece in its task, spread pieces evenly over
    groups, also those of repeated rows.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(model)  # a file of a few MB, whatever the input
    end = int(end_id).to_bytes(4, "little")

    def start():
        tokenizer = WordTokenizer.of(vocabulary.value)

        def run(rows):
            row = 0
            for block in blocks(rows, BLOCK_CHARS):
                for (doc_id, _), ids in zip(block, tokenizer.encode([text for _, text in block])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        crc = zlib.crc32(part)
                        yield doc_id, number, at // 4, len(part) // 4, crc, zlib.crc32(f"{doc_id} {number} {crc}".encode()), row
                        row += 1

        return run

    return map_rows(documents(df), start, PIECE_SCHEMA, PIECE_FIELDS, memory=TOKENS)


class Shelf:
    """The lengths still to be packed: how many of each, and as bits of one number to test sums quickly."""

    def __init__(self, lengths, capacity: int):
        self.capacity = capacity
        self.counts = [0] * (capacity + 1)
        self.up = self.down = 0  # bit n: a piece of length n; bit capacity - n
        for n in lengths:
            self.put(n)

    def put(self, n: int) -> None:
        self.counts[n] += 1
        self.up |= 1 << n
        self.down |= 1 << (self.capacity - n)

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            self.up ^= 1 << n
            self.down ^= 1 << (self.capacity - n)

    def longest(self, room: int) -> int:
        """The longest length that fits; 0 if none."""
        return (self.up & ((1 << (room + 1)) - 1)).bit_length() - 1 if room > 0 and self.up & ((1 << (room + 1)) - 1) else 0

    def exact(self, room: int) -> tuple[int, ...] | None:
        """One or two pieces that fill the room."""
        if self.up >> room & 1:
            return (room,)
        halves = self.up & (self.down >> (self.capacity - room)) & ((1 << room) - 1)
        if room % 2 == 0 and self.counts[room // 2] == 1:
            halves &= ~(1 << room // 2)
        if halves:
            long = halves.bit_length() - 1
            return (long, room - long)
        return None


def fillings(shelf: Shelf, room: int, waste: int) -> list[tuple[int, ...]]:
    """Up to FILLINGS undominated fillings that leave at most ``waste``, least waste first; none if all leave more.

    A filling is dominated if a further piece fits, or if it is matched by one
    without waste. The longest-first (best-fit) filling comes first and is
    always known; the search for others visits at most BRANCHES nodes.
    """
    longest_first, rest = [], room
    while n := shelf.longest(rest):
        shelf.take(n)
        longest_first.append(n)
        rest -= n
    for n in longest_first:
        shelf.put(n)
    found: dict[tuple[int, ...], int] = {tuple(longest_first): rest}
    left = BRANCHES

    def search(room: int, below: int, taken: tuple[int, ...]) -> bool:
        nonlocal left
        left -= 1
        if room == 0:
            found[taken] = 0
            return True
        whole = shelf.exact(room)
        if whole is not None and all(n <= below for n in whole):
            found[taken + whole] = 0
            return True
        n = shelf.longest(min(room, below))
        if not n:
            if not shelf.longest(room):
                found.setdefault(taken, room)
            return False
        while n and left > 0:
            shelf.take(n)
            done = search(room - n, n, (*taken, n))
            shelf.put(n)
            if done:
                return True
            if n * 2 < min(found.values()):  # what is shorter leaves more waste than is found
                break
            n = shelf.longest(min(room, n - 1))
        return False

    if rest:
        search(room, room, ())
    ranked = sorted((rest, taken) for taken, rest in found.items())
    return [taken for rest, taken in ranked if rest <= waste][:FILLINGS]


def fewest_bins(lengths: list[int], capacity: int) -> int:
    """A lower bound on the number of bins.

    For any size ``k`` up to half a bin, pieces over half a bin have one each,
    and what is not under ``k`` only fits beside those that leave ``k`` or more.
    """
    counts = np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    small = np.arange(1, half + 1)
    middle = total[half] - total[small - 1]
    roomy = number[capacity - small] - number[half]
    free = roomy * capacity - (total[capacity - small] - total[half])
    further = -(-np.maximum(middle - free, 0) // capacity)
    return int((number[capacity] - number[half] + further).max(initial=-(-total[capacity] // capacity)))


def complete(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Bins of lengths, as few as the search finds; each bin starts with its longest piece.

    Never more bins than best fit needs. The search ends when the lower bound
    is reached or after TRIES steps more than best fit has bins.
    """
    incumbent = best_fit(lengths, capacity)
    total, least = sum(lengths), fewest_bins(lengths, capacity)
    tries = TRIES + len(incumbent)
    shelf = Shelf(lengths, capacity)
    chosen: list[tuple[int, ...]] = []
    options: list[list[tuple[int, ...]]] = []  # untried completions of each chosen bin, and of the next one
    waste = 0

    def move(filling: tuple[int, ...], step: Callable[[int], None], sign: int) -> None:
        nonlocal waste
        for n in filling:
            step(n)
        waste += sign * (capacity - sum(filling))

    while len(incumbent) > least and tries > 0:
        tries -= 1
        if shelf.up:
            first = shelf.longest(capacity)
            shelf.take(first)
            found = fillings(shelf, capacity - first, (len(incumbent) - 1) * capacity - total - waste)
            shelf.put(first)
            options.append([(first, *rest) for rest in reversed(found)])
        else:  # all is packed, with less waste than the incumbent has
            incumbent = list(chosen)
            move(chosen.pop(), shelf.put, -1)
        allowed = (len(incumbent) - 1) * capacity - total
        while options:
            if options[-1] and waste + capacity - sum(options[-1][-1]) <= allowed:
                chosen.append(options[-1].pop())
                move(chosen[-1], shelf.take, 1)
                break
            options.pop()
            if chosen:
                move(chosen.pop(), shelf.put, -1)
        else:
            break
    return incumbent


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Longest first, each into the fullest bin that has room."""
    by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    for n in sorted(lengths, reverse=True):
        fits = open_rooms >> n
        room = n + (fits & -fits).bit_length() - 1 if fits else capacity
        if fits:
            own = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            own = []
        own.append(n)
        by_room[room - n].append(own)
        open_rooms |= 1 << (room - n)
        if room == n:
            open_rooms &= ~1  # full bins take nothing
    return [tuple(b) for bins in by_room for b in bins]


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length the number of its bin and its offset there."""
    waiting: dict[int, list[int]] = {}
    for at, n in enumerate(lengths.tolist()):
        waiting.setdefault(n, []).append(at)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, own in enumerate(complete(lengths.tolist(), capacity)):
        offset = 0
        for n in own:
            at = waiting[n].pop()
            bins[at], offsets[at] = number, offset
            offset += n
    return bins, offsets


def pack(df: DataFrame, model: str, end_id: int = 0, capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Null and empty texts hold only ``end_id``. A repeated row is packed again,
    under the same id. An empty table gives no pieces. Columns other than
    ``doc_id`` and ``text`` play no part.
    """
    cut = materialize(pieces(df, model, end_id, capacity), "pieces")
    part = cut.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // GROUP_PIECES))

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "deal", "doc_id", "piece"], kind="stable")  # any order of arrival packs alike
        bins, offsets = place(frame["length"].to_numpy(), capacity)
        group = frame["packing"].iloc[0]
        return frame.assign(sequence_id=2 * (bins * groups + group) + 1, offset=offsets).drop(columns=["packing", "deal", "row"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = part.withColumn("packing", F.pmod(F.xxhash64("deal", "row"), F.lit(groups))).groupBy("packing").applyInPandas(pack_group, schema)
    # A whole sequence is a bin of its own; even numbers keep apart from the packed ones.
    whole = cut.where(F.col("length") == capacity).select(
        *columns, (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return whole.unionByName(packed)
