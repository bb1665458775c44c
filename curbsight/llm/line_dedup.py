"""Repeated passages, found by winnowing over line hashes.

Where a text breaks its lines says little about what it repeats, so texts are
read as words and lines are re-flowed: one of LINE_WORDS words begins at every
word. From each window of RUN_WORDS words the line of least hash is selected,
so any two equal runs of RUN_WORDS words have a selected line in common, at
the same place of the run: that is the guarantee of winnowing.

Selected lines are joined by their positions. A match is extended both ways as
far as the windows go that select its line; the next selected line goes on
from there. Most matches are equal as far as that, which one hash of the whole
span shows. The others are extended word by word: every window of the span is
looked up by its own hash. The first place of a run (least id, then least
position) keeps its words; the later runs go.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Memo, documents
from curbsight.sources.storage import materialize, new_location, scratch

RUN_WORDS = 50
LINE_WORDS = 12
#: Characters that are fingerprinted at once, but for longer texts.
BLOCK_CHARS = 1 << 20
BASE = 0x9E3779B97F4A7C15
_WORD = re.compile(r"\S+")


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 ... n - 1, modulo 2**64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


_KEPT = 1 << 18
_POWERS, _INVERSES = _powers(BASE, _KEPT), _powers(pow(BASE, -1, 1 << 64), _KEPT)
_BYTES = np.random.default_rng(1).integers(1 << 63, size=256, dtype=np.uint64)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``values[start:end]``, by differences of prefix sums; no span is empty."""
    n = len(values)
    powers, inverses = (_POWERS, _INVERSES) if n <= _KEPT else (_powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:n], dtype=np.uint64)])
    x = (sums[ends] - sums[starts]) * inverses[starts]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each of the words, which single blanks part."""
    if not data:
        return np.zeros(0, np.uint64)
    letters = np.frombuffer(data, np.uint8)
    blanks = np.flatnonzero(letters == 32)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(letters)]])
    result, at = [], 0
    while at < len(starts):
        # Whole words of about as many letters as there are powers, or one longer word.
        to = max(at + 1, np.searchsorted(ends, starts[at] + _KEPT, "right"))
        part = letters[starts[at] : ends[to - 1]]
        result.append(span_hashes(_BYTES[part], starts[at:to] - starts[at], ends[at:to] - starts[at]))
        at = to
    return np.concatenate(result)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the last least of ``width`` successive values, from each one on."""
    best, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        size += step
    return best


class Block:
    """The words of some texts one after the other, as hashes; case and white space don't count."""

    def __init__(self, texts: Iterable[str]):
        plain = [" ".join(text.lower().split()) for text in texts]
        self.counts = np.fromiter((p.count(" ") + 1 if p else 0 for p in plain), np.int64, len(plain))
        self.words = word_hashes(" ".join(filter(None, plain)).encode())
        self.ends = np.cumsum(self.counts)
        self.offsets = self.ends - self.counts

    def selected(self, run_words: int, line_words: int) -> tuple[np.ndarray, ...]:
        """``line``, ``span``, ``row``, ``first``, ``number`` and ``more`` of each selected line.

        The windows that select it are ``number`` successive ones, the first of
        which begins at word ``first`` of its text; the span is all their words.
        Where the same line and span follow at once, as in texts that go round
        and round, the first stands for all, and the others begin ``more`` words on at most.
        """
        n = len(self.words)
        starts = np.flatnonzero(np.arange(n) + run_words <= np.repeat(self.ends, self.counts))
        if not len(starts):
            return (np.zeros(0, np.int64),) * 6
        at = np.arange(n - line_words + 1)
        lines = span_hashes(self.words, at, at + line_words)
        chosen = least(lines, run_words - line_words + 1)[starts]
        cut = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        first, number = starts[cut], np.diff(np.append(cut, len(starts)))
        row = np.searchsorted(self.ends, first, "right")
        span = span_hashes(self.words, first, first + number + run_words - 1)
        line = lines[chosen[cut]]
        new = np.concatenate([[True], (line[1:] != line[:-1]) | (span[1:] != span[:-1]) | (row[1:] != row[:-1])])
        at = np.flatnonzero(new)
        more = np.add.reduceat(np.where(new, 0, number), at)
        return line[at].view(np.int64), span[at].view(np.int64), row[at], (first - self.offsets[row])[at], number[at], more


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about BLOCK_CHARS characters of ``text``, one row at least."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(sizes + 64) // BLOCK_CHARS
    edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
    yield from (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def selected_lines(docs: DataFrame, run_words: int, line_words: int) -> DataFrame:
    """A row per selected line: ``line``, ``span``, ``doc_id``, ``copy``, ``first``, ``number``, ``more``."""

    def run(batches):
        Memo.forget_but("")
        for part in (s for batch in batches for s in slices(batch)):
            line, span, row, *places = Block(part.column("text").to_pylist()).selected(run_words, line_words)
            ids, copies = part.column("doc_id").take(pa.array(row)), part.column("copy").take(pa.array(row))
            small = (pa.array(x.astype(np.int32)) for x in places)
            yield pa.RecordBatch.from_arrays([pa.array(line), pa.array(span), ids, copies, *small], ["line", "span", "doc_id", "copy", "first", "number", "more"])

    return docs.mapInArrow(run, "line long, span long, doc_id long, copy long, first int, number int, more int")


def windows_of(docs: DataFrame, run_words: int) -> DataFrame:
    """A row per window of the spans in ``spans``, structs of ``line``, ``first``, ``number``: ``line``, ``hash``, ``doc_id``, ``copy``, ``start``."""

    def run(batches):
        Memo.forget_but("")
        for part in (s for batch in batches for s in slices(batch)):
            block = Block(part.column("text").to_pylist())
            lists = part.column("spans")
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            line, first, number = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in lists.flatten().flatten())
            of = np.repeat(np.arange(len(row)), number)
            start = first[of] + np.arange(len(of)) - (np.cumsum(number) - number)[of]
            at = start + block.offsets[row[of]]
            hashes = span_hashes(block.words, at, at + run_words).view(np.int64) if len(at) else at
            rows = pa.array(row[of])
            columns = [pa.array(line[of]), pa.array(hashes), part.column("doc_id").take(rows), part.column("copy").take(rows), pa.array(start.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["line", "hash", "doc_id", "copy", "start"])

    return docs.mapInArrow(run, "line long, hash long, doc_id long, copy long, start int")


def same_text(left: str, right: str) -> Column:
    """Whether rows of two frames with these aliases are of one text."""
    return F.col(f"{left}.copy").eqNullSafe(F.col(f"{right}.copy")) & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))


def repeated_runs(docs: DataFrame, run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """Runs of words that also stand at an earlier place: ``doc_id``, ``copy`` and ``runs``, structs of ``start`` and ``end`` in words.

    ``docs`` has ``doc_id``, ``text`` and its hash as ``copy``, which tells the texts of a repeated or null id apart.
    Runs may overlap.
    """
    spark = docs.sparkSession
    result = new_location(spark, "repeated-runs")
    with scratch(spark):
        found = _runs(docs, run_words, line_words)
        found.write.parquet(result)
    return spark.read.schema(found.schema).parquet(result)


def _runs(docs: DataFrame, run_words: int, line_words: int) -> DataFrame:
    selected = materialize(selected_lines(docs, run_words, line_words), "selected-lines")
    end = F.col("first") + F.col("number") + F.col("more") + (run_words - 1)
    around = selected.where("more > 0").select("doc_id", "copy", (F.col("first") + F.col("number")).alias("start"), end.alias("end"))
    common = selected.groupBy("line").agg(F.count("*").alias("n"), F.min("span").alias("least"), F.max("span").alias("most"))
    common = materialize(common.where("n > 1").select("line", (F.col("least") < F.col("most")).alias("mixed")), "common-lines")
    lines = materialize(selected.join(common, "line"), "lines")
    place = F.struct("doc_id", "copy", "first")
    by_span = lines.groupBy("line", "span", "mixed").agg(F.min(place).alias("place"), F.max("number").alias("number"), F.count("*").alias("n"))
    spans = materialize(by_span, "spans")
    # Spans that are equal to the end: all but the first go as a whole.
    again = spans.where("n > 1").select("line", "span", "place")
    whole = lines.join(again, ["line", "span"]).where(place > F.col("place")).select("doc_id", "copy", F.col("first").alias("start"), end.alias("end"))
    # Lines with several spans: the first places of these are extended word by word.
    tried = spans.where("mixed").groupBy("place.doc_id", "place.copy").agg(F.collect_list(F.struct("line", "place.first", "number")).alias("spans"))
    of_text = docs.alias("d").join(tried.alias("t"), same_text("d", "t")).select("d.doc_id", "d.copy", "d.text", "t.spans")
    windows = materialize(windows_of(of_text, run_words), "windows")
    window = F.struct("doc_id", "copy", "start")
    places = windows.groupBy("line", "hash").agg(F.min(window).alias("place"), F.count("*").alias("n"))
    later = windows.join(places.where("n > 1").select("line", "hash", "place"), ["line", "hash"]).where(window > F.col("place"))
    later = later.select("doc_id", "copy", "start", (F.col("start") + run_words).alias("end"))
    return whole.unionByName(around).unionByName(later).groupBy("doc_id", "copy").agg(F.collect_set(F.struct("start", "end")).alias("runs"))


def without(text: str, runs: Iterable[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the words of the runs and the white space after them; how many lines these were on, and how many words."""
    kept, at, word, lines, words, last = [], 0, 0, 0, 0, -1
    found = _WORD.finditer(text)
    end = 0
    for start, stop in sorted(map(tuple, runs)):
        start = max(start, end)
        if start >= stop:
            continue
        end = stop
        while word < start:
            next(found)
            word += 1
        begin = None
        while word < stop:
            match = next(found)
            begin = match.start() if begin is None else begin
            if text.find("\n", last, match.start()) >= 0 or last < 0:
                lines += 1
            last = match.start()
            word += 1
        words += stop - start
        kept.append(text[at:begin])
        at = match.end()
        while at < len(text) and text[at].isspace():
            at += 1
    return ("".join(kept) + text[at:]).strip(), lines, words


def clean(df: DataFrame, run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """All columns of ``df``, with later repeated runs cut from ``text``; ``removed_lines`` says how many lines lost words, ``removed_words`` how many words went.

    ``df`` has ``doc_id`` and ``text``. Words are what white space parts; they
    match without regard to case, over line ends and inside sentences, and
    every run of ``run_words`` words or more that also stands at an earlier
    place goes. A passage stays at its first place, so a whole copy of an
    earlier text is left with an empty text; a run that overlaps its own first
    place leaves one period, so of one word repeated often one stays. Rows
    that repeat an id and a text are one document: they don't lose words to
    each other. Different texts of an id go in the order of their hashes, a
    null id comes before all others, null text stays null, and texts under
    ``run_words`` words are never cut. Columns of ``df`` named
    ``removed_lines`` and ``removed_words`` are replaced.
    """
    if not 0 < line_words <= run_words:
        raise ValueError("a line has one word at least and no more than a run")
    runs = repeated_runs(documents(df).withColumn("copy", F.xxhash64("text")), run_words, line_words)
    runs = runs.toDF("__line_id", "__line_copy", "__line_runs")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__line_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__line_copy"))
    joined = df.drop("removed_lines", "removed_words").join(runs, same, "left")

    @F.pandas_udf("text string, lines int, words int")
    def cut(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
        done = [(None, 0, 0) if r is None else without(t, ((x["start"], x["end"]) for x in r)) for t, r in zip(text, runs)]
        return pd.DataFrame(done, columns=["text", "lines", "words"])

    touched = F.col("__line_runs").isNotNull()
    # Only texts that lose something go through Python.
    done = joined.withColumn("__line_cut", cut(F.when(touched, F.col("text")), F.col("__line_runs")))
    kept = [c for c in df.columns if c not in ("removed_lines", "removed_words")]
    return done.select(
        *(F.when(touched, F.col("__line_cut.text")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in kept),
        F.col("__line_cut.lines").alias("removed_lines"),
        F.col("__line_cut.words").alias("removed_words"),
    )
