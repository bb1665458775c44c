"""Near-duplicates by order MinHash, verified by banded alignment.

Words are runs of letters and digits in lower case, k-mers are shingles of
five words, each labelled with how often it has occurred before in its text.
For each hash function, one per band, a sketch takes the labelled shingles of
least hash, as many as TUPLES says, and puts them back in text order; the hash
of that ordered tuple is the band's key. The short tuples serve texts of few
shingles, where a single edit changes most long ones. Two texts agree in a band only if they share these shingles in
the same order, so keys follow edit similarity, not just overlap.

Texts with equal words collapse first. Per key the text of least id leads, and
all others are to be in its class or compared with it: a star of pairs, never
all pairs. A text is compared with the least of its leaders first, and with the
others where classes are apart after that. Verified pairs form classes. Where a key's texts are left in more than one class,
another of them leads, drawn by hash, and those of other classes than its own
are compared with it. That is done ROUNDS times; from the second on the key is
joined with those of the next bands, so texts that only share a passage part
ways and meet those they resemble.

Texts of keys that are mixed even then are finished by an exact join, whose
candidates don't depend on keys or leaders. Each text's shingles are ranked by
how many of these texts have them, rarest first; two texts of 0.8 or more have
one in common among the first ninth of the shorter one's and the first fifth
of the longer one's. Texts that have such a shingle in common are compared in
blocks by sizes, ranks and parities of their shingles. What these can't rule
out is aligned, but not as rows of pairs: texts stand in chunks, families side
by side, and the texts of two chunks that may have a pair meet once, in one
task, which aligns pairs until their classes are joined and gives the joining
links only.

A pair is verified by aligning the labelled shingles of both texts within the
band of shifts that the threshold allows. Its similarity is aligned shingles
over all shingles of both: 0.8 or more links.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbsight.llm.common import Memo, blocks, documents, map_rows
from curbsight.sources.storage import materialize

SHINGLE = 5
SIMILARITY = 0.8
TUPLES = [4] * 18 + [2] * 6
BANDS = len(TUPLES)
ROUNDS = 1
DRAWS = 4
#: Bytes of known runs of words that a worker remembers.
MEMORY = 50_000_000
BLOCK_CHARS = 2_000_000
PARITY_BITS = 2048
CELL = 1024
CHUNK = 256
CHUNK_SHINGLES = 500_000
_WORD = re.compile(r"[^\W_]+")
_ODD = np.random.default_rng(20).integers(1, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(21).integers(1, 2**63, BANDS, dtype=np.uint64)
_HALF = np.uint64(29)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hashed(runs: list[str]) -> list[bytes]:
    return [b"".join(xxhash.xxh32_intdigest(w).to_bytes(4, "little") for w in _WORD.findall(r)) for r in runs]


_memo = Memo(_hashed, MEMORY, "words")


def word_hashes(texts: list[str]) -> list[bytes]:
    """The words of each text as 32-bit hashes; five of them in a row make a shingle of 160 bits."""
    return _memo.joined([t.lower().split() for t in texts])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: bytes) -> np.ndarray:
    """Hash of each shingle, labelled by its number among equal ones; a shorter text is one shingle."""
    w = np.frombuffer(words, "<u4").astype(np.uint64)
    size = min(SHINGLE, len(w))
    if not size:
        return w
    count = len(w) - size + 1
    x = np.full(count, size, np.uint64)
    for i in range(size):
        x = mixed(x * _STEP + w[i : i + count])
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if fresh.all():
        return x
    number = np.arange(count)
    label = np.empty(count, np.uint64)
    label[order] = number - np.maximum.accumulate(np.where(fresh, number, 0))
    return mixed(x + label * _STEP)


def band_keys(labelled: np.ndarray) -> np.ndarray:
    """One key per band, from the least labelled shingles in text order; a text of too few gives all it has."""
    keys = []
    for size, bands in groupby(range(BANDS), TUPLES.__getitem__):
        bands, size = list(bands), min(size, len(labelled))
        least = np.empty((len(bands), size), np.int64)
        for row, band in enumerate(bands):
            x = labelled * _ODD[band] + _ADD[band]
            least[row] = np.argpartition(x ^ (x >> _HALF), size - 1)[:size]
        least.sort(axis=1)
        key = _ADD[bands]
        for h in labelled[least].T:
            key = mixed(key * _STEP + h)
        keys.append(key)
    return np.concatenate(keys).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Aligned labelled shingles over all of both, 0 if that must be under SIMILARITY.

    Labels make each shingle unique within its text, so an alignment is a
    rising chain of matches. Every shift leaves a shingle without partner, so
    matches off the diagonal by more than the band can't help a pair that
    passes.
    """
    both = len(a) + len(b)
    need = SIMILARITY * both / (1 + SIMILARITY)
    if min(len(a), len(b)) < need - 1e-9:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= both - 2 * need + 1e-9
    at_a, at_b = at_a[near], at_b[near]
    if len(at_a) < need - 1e-9:
        return 0.0
    partners = at_b[np.argsort(at_a)]
    chain = len(partners) if (partners[1:] > partners[:-1]).all() else _longest_rise(partners.tolist())
    return chain / (both - chain)


def _longest_rise(values: list[int]) -> int:
    tails: list[int] = []
    for v in values:
        at = bisect_left(tails, v)
        tails[at : at + 1] = [v]
    return len(tails)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``copy``, ``words_digest`` and band ``keys`` (none without words), one row per row."""

    def start():
        def run(rows):
            for block in blocks((((doc_id, copy), text) for doc_id, copy, text in rows), BLOCK_CHARS):
                for (own, text), words in zip(block, word_hashes([text for _, text in block])):
                    if words:
                        yield *own, hashlib.blake2b(words, digest_size=16).digest(), band_keys(shingles(words)).tolist()
                    else:
                        yield *own, hashlib.blake2b(text.encode(), digest_size=16, key=b"no words").digest(), []

        return run

    fields = [("doc_id", pa.int64()), ("copy", pa.int64()), ("words_digest", pa.binary()), ("keys", pa.list_(pa.int64()))]
    chosen = docs.select("doc_id", "copy", "text")
    return map_rows(chosen, start, "doc_id long, copy long, words_digest binary, keys array<long>", fields, memory="words")


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row of each ``keys``. After a join by them, rows are dealt and sorted for this already."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return df.withColumn("__number", number).where("__number = 1").drop("__number")


def hashed_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id``, now the ``number`` in ``wanted``, and ``words`` of the rows (``doc_id``, ``copy``) that it names.

    The hint keeps the plan the same at every size: names grow with the input.
    """

    def start():
        def run(rows):
            for block in blocks(rows, BLOCK_CHARS):
                yield from zip([number for number, _ in block], word_hashes([text for _, text in block]))

        return run

    chosen = once(docs.join(wanted.hint("merge"), ["doc_id", "copy"]), "doc_id", "copy").select("number", "text")
    return map_rows(chosen, start, "doc_id long, words binary", [("doc_id", pa.int64()), ("words", pa.binary())], 256, "words")


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar enough."""
    sides = pairs.join(words.select(F.col("doc_id").alias("a"), F.col("words").alias("words_a")), "a").join(
        words.select(F.col("doc_id").alias("b"), F.col("words").alias("words_b")), "b"
    )

    def start():
        def run(rows):
            last = None, None
            for a, b, words_a, words_b in rows:
                if last[0] != words_b:  # rows of one leader mostly come together
                    last = words_b, shingles(words_b)
                if similarity(shingles(words_a), last[1]) >= SIMILARITY:
                    yield a, b

        return run

    return map_rows(sides.select("a", "b", "words_a", "words_b"), start, "a long, b long", [("a", pa.int64()), ("b", pa.int64())])


def classes_of(links: DataFrame) -> DataFrame:
    """Connected components: ``doc_id`` and ``class_id``, the least id of its component, of all ids in ``links``.

    Each round every id takes the least label among itself and its neighbours,
    and then that label's own label; rounds double the reach along chains and
    each is written out, so a lost executor costs one round.
    """
    links = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "doc_id"), "labels")
    while True:
        near = links.join(labels.withColumnRenamed("doc_id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        jumped = labels.select(F.col("doc_id").alias("label"), F.col("label").alias("far"))
        following = (
            labels.join(near.withColumnRenamed("a", "doc_id"), "doc_id")
            .join(jumped, "label")
            .select("doc_id", F.least("label", "near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved"))
        )
        following = materialize(following, "labels")
        labels = following.select("doc_id", "label")
        if following.where("moved").isEmpty():
            return labels.withColumnRenamed("label", "class_id")


def between_classes(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are in different classes, with ``class_a`` and ``class_b``; a text without label is a class of its own."""
    for side in ("a", "b"):
        own = labels.select(F.col("doc_id").alias(side), F.col("class_id").alias(f"class_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"class_{side}", F.coalesce(f"class_{side}", side))
    return pairs.where("class_a <> class_b")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are in different classes."""
    return between_classes(pairs, labels).select("a", "b")


def rejoined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only classes are followed, each as one, not the links that have made them."""
    between = between_classes(links, labels).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    merged = classes_of(between).withColumnRenamed("class_id", "joins")
    own = labels.join(merged.withColumnRenamed("doc_id", "class_id"), "class_id", "left")
    fresh = merged.join(labels, "doc_id", "left_anti").withColumnRenamed("joins", "class_id")
    return materialize(own.select("doc_id", F.coalesce("joins", "class_id").alias("class_id")).union(fresh.select("doc_id", "class_id")), "labels")


def drawn_stars(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (``a`` > ``b``) of a leader, drawn by hash for each key, with the key's members of other classes than its own.

    ``members`` holds ``key``, ``doc_id`` and ``class_id``. Keys draw in DRAWS
    different orders, so a group that shares many keys meets that many leaders
    in a round, not one per key.
    """
    order = F.xxhash64(F.lit(turn), F.pmod("key", F.lit(DRAWS)), "doc_id")
    leaders = members.groupBy("key").agg(F.min_by("doc_id", order).alias("leader"), F.min_by("class_id", order).alias("leads"))
    met = members.join(materialize(leaders, "leaders"), "key").where("class_id <> leads")
    return met.select(F.greatest("doc_id", "leader").alias("a"), F.least("doc_id", "leader").alias("b")).distinct()


def unresolved(members: DataFrame, labels: DataFrame, sketched: DataFrame, turn: int) -> DataFrame:
    """Members (``doc_id``, ``band``, ``key``) of keys whose texts are in several classes, with their ``class_id``.

    From the second turn on each key is refined by that of a further band.
    """
    placed = members.select("doc_id", "band", "key").join(labels, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    several = placed.groupBy("key").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    left = placed.join(materialize(several.select("key"), "mixed-keys"), "key", "left_semi")
    if turn > 1:
        further = F.get("keys", (F.col("band") + (turn - 1)) % BANDS)
        left = left.join(sketched, "doc_id").select("doc_id", "band", F.xxhash64("key", further).alias("key"), "class_id")
    return materialize(left, "unresolved")


def parities(labelled: np.ndarray) -> bytes:
    """A bit per hash value of shingles: whether an odd number of them has it. Two texts differ in as many shingles as bits, or more."""
    if len(labelled) > PARITY_BITS:  # nearly random bits tell nothing
        return b""
    return np.packbits(np.bincount((labelled % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1).tobytes()


def rare_shingles(placed: DataFrame, words: DataFrame) -> DataFrame:
    """Of each text its rarest shingles: ``shingle``, ``doc_id``, ``class_id``, ``size``, ``chunk``, ``at``, ``short`` and ``bits``.

    ``placed`` has ``doc_id``, ``class_id`` and ``family``, which is mostly
    equal for texts that resemble each other; these go to the same chunks. A
    text's shingles are ordered
    by the number of texts that have them; those of one class only come first
    and are left out, since they can't be common to two classes. ``at`` is the
    place in that order. Of the shingles that two similar texts share, the
    first one has at most ``size - ceil(SIMILARITY * size)`` before it in the
    longer text, and in the shorter one, which must share more of its own, few
    enough to be ``short``.
    """

    def start():
        def run(rows):
            chunk, texts, held = TaskContext.get().partitionId() << 32, 0, 0
            for doc_id, class_id, own in rows:
                labelled = shingles(own)
                if texts == CHUNK or texts and held + len(labelled) > CHUNK_SHINGLES:
                    chunk, texts, held = chunk + 1, 0, 0
                texts, held = texts + 1, held + len(labelled)
                yield doc_id, class_id, chunk, labelled.view(np.int64).tolist(), parities(labelled)

        return run

    fields = [("doc_id", pa.int64()), ("class_id", pa.int64()), ("chunk", pa.int64()), ("shingles", pa.list_(pa.int64())), ("bits", pa.binary())]
    order = ["family", "class_id", "doc_id"]
    chosen = words.join(placed, "doc_id").repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "class_id", "words")
    listed = map_rows(chosen, start, "doc_id long, class_id long, chunk long, shingles array<long>, bits binary", fields, 256)
    listed = materialize(listed, "shingles")
    each = listed.select("doc_id", "class_id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    met = each.join(materialize(common.select("shingle", "n"), "common-shingles"), "shingle")
    ranked = met.groupBy("doc_id", "class_id", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    first = F.col("size") - F.size("ranked")
    before = lambda share: F.col("size") - F.ceil(F.col("size") * share - 1e-9)
    near = ranked.withColumn("first", first).withColumn("ranked", F.slice("ranked", 1, F.greatest(F.lit(0), before(SIMILARITY) - first + 1).cast("int")))
    at = near.select("doc_id", "class_id", "size", F.posexplode("ranked").alias("number", "r"), "first").withColumn("at", F.col("first") + F.col("number"))
    short = F.col("at") <= before(2 * SIMILARITY / (1 + SIMILARITY))
    found = at.select("r.shingle", "doc_id", "class_id", "size", "at", short.alias("short"))
    columns = ["shingle", "doc_id", "class_id", "size", "chunk", "at", "short", "bits"]
    return found.join(listed.select("doc_id", "chunk", "bits"), "doc_id").select(columns)


class Texts(NamedTuple):
    """Columns of some texts, by rising size."""

    ids: np.ndarray
    own: np.ndarray
    size: np.ndarray
    chunk: np.ndarray
    known: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Texts:
        """From rows that begin with ``doc_id``, ``class_id``, ``size``, ``chunk`` and ``bits``, sorted by size."""
        ids, own, size, chunk = (np.array([r[k] for r in rows]) for k in range(4))
        known = np.array([len(r[4]) > 0 for r in rows])
        bits = np.frombuffer(b"".join(r[4] or bytes(PARITY_BITS // 8) for r in rows), "<u8").reshape(len(rows), -1)
        return cls(ids, own, size, chunk, known, bits)

    def needed(self, x: int, y: np.ndarray) -> np.ndarray:
        """How many shingles the texts must share at least."""
        return (self.size[x] + self.size[y]) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9

    def last(self) -> np.ndarray:
        """For each text the first one that is too long for it."""
        return np.searchsorted(self.size, self.size / SIMILARITY + 1e-6, "right")

    def not_apart(self, x: int, y: np.ndarray) -> np.ndarray:
        """Those of ``y`` whose parities allow that they are similar to ``x``."""
        if not len(y) or not self.known[x]:
            return y
        apart = np.bitwise_count(self.bits[y] ^ self.bits[x]).sum(axis=1, dtype=np.int64)
        return y[~self.known[y] | (apart <= self.size[x] + self.size[y] - 2 * self.needed(x, y))]


def may_meet(cell: list[tuple], across: bool) -> Iterator[tuple[int, int, int, int, int]]:
    """Texts of a cell that may be similar to one of another class, and block if ``across``: ``low``, ``high`` (the chunks of both), and the text's own chunk, ``doc_id`` and ``class_id``.

    ``cell`` has ``doc_id``, ``class_id``, ``size``, ``chunk``, ``bits``,
    ``at``, ``short`` and ``block``. Sizes, the shingles after the common one
    and parities must allow it.
    """
    cell = sorted(cell, key=lambda r: (r[2], r[0]))
    texts = Texts.of(cell)
    at, short, block = (np.array([r[k] for r in cell]) for k in (5, 6, 7))
    last, meetings = texts.last(), {}
    for x in np.flatnonzero(short):
        y = np.arange(x + 1, last[x])
        ok = (texts.own[y] != texts.own[x]) & (np.minimum(texts.size[x] - at[x], texts.size[y] - at[y]) >= texts.needed(x, y))
        if across:
            ok &= block[y] != block[x]
        y = texts.not_apart(x, y[ok])
        for chunk in np.unique(texts.chunk[y]).tolist():
            both = min(chunk, int(texts.chunk[x])), max(chunk, int(texts.chunk[x]))
            met = meetings.setdefault(both, np.zeros(len(cell), bool))
            met[y[texts.chunk[y] == chunk]] = met[x] = True
    for both, met in meetings.items():
        for x in np.flatnonzero(met):
            yield *both, int(texts.chunk[x]), int(texts.ids[x]), int(texts.own[x])


def joining_links(met: list[tuple]) -> Iterator[tuple[int, int]]:
    """Similar texts (``a`` > ``b``) of different classes and of both chunks, as many as join the classes.

    ``met`` has ``chunk``, ``doc_id``, ``class_id`` and ``words``.
    """
    measured = []
    for chunk, doc_id, class_id, words in met:
        labelled = shingles(words)
        measured.append((doc_id, class_id, len(labelled), chunk, parities(labelled), labelled))
    measured.sort(key=lambda r: (r[2], r[0]))
    texts = Texts.of(measured)
    last, leads = texts.last(), {}

    def root(c: int) -> int:
        while c in leads:
            c = leads[c]
        return c

    across = texts.chunk.min() != texts.chunk.max()
    for x in range(len(measured)):
        y = np.arange(x + 1, last[x])
        ok = texts.own[y] != texts.own[x]
        if across:
            ok &= texts.chunk[y] != texts.chunk[x]
        for other in texts.not_apart(x, y[ok]).tolist():
            one, two = root(int(texts.own[x])), root(int(texts.own[other]))
            if one != two and similarity(measured[x][5], measured[other][5]) >= SIMILARITY:
                leads[max(one, two)] = min(one, two)
                yield max(measured[x][0], measured[other][0]), min(measured[x][0], measured[other][0])


def meetings(placed: DataFrame, words: DataFrame) -> DataFrame:
    """Which texts meet: ``low``, ``high``, ``chunk``, ``doc_id``, ``class_id``, so that every two similar texts of different classes do.

    Texts that have a rare shingle in common are looked through in cells of
    two blocks, so a task holds CELL texts whatever their number. A meeting
    has the texts of two chunks that may be similar, each once.
    """
    rare = rare_shingles(placed, words)
    by_class = Window.partitionBy("shingle").orderBy("class_id", "doc_id")
    whole = Window.partitionBy("shingle")
    blocked = rare.withColumn("block", F.floor((F.row_number().over(by_class) - 1) / (CELL // 2)).cast("int"))
    blocked = blocked.withColumn("last", F.max("block").over(whole)).withColumn("low", F.min("class_id").over(whole)).withColumn("high", F.max("class_id").over(whole))
    dealt = blocked.where("low < high").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    columns = ["shingle", "i", "j", "doc_id", "class_id", "size", "chunk", "bits", "at", "short", "block"]
    cells = dealt.select(columns).repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")

    def start():
        def run(rows):
            for (_, i, j), cell in groupby(rows, lambda r: r[:3]):
                yield from may_meet([r[3:] for r in cell], i != j)

        return run

    fields = [(c, pa.int64()) for c in ("low", "high", "chunk", "doc_id", "class_id")]
    return map_rows(cells, start, "low long, high long, chunk long, doc_id long, class_id long", fields).distinct()


def links_of_several_classes(placed: DataFrame, words: DataFrame) -> DataFrame:
    """Links (``a`` > ``b``) that join all classes of which some texts are similar."""
    met = materialize(meetings(placed, words), "meetings").join(words, "doc_id").select("low", "high", "chunk", "doc_id", "class_id", "words")

    def start():
        def run(rows):
            for _, group in groupby(rows, lambda r: r[:2]):
                yield from joining_links([r[2:] for r in group])

        return run

    dealt = met.repartition("low", "high").sortWithinPartitions("low", "high")
    return map_rows(dealt, start, "a long, b long", [("a", pa.int64()), ("b", pa.int64())])


def labelled(df: DataFrame) -> DataFrame:
    """Of each row with an id: ``doc_id``, ``copy`` (a hash of its text) and the ``label`` of its class, a number."""
    docs = documents(df).where("doc_id IS NOT NULL").withColumn("copy", F.xxhash64("text"))
    sketched = materialize(sketches(docs), "sketches")
    equal = sketched.groupBy("words_digest").agg(F.min(F.struct("doc_id", "copy")).alias("first"))
    # Texts of equal words have one number, that of their first row's; it stays, since it is stored.
    equal = materialize(equal.select("words_digest", "first.*", F.monotonically_increasing_id().alias("number")), "equal-words")
    firsts = sketched.where(F.size("keys") > 0).join(equal, ["words_digest", "doc_id", "copy"]).dropDuplicates(["number"])
    firsts = materialize(firsts.select(F.col("number").alias("doc_id"), "keys"), "first-sketches")
    alone = firsts.select("doc_id", F.posexplode("keys").alias("band", "key")).withColumn("key", F.xxhash64("band", "key"))
    leaders = alone.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).where("leader < last")
    members = materialize(alone.join(materialize(leaders.select("key", "leader"), "leaders"), "key"), "members")
    tried = members.where("doc_id > leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).distinct()
    tried = materialize(tried, "pairs")
    # Whatever is compared later shares a key, so it is in these pairs.
    compared = tried.select(F.col("a").alias("number")).union(tried.select("b")).distinct()
    words = materialize(hashed_words(docs, equal.join(compared, "number").select("doc_id", "copy", "number")), "words")
    # One leader each settles most classes; further pairs of a text are compared where classes are apart.
    least = materialize(tried.groupBy("a").agg(F.min("b").alias("b")), "least-pairs")
    labels = classes_of(materialize(verified(least, words), "verified"))
    found = materialize(verified(materialize(apart(tried.join(least, ["a", "b"], "left_anti"), labels), "pairs"), words), "verified")
    if not found.isEmpty():
        labels = rejoined(labels, found)
    starred = members
    for turn in range(1, ROUNDS + 1):
        members = unresolved(members, labels, firsts, turn)
        pairs = materialize(drawn_stars(members, turn).join(tried, ["a", "b"], "left_anti"), "pairs")
        found = materialize(verified(pairs, words), "verified")
        if not found.isEmpty():
            labels = rejoined(labels, found)
        tried = materialize(tried.union(pairs), "tried") if turn < ROUNDS else None
    mixed_texts = unresolved(starred, labels, firsts, 1).groupBy("doc_id", "class_id").agg(F.min("key").alias("family"))
    found = materialize(links_of_several_classes(materialize(mixed_texts, "mixed-texts"), words), "verified")
    if not found.isEmpty():
        labels = rejoined(labels, found)
    numbered = equal.select("words_digest", "number").join(labels.withColumnRenamed("doc_id", "number"), "number", "left")
    numbered = numbered.select("words_digest", F.coalesce("class_id", "number").alias("label"))
    return materialize(sketched.select("doc_id", "copy", "words_digest").join(numbered, "words_digest").select("doc_id", "copy", "label"), "labelled")


def classes(df: DataFrame) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``class_id`` (the least id of its class) and ``class_size`` in rows.

    ``df`` has ``doc_id`` and ``text``; other columns play no part. Null text
    counts as empty. Texts of equal words are one class whatever their length;
    texts without words are alike only if identical, empty ones among them. A
    text of under five words is a single shingle, so it is alike only to equal
    words. Rows that repeat an id go by one class, the least that one of them
    is in. A null id is no class's name and its row is a class of its own
    with a null ``class_id``. Long texts are sketched and aligned whole.
    """
    docs, placed = documents(df), labelled(df)
    least = materialize(placed.groupBy("label").agg(F.min("doc_id").alias("class_id")), "least-ids")
    named = materialize(placed.join(least, "label").groupBy("doc_id").agg(F.min("class_id").alias("class_id")), "classes")
    ids = docs.select("doc_id").join(named, "doc_id", "left")
    sizes = materialize(ids.groupBy("class_id").agg(F.count("*").alias("class_size")), "class-sizes")
    whole = ids.join(sizes, "class_id", "left")
    return whole.select("doc_id", "class_id", F.coalesce(F.when(F.col("class_id").isNotNull(), F.col("class_size")), F.lit(1)).alias("class_size"))


def representatives(df: DataFrame) -> DataFrame:
    """The rows of ``df``, with all their columns, that stay: the least id of each class.

    Different texts of one id are told apart, so each stays or goes by its own
    class; of rows that repeat an id and a text one stays. Rows without an id
    all stay.
    """
    first = labelled(df).groupBy("label").agg(F.min(F.struct("doc_id", "copy")).alias("first"))
    first = materialize(first.select(F.col("first.doc_id").alias("__near_id"), F.col("first.copy").alias("__near_copy")), "representatives")
    copies = df.withColumn("__copy", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = copies.join(first, (F.col("doc_id").cast("long") == F.col("__near_id")) & (F.col("__copy") == F.col("__near_copy")), "left_semi")
    return once(kept, "doc_id", "__copy").drop("__copy").unionByName(df.where("doc_id IS NULL"))
