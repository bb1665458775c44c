"""Quality scores from a regularised quadratic discriminant over text statistics.

Each text becomes a short vector of transformed statistics. Count, sum and sum
of outer products of the labelled vectors per class are gathered in one Spark
aggregation, whatever the number of labels; from them come class means and
covariances, shrunk towards the pooled one and its mean variance. A score is
the logistic function of the difference of the two Gaussian log densities and
log priors. The Mahalanobis terms use Cholesky factors computed once.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Memo, documents, map_rows
from curbsight.sources.storage import materialize

THRESHOLD = 0.3
SHRINK_TO_POOLED = 0.3
SHRINK_TO_SPHERE = 0.05
#: A vector counts as at most this many standard deviations off in any statistic.
CLIP = 8.0
#: So many parts without a trait are added to each proportion, so that short texts lean to the common case.
PRIOR_PARTS = 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CLASSES = np.zeros((256, 6))
for _column, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\n\r", b".,;:'\"-?()", range(128, 256))):
    _CLASSES[list(_bytes), _column] = 1

STATISTICS = [
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "stop_share", "distinct_share", "top_word_share",
    "repeat_share", "pair_share", "line_share", "log_line_words",
]


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text; an empty one has the values of no words."""
    raw = text.encode()
    upper, lower, digit, space, stop, other = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES).tolist()
    words = text.split()
    n, size = len(words), len(raw) - space
    symbol = size - upper - lower - digit - stop - other
    letters = upper + lower + other
    pairs = max(n - 1, 1)
    lines = text.split("\n")
    counted = Counter(words)

    def share(part: float, whole: float) -> float:
        """A proportion as smoothed log-odds."""
        return math.log((part + 0.5) / (whole - part + PRIOR_PARTS))

    return [
        math.log1p(n),
        math.log1p(size / max(n, 1)),
        share(upper, letters),
        share(digit, size),
        share(symbol, size),
        share(stop, size),
        math.log((len(counted) + 1) / (n + 1) ** 0.8),
        share(max(counted.values(), default=0), n),
        share(sum(map(eq, words, words[1:])), pairs),
        share(pairs - len(set(zip(words, words[1:]))), pairs) if n > 1 else 0.0,
        share(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / len(lines)),
    ]


def vectors(df: DataFrame) -> DataFrame:
    """``doc_id`` and its ``stats``, one row per row."""

    def start():
        def run(rows):
            for doc_id, text in rows:
                yield doc_id, statistics(text)

        return run

    return map_rows(documents(df), start, "doc_id long, stats array<double>", [("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])


class Discriminant:
    """Two Gaussian classes with cached Cholesky factors."""

    def __init__(self, moments: dict[int, tuple[int, np.ndarray, np.ndarray]]):
        """``moments``: per class the count, sum and sum of outer products of its vectors."""
        total = sum(n for n, _, _ in moments.values())
        size = len(STATISTICS)
        centre = sum((s for _, s, _ in moments.values()), np.zeros(size)) / max(total, 1)
        second = sum((q for _, _, q in moments.values()), np.zeros((size, size))) / max(total, 1)
        self._centre = centre
        self._scale = np.sqrt(np.maximum(np.diag(second - np.outer(centre, centre)), 1e-6))
        own = {k: self._normal(*m) for k, m in moments.items()}
        pooled = sum((n * c for n, _, c in own.values()), np.zeros((size, size))) / max(total, 1)
        self._classes = {}
        for k, (n, mean, covariance) in own.items():
            # Few vectors say little about a covariance: their class leans on the pooled one.
            own_weight = (1 - SHRINK_TO_POOLED) * n / (n + size)
            mixed = own_weight * covariance + (1 - own_weight) * pooled
            shrunk = (1 - SHRINK_TO_SPHERE) * mixed + SHRINK_TO_SPHERE * max(np.trace(mixed) / size, 1e-3) * np.eye(size)
            factor = np.linalg.cholesky(shrunk)
            self._classes[k] = (math.log(n / total), mean, np.linalg.inv(factor), np.log(np.diag(factor)).sum())

    def _normal(self, n: int, total: np.ndarray, second: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Count, mean and covariance on the common scale."""
        mean = total / n
        covariance = (second / n - np.outer(mean, mean)) / np.outer(self._scale, self._scale)
        return n, (mean - self._centre) / self._scale, covariance

    def log_odds(self, stats: np.ndarray) -> np.ndarray:
        """Of class 1 against class 0, per row; with one class learnt, that one is certain."""
        if len(self._classes) < 2:
            return np.full(len(stats), math.inf if 1 in self._classes else -math.inf if self._classes else 0.0)
        x = np.clip((stats - self._centre) / self._scale, -CLIP, CLIP)
        density = {}
        for k, (prior, mean, inverse, log_det) in self._classes.items():
            z = (x - mean) @ inverse.T
            density[k] = prior - log_det - 0.5 * (z * z).sum(axis=1)
        return density[1] - density[0]

    def score(self, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(stats), -700, 700)))


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from the rows of ``labels`` (``doc_id``, ``quality`` 0 or 1) that have statistics.

    All of them count; what comes back to the driver are two rows of moments.
    Rows whose label is null or anything else, or whose id is unknown, teach nothing.
    """
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    size = len(STATISTICS)

    def moments():
        def run(rows):
            count, first, second = {}, {}, {}
            for quality, stats in rows:
                x = np.array(stats)
                count[quality] = count.get(quality, 0) + 1
                first[quality] = first.get(quality, 0) + x
                second[quality] = second.get(quality, 0) + np.outer(x, x)
            for k, n in count.items():
                yield (k, n, *first[k].tolist(), *second[k].ravel().tolist())

        return run

    names = [f"m{i}" for i in range(size + size * size)]
    schema = "quality int, n long, " + ", ".join(f"{m} double" for m in names)
    fields = [("quality", pa.int32()), ("n", pa.int64()), *((m, pa.float64()) for m in names)]
    parts = map_rows(measured.join(known, "doc_id").select("quality", "stats"), moments, schema, fields)
    sums = parts.groupBy("quality").agg(F.sum("n"), *(F.sum(m) for m in names)).collect()
    return Discriminant({r[0]: (r[1], np.array(r[2 : 2 + size]), np.array(r[2 + size :]).reshape(size, size)) for r in sums})


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """``doc_id`` and ``score``, 0 to 1 and higher for better texts."""

    def run(batches):
        for batch in batches:
            stats = np.array(batch.column("stats").flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(stats))], ["doc_id", "score"])

    return measured.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def scored(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows of ``df`` by a model learnt from ``labels``; ``doc_id``, ``score``, ``predicted``.

    Null and empty texts are scored by the statistics of no words. A repeated
    row is scored again. Without any usable label all scores are 0.5.
    """
    measured = materialize(vectors(df), "statistics")
    result = score(measured, fit(measured, labels))
    return result.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(df: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score at least ``threshold``, with all their columns.

    Texts are measured again for the decision rather than joined to their
    scores, so none is shuffled. Every row is judged by its own text, whatever
    its id; a null text is judged like an empty one.
    """
    model = fit(vectors(df), labels)

    @F.pandas_udf("double")
    def score_of(text: pd.Series) -> pd.Series:
        Memo.forget_but("")
        return pd.Series(model.score(np.array([statistics(t) for t in text]).reshape(-1, len(STATISTICS))))

    return df.where(score_of(F.coalesce("text", F.lit(""))) >= threshold)


def held_out(doc_id: str = "doc_id"):
    """Whether a label is kept from learning: a fifth of the ids, by checksum."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
