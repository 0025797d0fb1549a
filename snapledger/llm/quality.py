"""Quality scores by regularised quadratic discriminant analysis over statistics of the text.

Each class has a Gaussian over the transformed statistics, with a covariance shrunk towards its
diagonal. A score is the posterior of class 1: the difference of the two log densities, each by the
squared length of the residual after the cached inverse Cholesky factor, plus the log prior odds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHRINKAGE = 0.1
#: Added to each variance, in units of the pooled variance of the statistic.
RIDGE = 0.05
#: Log odds are divided by it: statistics of one text are not independent, so densities overstate.
TEMPERATURE = 2.0
#: Score from which class 1 is predicted.
CUT = 0.7

LOWER, UPPER, DIGIT, SPACE, LINE, MARK, HIGH = range(7)
CLASSES = np.full(256, MARK, np.uint8)
CLASSES[ord("a") : ord("z") + 1], CLASSES[ord("A") : ord("Z") + 1], CLASSES[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
CLASSES[list(b" \t\r\x0b\x0c")], CLASSES[ord("\n")], CLASSES[128:] = SPACE, LINE, HIGH

NAMES = [
    "length", "upper", "digit", "mark", "high", "space", "word_mean", "word_spread", "mark_end", "mark_alone",
    "mark_run", "variety", "top_word", "lines", "line_mean", "line_repeats", "entropy", "long_words",
]


def share(part: float, whole: float) -> float:
    """A share on the arcsine scale, which evens out its variance."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; all are finite, for the empty text too."""
    data = (text or "").encode("utf-8", "replace")
    kinds = CLASSES[np.frombuffer(data, np.uint8)]
    n = np.bincount(kinds, minlength=7)
    words = data.split()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in (y.strip() for y in data.split(b"\n")) if x]
    counted, seen = Counter(words), Counter(lines)
    marks = kinds == MARK
    two = marks[1:] & marks[:-1]
    gap = (kinds == SPACE) | (kinds == LINE)
    # marks at the end of a word that is not made of marks alone
    ends = np.flatnonzero(marks & np.append(gap[1:], True)) if len(kinds) else np.empty(0, np.int64)
    alone = int((gap[ends - 1] | (ends == 0)).sum()) if len(ends) else 0
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / max(1, len(data))
    shares = shares[shares > 0]
    total, letters = len(data), n[LOWER] + n[UPPER] + n[HIGH]
    return [
        float(np.log1p(total)),
        share(n[UPPER], letters),
        share(n[DIGIT], total),
        share(n[MARK], total),
        share(n[HIGH], total),
        share(n[SPACE] + n[LINE], total),
        float(np.log1p(sizes.mean())) if len(words) else 0.0,
        float(np.log1p(sizes.std())) if len(words) else 0.0,
        share(len(ends) - alone, len(words)),
        share(alone, len(words)),
        share(int(two.sum()), total),
        float(np.log(len(counted)) / np.log(len(words))) if len(words) > 1 else 1.0,
        share(max(counted.values(), default=0), len(words)),
        float(np.log1p(len(lines))),
        float(np.log1p(total / len(lines))) if lines else 0.0,
        share(len(lines) - len(seen), len(lines)),
        float(-(shares * np.log2(shares)).sum()) if total else 0.0,
        share(int((sizes > 20).sum()), len(words)),
    ]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics, one row per input row."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "stats"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(measure, f"doc_id {kind}, stats array<double>")


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sums and sums of products of the statistics, over all rows of (label, stats).

    Each task adds up its own rows; what reaches the driver has the size of two covariance matrices.
    """
    width = len(NAMES)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            stats = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, width)
            stats = np.hstack([np.ones((len(stats), 1)), stats])
            labels = np.array(batch.column(0).to_pylist())
            for label in np.unique(labels):
                own = stats[labels == label]
                sums[label] = sums.get(label, 0) + own.T @ own
        for label, total in sums.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(label)] * len(flat), pa.int32()), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                ["label", "cell", "value"],
            )

    sums = rows.mapInArrow(add, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for row in sums.collect():
        out.setdefault(row.label, np.zeros((width + 1) ** 2))[row.cell] = row.value
    full = {label: flat.reshape(width + 1, width + 1) for label, flat in out.items()}
    return {label: (m[0, 0], m[0, 1:], m[1:, 1:]) for label, m in full.items()}


class Discriminant:
    """Mean, inverse Cholesky factor and log constant of each class."""

    def __init__(self, found: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        self.ready = all(found.get(label, (0,))[0] > 1 for label in (0, 1))
        if not self.ready:
            return
        total = sum(found[k][0] for k in (0, 1))
        centred = {k: p / n - np.outer(s / n, s / n) for k, (n, s, p) in found.items()}
        pooled = sum(found[k][0] / total * np.diag(centred[k]) for k in (0, 1))
        ridge = RIDGE * np.maximum(pooled, 1e-6)
        self.parts = []
        for label in (0, 1):
            n, s, _ = found[label]
            shrunk = (1 - SHRINKAGE) * centred[label] + SHRINKAGE * np.diag(np.diag(centred[label])) + np.diag(ridge)
            factor = np.linalg.cholesky(shrunk)
            self.parts.append((s / n, np.linalg.inv(factor), np.log(n / total) - np.log(np.diag(factor)).sum()))

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(stats), 0.5)
        logs = [c - 0.5 * (((stats - mean) @ inverse.T) ** 2).sum(1) for mean, inverse, c in self.parts]
        return 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / TEMPERATURE, -700, 700)))


def fit(labelled: DataFrame) -> Discriminant:
    """The discriminant of (label 0 or 1, stats); without two rows of each class it scores 0.5 throughout."""
    return Discriminant(moments(labelled.filter("label in (0, 1)").select(F.col("label").cast("int"), "stats")))


def score(measured: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, score, predicted for each row of (doc_id, stats)."""
    kind = measured.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, len(NAMES))
            scores = model.scores(stats)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return measured.select("doc_id", "stats").mapInArrow(apply, f"doc_id {kind}, score double, predicted int")
