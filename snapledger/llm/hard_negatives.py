"""Hard negatives by exact inner products: residues modulo small primes, multiplied in float32.

Components are scaled and floored to whole numbers. Modulo a prime of at most ten bits, centred, the
products of 64 components add up to less than 2**24, so a float32 matrix product is exact. Some
primes, as many as the greatest possible score needs, give every score by Chinese remaindering.

Anchors are taken in slabs of bounded size. A slab is broadcast and the rows stay where they are: a
task multiplies its rows with the slab, in blocks, and keeps the few best for each anchor. The lists
of the tasks meet in a window function. A first pass finds the positives of the slab, whose scores
set the ranges in which a second pass looks for negatives.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import running_total, written

#: Components that one float32 sum takes: 64 products of numbers up to 510 stay below 2**24.
CHUNK = 64
#: Components of the anchors that are broadcast at a time.
SLAB_CELLS = 1 << 22
#: Anchors and rows that are multiplied at a time.
ANCHORS, ROWS = 512, 2048
#: Scores are below this number, so that they, and 100 times they, fit 64 bits.
GREATEST = 1 << 55
NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> list[int]:
    """The greatest primes below 1024, as many as tell all whole numbers from -bound to bound apart; two at least."""
    out, n = [], 1022
    while len(out) < 2 or math.prod(out) <= 2 * bound + 1:
        if all(n % q for q in range(2, math.isqrt(n) + 1)):
            out.append(n)
        n -= 1
    return out


def residues(whole: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo ``p``, from -(p - 1) / 2 to (p - 1) / 2."""
    return ((whole + p // 2) % p - p // 2).astype(np.float32)


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of two matrices that are given by their residues."""
    out, product = None, 1
    for a, b, p in zip(left, right, primes):
        total = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, a.shape[1], CHUNK):
            total += a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T
            # Back to about half of the prime; whatever the rounding, the residue stays the same.
            total -= np.rint(total * np.float32(1 / p)) * np.float32(p)
        rest = total.astype(np.int64)
        if out is None:
            out = rest % p
        else:
            out += product * ((rest - out) * pow(product, -1, p) % p)
        product *= p
    out[out > product // 2] -= product
    return out


def best_columns(values: np.ndarray, n: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` greatest values of each row, of equal ones the first columns, and of
    some more. Values below ``least`` of their row, and ``NONE``, are passed over."""
    bound = least
    if values.shape[1] > n:
        at = values.shape[1] - n
        bound = np.maximum(bound, np.partition(values, at, axis=1)[:, at])
    equal = (values == bound[:, None]) & (bound > NONE)[:, None]
    equal &= np.cumsum(equal, axis=1, dtype=np.int32) <= n
    return np.nonzero((values > bound[:, None]) | equal)


class Best:
    """The ``n`` best (score, id) of each of ``size`` lists: higher scores, then smaller ids, NULL last."""

    def __init__(self, size: int, n: int):
        self.n, self.least = n, np.full(size, NONE)
        self.list = self.score = self.id = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def add(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if not len(lists):
            return
        parts = (self.list, lists), (self.score, score), (self.id, ids), (self.null, null)
        of, score, ids, null = (np.concatenate(p) for p in parts)
        order = np.lexsort((ids, null, -score, of))
        of = of[order]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
        kept = order[place < self.n]
        self.list, self.score, self.id, self.null = of[place < self.n], score[kept], ids[kept], null[kept]
        full = np.flatnonzero(place == self.n - 1)
        self.least[of[full]] = score[order[full]]


@dataclass
class Rows:
    """Some rows in order of id: their number, id, whether it is NULL, label, and whole components."""

    row: np.ndarray
    id: np.ndarray
    null: np.ndarray
    label: np.ndarray
    whole: np.ndarray

    def take(self, places) -> "Rows":
        return Rows(self.row[places], self.id[places], self.null[places], self.label[places], self.whole[places])


def rows_of(table: pa.Table | pa.RecordBatch, width: int) -> Rows:
    """The rows of a table in order of id, NULL last. Shorter vectors are filled up with zeros."""
    plain = {name: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for name, c in zip(table.schema.names, table.columns)}
    ids, vectors = plain["id"], plain["whole"]
    lengths = vectors.value_lengths().to_numpy(False).astype(np.int64)
    whole = np.zeros((table.num_rows, width), np.int64)
    whole[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(False)
    row, number, label = (plain[c].fill_null(0).to_numpy(False) for c in ("row", "id", "label"))
    found = Rows(row, number, ids.is_null().to_numpy(False), label, whole)
    return found.take(np.lexsort((found.id, found.null)))


class Anchors:
    """A slab of anchors, with the scores of their positives once those are known."""

    def __init__(self, rows: Rows, primes: list[int], n_positives: int, n_negatives: int, low: int, high: int, per: int):
        self.rows, self.primes = rows, primes
        self.n_positives, self.n_negatives = n_positives, n_negatives
        self.low, self.high, self.per = low, high, per
        size = len(rows.row)
        self.positive_id, self.positive_null = np.zeros((size, n_positives), np.int64), np.zeros((size, n_positives), bool)
        #: NONE where an anchor has fewer positives.
        self.positive_score = np.full((size, n_positives), NONE)

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Rows, list[np.ndarray]]]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = rows_of(batch.slice(at, ROWS), self.rows.whole.shape[1])
                yield rows, [residues(rows.whole, p) for p in self.primes]

    def positives(self, batches: Iterator[pa.RecordBatch]) -> Best:
        """The best other rows with the label of each anchor."""
        own = [residues(self.rows.whole, p) for p in self.primes]
        best = Best(len(self.rows.row), self.n_positives)
        by_label = np.argsort(self.rows.label, kind="stable")
        labels = self.rows.label[by_label]
        for rows, right in self.blocks(batches):
            for label in np.unique(rows.label):
                mine = by_label[np.searchsorted(labels, label) : np.searchsorted(labels, label, "right")]
                theirs = np.flatnonzero(rows.label == label)
                for at in range(0, len(mine), ANCHORS):
                    some = mine[at : at + ANCHORS]
                    found = scores([a[some] for a in own], [b[theirs] for b in right], self.primes)
                    found[self.rows.row[some][:, None] == rows.row[theirs]] = NONE
                    a, c = best_columns(found, self.n_positives, best.least[some])
                    best.add(some[a], found[a, c], rows.id[theirs[c]], rows.null[theirs[c]])
        return best

    def negatives(self, batches: Iterator[pa.RecordBatch]) -> Best:
        """The best rows with other labels whose scores lie in the range of each positive."""
        own = [residues(self.rows.whole, p) for p in self.primes]
        size, n = len(self.rows.row), self.n_positives
        best = Best(size * n, self.n_negatives)
        known = self.positive_score > NONE
        positive = np.where(known, self.positive_score, 0)
        # An anchor without this positive gets an empty range.
        from_, to = np.where(known, -(-self.low * positive // self.per), 1), np.where(known, self.high * positive // self.per, 0)
        for rows, right in self.blocks(batches):
            for at in range(0, size, ANCHORS):
                some = np.arange(at, min(size, at + ANCHORS))
                found = scores([a[some] for a in own], right, self.primes)
                found[self.rows.label[some][:, None] == rows.label] = NONE
                for k in range(n):
                    lists = some * n + k
                    least = np.maximum(from_[some, k], best.least[lists])
                    inside = (found >= least[:, None]) & (found <= to[some, k][:, None])
                    if np.count_nonzero(inside) > 4 * self.n_negatives * len(some):
                        a, c = best_columns(np.where(inside, found, NONE), self.n_negatives, least)
                    else:
                        a, c = np.nonzero(inside)
                    best.add(lists[a], found[a, c], rows.id[c], rows.null[c])
        return best


def _ids(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=null)


def _best_of(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    per: int = 100,
    scale: int = 256,
    slab_cells: int = SLAB_CELLS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * component), exact. Positives of an anchor (a row for
    which ``is_anchor`` holds) are its ``n_positives`` best other rows of the same label, negatives of a
    positive its ``n_negatives`` best rows of other labels with low * positive score <= per * score <=
    high * positive score. Higher scores come first, then smaller ids, NULL last. Fewer are returned
    where there are fewer; a pair without any negative has no row.

    Rows take no part if label or vector is NULL or a component is NULL or not finite. Every other
    row counts on its own, rows that repeat an id included; one with a NULL id may be positive or
    negative. A shorter vector counts as filled up with zeros. Scores must be below 2**55: greater
    vectors raise ValueError. Other columns are not read.
    """
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * scale)
    good = F.col(label_col).isNotNull() & F.coalesce(
        F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False)
    )
    rows = vectors.filter(good).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        scaled.alias("scaled"),
    )
    norm = F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x)
    most = rows.agg(F.max(norm).alias("norm"), F.max(F.size("scaled")).alias("width")).first()
    width = most.width or 0
    # Flooring moves a component by less than one.
    bound = (math.sqrt(most.norm or 0.0) + math.sqrt(width)) ** 2 + 1
    if not bound < GREATEST:
        raise ValueError(f"vectors of column {vector_col} are too long for exact scores: up to {bound:.3g}")
    primes = primes_for(int(bound))
    whole = F.transform("scaled", lambda x: F.floor(x).cast("long"))
    table = written(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "is_anchor", whole.alias("whole")), "vectors")
    size = max(1, slab_cells // max(1, width))
    numbered = running_total(table.filter("is_anchor").select("row", "id", "label", "whole"), ["id", "row"])
    numbered = written(numbered.withColumn("slab", F.floor(F.col("start") / size)), "anchors")
    rows = table.select("row", "id", "label", "whole")
    broadcast: Callable = vectors.sparkSession.sparkContext.broadcast
    parts = []
    # One row per slab, and each stands for millions of components.
    for slab in numbered.select("slab").distinct().orderBy("slab").toLocalIterator():
        taken = numbered.filter(F.col("slab") == slab.slab).select("row", "id", "label", "whole").toArrow()
        anchors = Anchors(rows_of(taken, width), primes, n_positives, n_negatives, low, high, per)
        found = _best_of(_positives(rows, broadcast(anchors)), ["anchor"], n_positives).toArrow()
        a, k = found.column("anchor").to_numpy(), found.column("rank").to_numpy() - 1
        anchors.positive_score[a, k] = found.column("score").to_numpy()
        anchors.positive_null[a, k] = found.column("id").is_null().to_numpy()
        anchors.positive_id[a, k] = found.column("id").fill_null(0).to_numpy()
        chosen = _best_of(_negatives(rows, broadcast(anchors)), ["anchor", "place"], n_negatives)
        parts.append(written(chosen.drop("anchor", "place").withColumnsRenamed({"id": "negative_id", "score": "negative_score"}), "negatives"))
    columns = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    if not parts:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*columns)


def _positives(rows: DataFrame, slab) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = slab.value.positives(batches)
        yield pa.RecordBatch.from_arrays([pa.array(best.list), pa.array(best.score), _ids(best.id, best.null)], ["anchor", "score", "id"])

    return rows.mapInArrow(search, "anchor long, score long, id long")


def _negatives(rows: DataFrame, slab) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: Anchors = slab.value
        best = mine.negatives(batches)
        a, k = best.list // mine.n_positives, best.list % mine.n_positives
        columns = {
            "anchor": pa.array(a),
            "place": pa.array(k),
            "score": pa.array(best.score),
            "id": _ids(best.id, best.null),
            "anchor_id": _ids(mine.rows.id[a], mine.rows.null[a]),
            "positive_id": _ids(mine.positive_id[a, k], mine.positive_null[a, k]),
            "positive_score": pa.array(mine.positive_score[a, k]),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(search, "anchor long, place long, score long, id long, anchor_id long, positive_id long, positive_score long")
