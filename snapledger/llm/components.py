"""Connected components by alternating large and small stars, and links inside bounded groups."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import small_side, written


def starred(edges: DataFrame) -> DataFrame:
    """One round: link greater neighbours, then smaller ones, to the smallest node of the neighbourhood.

    Both sides of a join are written tables: a node with very many links makes a partition that is
    split at run time, which an aggregate in the same stage would prevent.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
    large = both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = written(large.distinct(), "large-star")
    least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    small = large.join(least, "a")
    moved = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the smallest node that links reach.

    The links may come in any direction and more than once; those of a node with itself count for
    nothing. Each round is written to the shared folder. Rounds grow with the logarithm of the
    longest chain, and no round holds more rows than the links given.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = written(edges, "links"), None
    while True:
        new = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (new.n, new.h) == state or new.n == 0:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        state = new.n, new.h
        edges = written(starred(edges), "stars")


def paired_chunks(rows: DataFrame, keys: list[str], unit: str, limit: int, rows_per_task: int) -> DataFrame:
    """``rows`` dealt to tasks so that every two rows with equal keys meet, whatever the group's size.

    A group of up to ``limit`` rows meets in one place. A larger one is cut into chunks by the hash
    of ``unit``, and each pair of chunks has a ``shard`` of its own, so at most about twice ``limit``
    rows: ``low`` and ``high`` name the pair, ``in_low`` and ``in_high`` say to which of them a row
    belongs. The rows of the other groups, which are not copied, are gathered to shards of about
    ``rows_per_task`` rows. ``rows`` should be a written table.
    """
    large = written(rows.groupBy(*keys).count().filter(F.col("count") > limit), "large")
    # At most one group in ``limit`` rows is large, and a row of this table is short.
    sized = rows.join(small_side(large, large.count()), keys, "left")
    chunks = F.coalesce(F.ceil(F.col("count") / limit), F.lit(1)).cast("long")
    dealt = sized.withColumn("_chunks", chunks).withColumn("_own", F.pmod(F.xxhash64(unit), F.col("_chunks")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("_own", "_other")).withColumn("high", F.greatest("_own", "_other"))
    shards = max(1, math.ceil(rows.count() / rows_per_task))
    place = F.xxhash64(*keys, "low", "high")
    return (
        dealt.withColumn("in_low", F.col("_own") == F.col("low"))
        .withColumn("in_high", F.col("_own") == F.col("high"))
        .withColumn("shard", F.when(F.col("_chunks") > 1, place).otherwise(F.pmod(place, F.lit(shards))))
        .drop("count", "_chunks", "_own", "_other")
    )


def runs(*columns: np.ndarray) -> list[np.ndarray]:
    """Places of the rows that agree in all columns, one array per group."""
    order = np.lexsort(columns)
    if not len(order):
        return []
    change = np.zeros(len(order) - 1, bool)
    for column in columns:
        change |= column[order][1:] != column[order][:-1]
    return np.split(order, np.flatnonzero(change) + 1)


class Forest:
    """Joins places that are linked and keeps one link for each join: never more links than places."""

    def __init__(self, size: int):
        self.parent = np.arange(size)
        self.links: list[np.ndarray] = []

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while True:
            above = self.parent[found]
            if (above == found).all():
                self.parent[places] = found
                return found
            found = above

    def join(self, places: np.ndarray) -> None:
        roots = np.unique(self.roots(places))
        if len(roots) > 1:
            self.parent[roots[1:]] = roots[0]
            self.links.append(np.stack([np.full(len(roots) - 1, roots[0]), roots[1:]]))

    def pairs(self) -> np.ndarray:
        return np.concatenate(self.links, axis=1) if self.links else np.empty((2, 0), np.int64)
