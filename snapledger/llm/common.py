"""Helpers that several operators share: written intermediate tables and a distributed running total."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.session import new_dir

#: Bits that monotonically_increasing_id() leaves for the position inside a partition (a fixed value).
POSITION_BITS = 33

#: A table of at most so many short rows may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000

#: Bytes of text behind a bucket that goes into one call of a function as a whole.
BUCKET_BYTES = 64 << 20


def give_back() -> None:
    """Return unused memory: a worker outlives its task, and the next stage needs what it holds. Arrow keeps what
    its pool had, and the C library what its heap had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(function: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``function`` of whole groups; what a group has needed beside its answer is returned before the next one comes."""

    def call(*tables: pa.Table) -> pa.Table:
        out = function(*tables)
        give_back()
        return out

    # Spark tells from the signature how many tables a function takes.
    return (lambda own, found: call(own, found)) if function.__code__.co_argcount == 2 else (lambda own: call(own))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: lineage ends here, and a lost executor loses nothing."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the bound, else as it is."""
    return F.broadcast(df) if rows <= bound else df


def bucket_count(spark: SparkSession, total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for so many bytes: as many as the session shuffles to, more if one would get over ``bucket_bytes``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // bucket_bytes))


def as_text(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def running_total(df: DataFrame, order: list[str], weight: str | None = None) -> DataFrame:
    """``df`` with ``start``: the sum of ``weight`` (rows, if None) over all rows before in the total order.

    Rows are range-partitioned and sorted, so no task holds more than a range. ``order`` must be
    unique up to rows that are equal in every column. The sorted rows are written with their
    partition and position: neither can change afterwards, however often a task is repeated. Only
    one total per partition is then added up in one place. ``df`` should be a written table, since
    the choice of range bounds reads it once more.
    """
    value = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", POSITION_BITS))
    )
    placed = written(placed, "sorted")
    totals = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    if weight is None:
        inside = F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    else:
        earlier = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    # One row per partition of the sort: the side to broadcast is bounded by the number of tasks.
    out = placed.withColumn("_inside", inside).join(F.broadcast(offsets), "_part")
    return out.withColumn("start", F.col("_inside") + F.col("_before")).drop("_at", "_part", "_inside", "_before")
