"""State of a versioned target at a point of time, checks of its intervals, and facts joined to versions.

A version holds from ``start_ts`` up to, but not at, ``end_ts``; without an end it holds on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import ts_literal
from snapledger.operators.skew import ROWS_PER_TASK

# What can be wrong with the intervals of a key.
OVERLAP, GAP, EMPTY = "OVERLAP", "GAP", "EMPTY"


def holds_at(ts, start: str = "start_ts", end: str = "end_ts") -> Column:
    """Whether a version holds at a time. Both bounds are compared plainly, so they reach the scan."""
    at = ts_literal(ts)
    return (F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at))


def as_of(target: DataFrame, ts) -> DataFrame:
    """The versions that held at a time, active or closed since."""
    return target.where(holds_at(ts))


def interval_errors(target: DataFrame, pk: str) -> DataFrame:
    """Versions that do not follow their predecessor: (key, ``start_ts``, ``previous_end``, ``error``).

    OVERLAP: it starts before the one before it, in order of start, has ended. GAP: it was opened by an
    update but starts later than the one before ended. EMPTY: it ends at or before its own start. One window per key;
    a key has as many rows as it had versions.
    """
    order = Window.partitionBy(pk).orderBy("start_ts", F.asc_nulls_last("end_ts"))
    previous = F.lag(F.struct(F.col("end_ts").alias("end_ts"))).over(order)
    narrow = target.select(pk, "start_ts", "end_ts", "cdc_operation").withColumn("_before", previous)
    start, ended = F.col("start_ts"), F.col("_before.end_ts")
    error = (
        F.when(F.col("end_ts") <= start, EMPTY)
        .when(F.col("_before").isNotNull() & (ended.isNull() | (ended > start)), OVERLAP)
        .when(F.col("_before").isNotNull() & (F.col("cdc_operation") == "U") & (ended < start), GAP)
    )
    return narrow.select(pk, "start_ts", ended.alias("previous_end"), error.alias("error")).where("error is not null")


def as_of_join(facts: DataFrame, target: DataFrame, key: str, at: str, pk: str, columns: list[str]) -> DataFrame:
    """``facts`` with the ``columns`` of the version of their key that held at their time ``at``; NULL if none did.

    Facts and versions are put into one table, and along the time of a key the last version before a fact
    is carried to it: a sort per key in place of a range join. Versions of a key must not overlap (see
    :func:`interval_errors`). At equal times a version comes before the facts, and of two versions that start together the one
    that holds on counts. Facts without key or time get NULLs. A key with more facts than a task takes is
    dealt to several tasks, and its versions go to each of them.
    """
    names = facts.columns
    kind = target.schema[pk].dataType
    fact_key, when = F.col(f"`{key}`").cast(kind), F.col(f"`{at}`").cast("timestamp_ntz")
    heavy = (
        facts.select(fact_key.alias("_key")).where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > ROWS_PER_TASK).select("_key", F.ceil(F.col("_n") / F.lit(ROWS_PER_TASK)).cast("long").alias("_deals"))
    )
    # At most one key in a million facts is heavy.
    rows = facts.select(fact_key.alias("_key"), when.alias("_at"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_fact"))
    rows = rows.join(F.broadcast(heavy), "_key", "left")
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("_deals", F.lit(1)))
    alone = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    rows = rows.select("_key", F.when(F.col("_key").isNull(), alone).otherwise(spread).alias("_deal"), "_at", "_fact")
    held = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col("end_ts").alias("_end")).alias("_held")
    versions = target.where(F.col(pk).isNotNull()).select(F.col(pk).alias("_key"), F.col("start_ts").alias("_at"), held)
    versions = versions.join(F.broadcast(heavy), "_key", "left").select(
        "_key", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_deals", F.lit(1)) - 1)).alias("_deal"), "_at", "_held"
    )
    both = rows.unionByName(versions, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_deal").orderBy("_at", F.col("_fact").isNotNull(), F.asc_nulls_last("_held._end"))
    carried = F.last("_held", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_last", carried).where(F.col("_fact").isNotNull())
    holds = F.col("_at").isNotNull() & (F.col("_last._end").isNull() | (F.col("_last._end") > F.col("_at")))
    values = [F.when(holds, F.col(f"_last.c{i}")).alias(c) for i, c in enumerate(columns)]
    return found.select(*[F.col(f"_fact.`{c}`").alias(c) for c in names], *values)
