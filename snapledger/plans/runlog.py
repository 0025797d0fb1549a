"""Run and entity logs as table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.columns import ts_literal
from snapledger.sources.store import COUNTERS

# The states of a run.
RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"


def next_run_id(run_log: DataFrame) -> DataFrame:
    """One row with the id after the highest one, 1 for an empty log."""
    return run_log.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("long").alias("next_run_id"))


def run_status(run_events: DataFrame) -> DataFrame:
    """Current state of every run from its events: the last status, the start and the end."""
    ended = F.col("status") != RUNNING
    return run_events.groupBy("run_id").agg(
        F.min("ts").alias("start_ts"),
        F.max(F.when(ended, F.col("ts"))).alias("end_ts"),
        F.max_by("status", "seq").alias("status"),
    )


def entity_log_row(metrics: DataFrame, run_id: int, entity_name: str, start_ts, end_ts) -> DataFrame:
    """The counters of one entity run as a row of the entity log."""
    return metrics.select(
        F.lit(run_id).cast("long").alias("run_id"),
        ts_literal(start_ts).alias("start_ts"),
        ts_literal(end_ts).alias("end_ts"),
        F.lit(entity_name).alias("entity_name"),
        *[F.col(c).cast("long").alias(c) for c in COUNTERS],
    )


def rollup_run(entity_log: DataFrame) -> DataFrame:
    """Counters per run, summed over its entities in one pass."""
    return entity_log.groupBy("run_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS]
    )


def run_log(run_events: DataFrame, entity_log: DataFrame) -> DataFrame:
    """The run log: state and totals per run. Only completed runs carry totals."""
    totals = rollup_run(entity_log)
    joined = run_status(run_events).join(totals, "run_id", "left")
    done = F.col("status") == COMPLETED
    return joined.select(
        "run_id",
        "start_ts",
        "end_ts",
        *[F.when(done, F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c) for c in COUNTERS],
        "status",
    )
