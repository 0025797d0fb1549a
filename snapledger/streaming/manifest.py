"""Snapshots as a stream.

A run needs one *whole* snapshot, so the stream carries manifest rows: one row per snapshot whose
directory is complete. A streaming query moves new rows into a queue table exactly once; its
checkpoint is the offset, so a second call without new snapshots finds nothing. The queued
snapshots are then run one by one in order of their id. The commit record of a run names its
snapshot, so a snapshot counts as done exactly when its run is committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.plans.run import COMPLETED, Clock, Limits, RunResult, run, utc_now
from snapledger.session import shared_dir
from snapledger.sources import fs
from snapledger.sources.rows import one_row
from snapledger.sources.store import VersionStore

MANIFEST_SCHEMA = "snapshot_id bigint, entity_name string, path string"


def announce(spark: SparkSession, manifest_dir: str, snapshot_id: int, entity_name: str, path: str) -> None:
    """Add the manifest row of a finished snapshot directory."""
    row = one_row(spark, MANIFEST_SCHEMA, (snapshot_id, entity_name, path))
    row.write.mode("append").parquet(manifest_dir)


def consume(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint: str) -> int:
    """Move all new rows of a parquet directory into a parquet table, once, and advance the offset.
    Returns how many rows were new."""
    query = (
        spark.readStream.schema(schema)
        .parquet(source_dir)
        .writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def pending(spark: SparkSession, queue_dir: str, store: VersionStore, cfg: EntityConfig) -> list[tuple[int, str]]:
    """Queued snapshots of the entity that no committed run has read, by id; one row per snapshot.
    Those that are done are left out by a join; only what is still to do reaches the driver."""
    if not fs.exists(spark, queue_dir):
        return []
    queued = (
        spark.read.schema(MANIFEST_SCHEMA)
        .parquet(queue_dir)
        .where(F.col("entity_name") == cfg.entity_name)
        .select("snapshot_id", "path")
        .distinct()
    )
    done = store.commits(cfg.entity_name).where("snapshot_id is not null").select("snapshot_id")
    waiting = queued.join(done, "snapshot_id", "left_anti").orderBy("snapshot_id", "path")
    return [(r.snapshot_id, r.path) for r in waiting.collect()]


def stream_cdc(
    spark: SparkSession,
    manifest_dir: str,
    cfg: EntityConfig,
    store: VersionStore,
    checkpoint: str,
    clock: Clock = utc_now,
    limits: Limits = Limits(),
) -> list[RunResult]:
    """Run the entity once for every snapshot that was announced since the last call."""
    shared_dir(spark)
    queue_dir = f"{checkpoint}/queue"
    consume(spark, manifest_dir, MANIFEST_SCHEMA, queue_dir, f"{checkpoint}/offsets")
    results = []
    for snapshot_id, path in pending(spark, queue_dir, store, cfg):
        snapshot = spark.read.parquet(path)
        source = lambda s, n, df=snapshot: df
        result = run(spark, store, [cfg], source, clock=clock, limits=limits, snapshot_id=snapshot_id)
        results.append(result)
        if result.status != COMPLETED:
            break
    return results


def consume_feed(spark: SparkSession, feed_dir: str, schema, sink_dir: str, checkpoint: str) -> DataFrame:
    """Consume a change feed once and return all that was consumed so far."""
    consume(spark, feed_dir, schema, sink_dir, checkpoint)
    return spark.read.schema(schema).parquet(sink_dir)
