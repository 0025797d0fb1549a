"""Change detection between a snapshot with ``row_hash`` and the active slice of its target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import key_text, ts_literal
from snapledger.operators.keys import active, key_summary
from snapledger.operators.skew import flag_keys
from snapledger.session import shared_dir

# The classes a key can fall into.
INSERT, UPDATE, UNCHANGED, DELETE, BLOCKED = "I", "U", "N", "D", "BLOCKED"


def rows_of_class(src: DataFrame, tgt: DataFrame, pk: str, cdc_class: str) -> DataFrame:
    """Rows of the snapshot whose key is in a class. The keys are told apart with narrow columns
    first and written; only then are the rows of the wanted ones fetched, without an exchange if the
    keys are few."""
    keys = classify(src, tgt, pk).where(F.col("cdc_class") == cdc_class).select(pk)
    return flag_keys(src, keys, pk, "_wanted").where("_wanted").select(*src.columns)


def detect_inserts(src: DataFrame, tgt: DataFrame, pk: str) -> DataFrame:
    """Unique valid rows whose key has no active version. A key with closed versions only counts
    as new again."""
    return rows_of_class(src, tgt, pk, INSERT)


def detect_updates(src: DataFrame, tgt: DataFrame, pk: str) -> DataFrame:
    """Unique valid rows whose active version has another hash."""
    return rows_of_class(src, tgt, pk, UPDATE)


def detect_unchanged(src: DataFrame, tgt: DataFrame, pk: str) -> DataFrame:
    """Unique valid rows whose active version has the same hash."""
    return rows_of_class(src, tgt, pk, UNCHANGED)


def snapshot_keys(src: DataFrame, pk: str) -> DataFrame:
    """All keys of the snapshot, repeated ones included, once each."""
    return src.where(F.col(pk).isNotNull()).select(pk).distinct()


def detect_deletes(src: DataFrame, tgt: DataFrame, pk: str) -> DataFrame:
    """Active rows whose key does not occur in the snapshot at all."""
    return active(tgt).join(snapshot_keys(src, pk), pk, "left_anti").select(*tgt.columns)


def frozen_rows(src: DataFrame, tgt: DataFrame, pk: str) -> DataFrame:
    """Active rows whose key is repeated in the snapshot: neither updated nor deleted."""
    repeated = (
        src.where(F.col(pk).isNotNull() & (key_text(pk) != ""))
        .groupBy(pk)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        .select(pk)
    )
    return active(tgt).join(repeated, pk, "left_semi").select(*tgt.columns)


def change_class(pk: str, n_rows: Column, in_target: Column, new_hash: Column, old_hash: Column) -> Column:
    """Class of a key after a full outer join; ``n_rows`` is NULL where the snapshot lacks it."""
    return (
        F.when(n_rows.isNull(), DELETE)
        .when((n_rows > 1) | (key_text(pk) == ""), BLOCKED)
        .when(~in_target, INSERT)
        .when(new_hash != old_hash, UPDATE)
        .otherwise(UNCHANGED)
    )


def classify(src: DataFrame, tgt: DataFrame, pk: str, *carried: str, hashes: bool = False) -> DataFrame:
    """Every key of the snapshot or the active slice with its class; narrow columns only, and the
    ``carried`` columns of the active slice. ``hashes`` adds ``new_hash`` (NULL if the rows of the key
    differ or the snapshot lacks it) and ``old_hash``.

    One exchange per side: the per-key aggregate is already partitioned as the join needs it, and
    the scan of the target reads the key, its hash and its end time, nothing else.
    """
    new = key_summary(src, pk)
    old = active(tgt).select(
        pk, F.col("row_hash").alias("_old_hash"), F.col("end_ts").alias("old_end_ts"), F.lit(True).alias("in_target"), *carried
    )
    in_target = F.coalesce(F.col("in_target"), F.lit(False))
    return new.join(old, pk, "full_outer").select(
        pk,
        change_class(pk, F.col("n_rows"), in_target, F.col("only_hash"), F.col("_old_hash")).alias("cdc_class"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("is_conflict", F.lit(False)).alias("is_conflict"),
        in_target.alias("in_target"),
        "old_end_ts",
        *carried,
        *([F.col("only_hash").alias("new_hash"), F.col("_old_hash").alias("old_hash")] if hashes else []),
    )


def update_ts(updates: DataFrame, pk: str, run_ts, tie_break: bool = False) -> DataFrame:
    """``update_ts`` per row: ``run_ts``, or with ``tie_break`` ``run_ts`` plus the row's rank in
    key order (from 0) in microseconds.

    The rank is taken in two levels, since one global ``row_number`` would be a single task: rows
    are range-partitioned and sorted by key, numbered inside their partition, and shifted by the
    size of the partitions before. The numbered rows are checkpointed so that both levels see the
    same partitions. The table of partition sizes has one row per partition.
    """
    if not tie_break:
        return updates.withColumn("update_ts", ts_literal(run_ts))
    shared_dir(updates.sparkSession)
    ordered = (
        updates.withColumn("_k", key_text(pk))
        .repartitionByRange(F.col("_k"))
        .sortWithinPartitions("_k")
        .withColumn("_id", F.monotonically_increasing_id())
        .drop("_k")
        .checkpoint()
    )
    numbered = ordered.select(
        "*",
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    rank = F.col("_offset") + F.col("_pos")
    seconds = (rank.cast("decimal(18,0)") / 1000000).cast("decimal(18,6)")
    zero = F.lit(0)
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn("update_ts", ts_literal(run_ts) + F.make_dt_interval(zero, zero, zero, seconds))
        .select(*updates.columns, "update_ts")
    )
