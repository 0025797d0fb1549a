"""Row-level corrections of a snapshot, and loading without change detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators.skew import flag_keys


def _flagged(df: DataFrame, pk: str, keys) -> tuple[DataFrame, Column]:
    """``df`` with a flag for rows whose key is listed. A Python list becomes a literal test, a
    DataFrame of keys is joined."""
    if not isinstance(keys, DataFrame):
        return df, F.coalesce(F.col(pk).isin(list(keys)), F.lit(False))
    return flag_keys(df, keys.toDF(pk), pk, "_listed"), F.col("_listed")


def patch_snapshot(df: DataFrame, pk: str, keys, assignments: dict[str, Column]) -> DataFrame:
    """Rows of the listed keys get new values (each computed from the old row); others stay."""
    flagged, hit = _flagged(df, pk, keys)
    return flagged.select(
        *[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c) for c in df.columns]
    )


def drop_keys(df: DataFrame, pk: str, keys) -> DataFrame:
    """All rows but those of the listed keys. Rows without a key stay."""
    flagged, hit = _flagged(df, pk, keys)
    return flagged.where(~hit).select(*df.columns)


def append_load(loads: list[DataFrame], order_by: str) -> DataFrame:
    """Loads put below each other without any check, as a contrast to a run with change detection.

    Rows of one key keep the order they were read in. The row number in the sort also lets the range
    partitions of the sort split a key that many rows share.
    """
    rows = reduce(lambda a, b: a.unionByName(b), loads)
    return rows.withColumn("_read", F.monotonically_increasing_id()).orderBy(order_by, "_read").drop("_read")
