"""Change feed between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.operators.skew import expand_copies, match_keys


def change_feed(before: DataFrame, after: DataFrame, pk: str) -> DataFrame:
    """Rows that went or came, with ``action`` (INSERT or DELETE), ``is_update`` and ``row_id``.

    A changed row shows up as a DELETE and an INSERT, both with ``is_update``. Rows are netted by
    their whole contents instead of being paired by key, so a key that occurs many times costs one
    aggregated row per distinct content and never a product of its rows.
    """
    columns = after.columns
    signed = before.select(*columns, F.lit(-1).cast("long").alias("_sign")).unionByName(
        after.select(*columns, F.lit(1).cast("long").alias("_sign"))
    )
    net = (
        signed.groupBy(*columns)
        .agg(F.sum("_sign").alias("_net"))
        .where(F.col("_net") != 0)
    )
    per_key = net.groupBy(pk).agg(
        F.count(F.lit(1)).alias("_weight"), ((F.min("_net") < 0) & (F.max("_net") > 0)).alias("is_update")
    )
    with_key = match_keys(net.where(F.col(pk).isNotNull()), per_key.where(F.col(pk).isNotNull()), pk, "_weight")
    without_key = net.where(F.col(pk).isNull()).select(
        *net.columns, F.lit(0).cast("long").alias("_weight"), F.lit(False).alias("is_update")
    )
    rows = expand_copies(
        with_key.unionByName(without_key).withColumn("_copies", F.abs("_net")), copies="_copies"
    )
    return rows.select(
        *columns,
        F.when(F.col("_net") > 0, "INSERT").otherwise("DELETE").alias("action"),
        "is_update",
        F.sha2(F.col(pk).cast("string"), 256).alias("row_id"),
    )

