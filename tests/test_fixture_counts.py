"""The snapshot pair with known counts (every scale of the driver's tables that is small)."""

import pytest
from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.functions.hashing import with_row_hash
from snapledger.plans.apply import apply_cdc

# Inserts, updates, deletes, unchanged, duplicate inserts, duplicate updates, key errors.
EXPECTED = {
    "sf0.001": (126, 180, 80, 1076, 30, 37, 15),
    "sf0.01": (1256, 1804, 785, 10790, 290, 351, 140),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_counters(spark, sf):
    o = spark.read.parquet(f"/root/testdata/{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("k"),
        F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("pk"),
        "o_custkey", "o_orderstatus",
    )

    def part(n, **replaced):
        return o.where(F.col("k") % n == 0).withColumns(replaced).drop("k")

    staging = o.where("k % 17 <> 0").drop("k")
    for extra in (
        part(97), part(101, o_orderstatus=F.lit("Z")), part(211, pk=F.lit(None).cast("string")), part(223, pk=F.lit("")),
    ):
        staging = staging.unionByName(extra)
    active = o.where("k % 11 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))
    ).drop("k")
    target = with_row_hash(active).withColumn("is_active", F.lit(True)).unionByName(
        with_row_hash(part(13, o_orderstatus=F.lit("H"))).withColumn("is_active", F.lit(False))
    )
    target = target.select(
        "row_hash", F.lit("2025-01-01").cast("timestamp_ntz").alias("start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("end_ts"), "is_active", F.lit("I").alias("cdc_operation"),
        "pk", "o_custkey", "o_orderstatus",
    )
    result = apply_cdc(staging, target, EntityConfig(1, "Order", "s", "t", "pk"), "2026-01-01 00:00:00")
    assert tuple(result.metrics.first()) == EXPECTED[sf]
