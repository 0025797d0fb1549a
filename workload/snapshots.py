"""Snapshot pairs derived from the whole driver tables.

Orders: the target is the order book as it stood at the cut-off (later orders are unknown, recent
ones still open), the snapshot is the source today (orders before the retention date are gone).
Deliveries with faults come on top: resent rows, a second version of a key, rows that lost their
key. Every row of the table takes part. Customers follow the same scheme by market segment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.functions.columns import CONTROL_COLUMNS, ts_literal
from snapledger.functions.hashing import with_row_hash

RUN_TS = "2026-01-01 00:00:00"
LOADED_TS = "2025-01-01 00:00:00"
LATER_TS = "2027-01-01 00:00:00"
CLOSED_FROM_TS = "2024-01-01 00:00:00"

RETAINED_FROM = "1995-07-01 00:00:00"
OPEN_SINCE = "2000-07-01 00:00:00"
CUT_OFF = "2001-01-01 00:00:00"

ORDERS_PK = "order_key"
CUSTOMER_PK = "customer_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), 9, "0"))


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").alias(column)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text_key("O", "o_orderkey").alias(ORDERS_PK),
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def _variants(df: DataFrame, pk: str, status: str, variants: list[tuple[Column, Column, Column]]) -> DataFrame:
    """One scan, each row written out once per variant ``(condition, key, status)`` that holds. Rows are
    written out with the number of a variant and then tested, so that all of it is compiled."""

    def of_variant(values: list[Column]) -> Column:
        chosen = F.when(F.col("_v") == 0, values[0])
        for number, value in enumerate(values[1:], start=1):
            chosen = chosen.when(F.col("_v") == number, value)
        return chosen

    conditions, new_keys, statuses = zip(*variants)
    any_holds = reduce(lambda a, b: a | b, conditions)
    numbers = F.explode(F.array(*[F.lit(number) for number in range(len(variants))]))
    out = df.where(any_holds).withColumn("_v", numbers).where(of_variant(conditions))
    replaced = {pk: of_variant(new_keys), status: of_variant(statuses)}
    return out.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns])


def orders_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's delivery: the orders since the retention date, with faults."""
    return _delivered(spark, sf_dir, F.col("o_orderdate") >= ts_literal(RETAINED_FROM))


def orders_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of the whole order book, with the same faults."""
    return _delivered(spark, sf_dir, F.lit(True))


def _delivered(spark: SparkSession, sf_dir: str, here: Column) -> DataFrame:
    df = orders(spark, sf_dir)
    key, status, priority = F.col(ORDERS_PK), F.col("o_orderstatus"), F.col("o_orderpriority")
    partial = here & (status == "P")
    return _variants(
        df,
        ORDERS_PK,
        "o_orderstatus",
        [
            (here, key, status),
            (partial & (priority == "1-URGENT"), key, status),
            (partial & (priority == "2-HIGH"), key, F.lit("Z")),
            (partial & (priority == "4-NOT SPECIFIED"), F.lit(None).cast("string"), status),
            (partial & (priority == "5-LOW"), F.lit(""), status),
        ],
    )


def orders_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as they once stood, recent ones still open, as a snapshot."""
    still_open = F.col("o_orderdate") >= ts_literal(OPEN_SINCE)
    return orders(spark, sf_dir).withColumn(
        "o_orderstatus", F.when(still_open, F.lit("O")).otherwise(F.col("o_orderstatus"))
    )


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order book at the cut-off, as a snapshot."""
    return orders_once(spark, sf_dir).where(F.col("o_orderdate") < ts_literal(CUT_OFF))


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order book at the cut-off with its closed versions, as a target."""
    return _as_target(spark, sf_dir, orders_before(spark, sf_dir))


def whole_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as they once stood with their closed versions, as a target."""
    return _as_target(spark, sf_dir, orders_once(spark, sf_dir))


def _as_target(spark: SparkSession, sf_dir: str, snapshot: DataFrame) -> DataFrame:
    current = with_row_hash(snapshot).select(
        "*",
        ts_literal(LOADED_TS).alias("start_ts"),
        F.lit(None).cast("timestamp_ntz").alias("end_ts"),
        F.lit(True).alias("is_active"),
        F.lit("I").alias("cdc_operation"),
    )
    older = with_row_hash(
        orders(spark, sf_dir)
        .where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "3-MEDIUM"))
        .withColumn("o_orderstatus", F.lit("H"))
    ).select(
        "*",
        ts_literal(CLOSED_FROM_TS).alias("start_ts"),
        ts_literal(LOADED_TS).alias("end_ts"),
        F.lit(False).alias("is_active"),
        F.lit("I").alias("cdc_operation"),
    )
    business = [c for c in current.columns if c not in CONTROL_COLUMNS]
    return current.unionByName(older).select(*CONTROL_COLUMNS, *business)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text_key("C", "c_custkey").alias(CUSTOMER_PK), "c_name", "c_nationkey", money("c_acctbal"), "c_mktsegment"
    )


def customers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All segments but the one that joined later; debts were booked as zero."""
    return (
        customers(spark, sf_dir)
        .where(F.col("c_mktsegment") != "AUTOMOBILE")
        .withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0).cast("decimal(18,2)")))
    )


def customers_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All segments but the one that left; rich machinery customers come twice, rich households
    have lost their key."""
    return _customers_delivered(spark, sf_dir, F.col("c_mktsegment") != "FURNITURE")


def customers_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of all customers, with the same faults."""
    return _customers_delivered(spark, sf_dir, F.lit(True))


def _customers_delivered(spark: SparkSession, sf_dir: str, here: Column) -> DataFrame:
    key, segment = F.col(CUSTOMER_PK), F.col("c_mktsegment")
    rich = F.col("c_acctbal") > 9000
    return _variants(
        customers(spark, sf_dir),
        CUSTOMER_PK,
        "c_mktsegment",
        [
            (here, key, segment),
            (rich & (segment == "MACHINERY"), key, segment),
            (rich & (segment == "HOUSEHOLD"), F.lit(""), segment),
            (rich & (segment == "BUILDING"), F.lit(None).cast("string"), segment),
        ],
    )


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines keyed by order and line number. The table repeats such keys by itself."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(text_key("L", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_key"),
        "l_partkey",
        "l_suppkey",
        money("l_quantity"),
        money("l_extendedprice"),
        "l_linestatus",
        "l_shipdate",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents keyed by language: a handful of keys hold all rows."""
    return table(spark, sf_dir, "documents").select("lang", "text")


def orders_config(update: str = "HISTORY", delete: str = "SOFT", **over) -> EntityConfig:
    return EntityConfig(
        over.pop("config_id", 1),
        "Order",
        "STAGING.S_Order",
        "TARGET.T_Order",
        ORDERS_PK,
        delete_strategy=delete,
        update_strategy=update,
        **over,
    )


def customers_config(update: str = "HISTORY", delete: str = "SOFT", **over) -> EntityConfig:
    return EntityConfig(
        over.pop("config_id", 2),
        "Customer",
        "STAGING.S_Customer",
        "TARGET.T_Customer",
        CUSTOMER_PK,
        delete_strategy=delete,
        update_strategy=update,
        **over,
    )


# Run logs of two variants, derived from the tables: one run per order and one per user.


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order: first to last shipment, one inserted row per line."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("run_id"))
        .agg(
            F.min("l_shipdate").alias("start_ts"),
            F.max("l_shipdate").alias("end_ts"),
            F.count(F.lit(1)).alias("rows_inserted"),
        )
    )


def user_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user: first to last event, one inserted row per event."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("run_id"))
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.count(F.lit(1)).alias("rows_inserted"),
        )
    )


def user_run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events: errors fail a run, purchases complete it, anything else leaves it running."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "purchase", "COMPLETED").otherwise("RUNNING")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), status.alias("status"), "ts"
    )


def order_entity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity-log row per order and return flag, counters from the lines."""
    def lines(condition: Column) -> Column:
        return F.count_if(condition)

    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("entity_name"))
        .agg(
            lines(F.col("l_linestatus") == "O").alias("rows_inserted"),
            lines(F.col("l_linestatus") == "F").alias("rows_updated"),
            lines(F.col("l_discount") > 0.05).alias("rows_deleted"),
            lines(F.col("l_tax") > 0.04).alias("rows_unchanged"),
            lines(F.col("l_quantity") > 40).alias("duplicate_inserts"),
            lines(F.col("l_quantity") < 5).alias("duplicate_updates"),
            F.sum(F.when(F.col("l_linenumber") > 5, F.lit(1))).alias("key_errors"),
        )
    )
