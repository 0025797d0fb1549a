"""Shape of the physical plans: what is scanned, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import workload.snapshots as w
from compare import SMALL
from snapledger.functions.hashing import with_row_hash
from snapledger.operators import changes as ch
from snapledger.operators import quality
from snapledger.operators.keys import active, key_summary
from snapledger.plans.apply import apply_cdc, next_rows
from snapledger.plans.run import ended_keys, opened_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def pair(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    w.orders_staging(spark, SMALL).write.parquet(f"{root}/s")
    w.orders_target(spark, SMALL).write.parquet(f"{root}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(f"{root}/s"), spark.read.parquet(f"{root}/t")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_apply_has_one_exchange_per_side(pair):
    src, tgt = pair
    text = plan(next_rows(with_row_hash(src), active(tgt), w.orders_config(), w.RUN_TS))
    assert exchanges(text) == 2 and "Python" not in text and "Nested" not in text


@pytest.mark.parametrize("update, joined", [("HISTORY", 0), ("OVERWRITE", 2)])
def test_a_target_with_few_changes_has_no_exchange_of_whole_rows(pair, update, joined):
    """Where updates overwrite, the old and new rows of updated keys alone are exchanged."""
    src, tgt = pair
    text = plan(apply_cdc(src, tgt, w.orders_config(update), w.RUN_TS).target)
    assert exchanges(text) == joined and "Nested" not in text
    assert exchanges(plan(apply_cdc(src, None, w.orders_config(update), w.RUN_TS).target)) == 0


def test_classify_reads_narrow_columns_of_the_target(pair):
    src, tgt = pair
    text = plan(ch.classify(with_row_hash(src), tgt, w.ORDERS_PK))
    assert exchanges(text) == 2
    scans = re.findall(r"ReadSchema: struct<([^>\n]*)", text)
    assert len(scans) == 2
    old = next(s for s in scans if "is_active" in s)
    assert {c.split(":")[0] for c in old.split(",")} == {"row_hash", "end_ts", "is_active", w.ORDERS_PK}
    assert "EqualTo(is_active,true)" in text


def test_few_changes_need_no_exchange(pair):
    src, tgt = pair
    slice_ = active(tgt).withColumn("opened_version", F.lit(7).cast("long"))
    moved = ch.classify(with_row_hash(src), slice_, w.ORDERS_PK, "opened_version").where("cdc_class <> 'N'").checkpoint()
    text = plan(opened_rows(src, moved, tgt.schema, w.orders_config(), w.RUN_TS, keys_fit=True))
    assert exchanges(text) == 0 and text.count("BroadcastHashJoin") == 1
    assert exchanges(plan(ended_keys(moved, w.orders_config(), w.RUN_TS))) == 0


def test_a_first_load_has_no_wide_exchange(pair):
    src, tgt = pair
    none = active(tgt).where("false").withColumn("opened_version", F.lit(7).cast("long"))
    moved = ch.classify(with_row_hash(src), none, w.ORDERS_PK, "opened_version").checkpoint()
    text = plan(opened_rows(src, moved, tgt.schema, w.orders_config(), w.RUN_TS, all_new=True, blocked_fit=True))
    assert exchanges(text) == 0 and "Aggregate" not in text and "LeftAnti" in text


def test_rows_are_told_apart_without_sorting_them(pair):
    src, tgt = pair
    text = plan(ch.classify(with_row_hash(src), tgt, w.ORDERS_PK))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_deletes_fold_the_keys_before_the_exchange(pair):
    src, tgt = pair
    text = plan(ch.detect_deletes(with_row_hash(src), tgt, w.ORDERS_PK))
    assert "LeftAnti" in text and text.count("HashAggregate") == 2


def test_errors_broadcast_only_the_bounded_heavy_keys(pair):
    src, _ = pair
    text = plan(quality.detect_errors(with_row_hash(src), w.ORDERS_PK, 1, "Order", w.RUN_TS))
    assert "TakeOrderedAndProject" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert "SortAggregate" not in text and text.count("BroadcastHashJoin") <= 2


def test_hot_key_is_folded_on_the_map_side(spark):
    """A key that holds a third of all rows leaves each map task as one row."""
    rows = spark.range(0, 300_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id) end as id", "id % 5 as v"
    )
    summary = key_summary(with_row_hash(rows), "id")
    text = plan(summary)
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert summary.where("n_rows > 1").collect()[0].n_rows == 100_000
    errors = quality.detect_errors(with_row_hash(rows), "id", 1, "E", "2026-01-01")
    assert quality.error_counts(errors).first().asDict() == {
        "duplicate_inserts": 100_000, "duplicate_updates": 100_000, "key_errors": 0,
    }
