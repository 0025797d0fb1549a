"""Random snapshots and targets: the plans against the plain statement sequence."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from literal import literal_run
from snapledger.config import EntityConfig
from snapledger.operators.changes import classify
from snapledger.operators.keys import active
from snapledger.plans import apply
from snapledger.plans.apply import apply_cdc, changed_keys, may_broadcast, next_rows, next_rows_of_few
from snapledger.functions.hashing import with_row_hash
from snapledger.plans.run import Limits, ended_keys, opened_rows, run_entity
from snapledger.sources.store import VersionStore
from datetime import datetime

PAIRS = [(u, d) for u in ("HISTORY", "OVERWRITE") for d in ("SOFT", "HARD")]
BROADCAST, JOINED = Limits(), Limits(rows=0, key_bytes=0)
EARLIER, NOW = "2026-01-01 00:00:00", "2026-01-02 00:00:00"


def scenario(seed):
    rnd = random.Random(seed)
    keys = [f"k{i}" for i in range(rnd.randint(3, 25))]
    target = []
    for k in keys:
        for _ in range(rnd.choice([0, 0, 1, 2])):
            target.append((f"{k}/old", 1, 1, False, rnd.choice("IUD"), k, "old"))
        if rnd.random() < 0.7:
            v = rnd.choice("ab")
            target.append((f"{k}/{v}", 1, None, True, rnd.choice("IU"), k, v))
    staging = []
    for k in [*keys, "new1", "new2", "", None]:
        for _ in range(rnd.choice([0, 1, 1, 1, 2, 3])):
            staging.append((k, rnd.choice("abc")))
    return target, staging


def frames(spark, target, staging):
    t = spark.createDataFrame(
        target, "row_hash string, s int, e int, is_active boolean, cdc_operation string, pk string, v string"
    )
    times = {"start_ts": "s", "end_ts": "e"}
    for name, flag in times.items():
        t = t.withColumn(name, F.when(F.col(flag) == 1, F.lit(EARLIER)).cast("timestamp_ntz"))
    t = t.select("row_hash", "start_ts", "end_ts", "is_active", "cdc_operation", "pk", "v")
    s = spark.createDataFrame(staging, "pk string, v string")
    return t, s, s.withColumn("row_hash", F.concat(F.coalesce("pk", F.lit("None")), F.lit("/"), "v"))


def flags(df):
    def flag(name):
        return F.when(F.col(name) == F.lit(EARLIER).cast("timestamp_ntz"), 1).when(F.col(name).isNotNull(), 2)

    rows = df.select("row_hash", flag("start_ts"), flag("end_ts"), "is_active", "cdc_operation", "pk", "v").collect()
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("seed", range(5))
def test_one_plan_equals_the_statement_sequence(spark, seed):
    target, staging = scenario(seed)
    t, s, hashed = frames(spark, target, staging)
    for update, delete in PAIRS:
        cfg = EntityConfig(1, "E", "s", "t", "pk", delete_strategy=delete, update_strategy=update)
        rows = next_rows(hashed, active(t), cfg, NOW).unionByName(t.where(~F.col("is_active")))
        expected = Counter(literal_run(target, staging, update, delete))
        assert flags(rows) == expected, (update, delete)


@pytest.mark.parametrize("fit", [True, False])
@pytest.mark.parametrize("seed", range(6, 8))
def test_opened_rows_and_ended_keys_make_up_the_next_rows(spark, seed, fit):
    target, staging = scenario(seed)
    t, s, _ = frames(spark, target, staging)
    t = with_row_hash(t, columns=["pk", "v"]).select(*t.columns)
    hashed, slice_ = with_row_hash(s), active(t).withColumn("opened_version", F.lit(7).cast("long"))
    for update, delete in PAIRS:
        cfg = EntityConfig(1, "E", "s", "t", "pk", delete_strategy=delete, update_strategy=update)
        changes = classify(hashed, slice_, "pk", "opened_version").where("cdc_class <> 'N'").cache()
        opened = opened_rows(s, changes, t.schema, cfg, NOW, keys_fit=fit)
        ended = ended_keys(changes, cfg, NOW)
        kept = slice_.join(ended, ["pk", "opened_version"], "left_anti").select(*t.columns)
        closed = active(t).join(ended.where("is_kept").select("pk", F.col("end_ts").alias("e"), F.col("cdc_operation").alias("o")), "pk").select(
            "row_hash", "start_ts", F.col("e").alias("end_ts"), F.lit(False).alias("is_active"),
            F.coalesce("o", "cdc_operation").alias("cdc_operation"), "pk", "v",
        )
        after = opened.unionByName(kept).unionByName(closed)
        assert flags(after) == flags(next_rows(hashed, active(t), cfg, NOW)), (update, delete)


@pytest.mark.parametrize("fit", [True, False])
def test_a_first_load_opens_all_rows_that_occur_once(spark, fit):
    _, staging = scenario(9)
    t, s, _ = frames(spark, scenario(9)[0], staging)
    none = active(t).where("false").withColumn("opened_version", F.lit(7).cast("long"))
    hashed = with_row_hash(s)
    changes = classify(hashed, none, "pk", "opened_version").where("cdc_class <> 'N'")
    cfg = EntityConfig(1, "E", "s", "t", "pk")
    opened = opened_rows(s, changes, t.schema, cfg, NOW, all_new=True, blocked_fit=fit)
    assert flags(opened) == flags(next_rows(hashed, none.drop("opened_version"), cfg, NOW))


@pytest.mark.parametrize("update,delete", [PAIRS[0], PAIRS[3]])
def test_stored_runs_agree_whatever_the_size_limits(spark, tmp_path, update, delete):
    """Three snapshots through the store: broadcast only, joins only."""
    cfg = EntityConfig(1, "E", "s", "t", "pk", delete_strategy=delete, update_strategy=update)
    outcomes = []
    for limits in (BROADCAST, JOINED):
        store = VersionStore(spark, str(tmp_path / uuid.uuid4().hex))
        counters = []
        for day, seed in enumerate((21, 22, 23), start=1):
            snapshot = spark.createDataFrame(scenario(seed)[1], "pk string, v string")
            clock = lambda day=day: datetime(2026, 1, day)
            counters.append(run_entity(spark, store, cfg, snapshot, day, clock, limits))
        rows = Counter(tuple(r) for r in store.read_target("E").collect())
        errors = sorted(r.error_id for r in store.error_log().collect())
        outcomes.append((counters, rows, errors))
    assert outcomes[0] == outcomes[1]


def test_invariants_over_many_runs(spark, store):
    cfg = EntityConfig(1, "E", "s", "t", "pk")
    for day, seed in enumerate(range(30, 35), start=1):
        snapshot = spark.createDataFrame(scenario(seed)[1], "pk string, v string")
        counters = run_entity(spark, store, cfg, snapshot, day, lambda day=day: datetime(2026, 1, day))
        rows = store.read_target("E").cache()
        live = rows.where("is_active")
        assert live.count() == live.select("pk").distinct().count()
        changes = store.read_changes("E", day)
        frozen = changes.where("cdc_class = 'BLOCKED' and in_target").count()
        assert counters["rows_unchanged"] + counters["rows_updated"] + counters["rows_inserted"] + frozen == live.count()
        # an updated key goes on where its old version ended
        opened = rows.where("cdc_operation = 'U' or not is_active").alias("n")
        ended = rows.where("not is_active and cdc_operation <> 'D'").alias("o")
        lost = ended.join(rows.alias("n"), (F.col("n.pk") == F.col("o.pk")) & (F.col("n.start_ts") == F.col("o.end_ts")), "left_anti")
        assert lost.isEmpty(), opened.count()
        rows.unpersist()


@pytest.mark.parametrize("seed", range(10, 13))
def test_few_changed_keys_make_the_same_rows(spark, seed):
    target, staging = scenario(seed)
    # An active row without a key, and a second active row of a key that changes.
    target += [("None/x", 1, None, True, "I", None, "x"), ("twin/a", 1, None, True, "I", "twin", "a"), ("twin/b", 1, None, True, "I", "twin", "b")]
    staging += [("twin", "a")]
    t, s, _ = frames(spark, target, staging)
    t, hashed = with_row_hash(t, columns=["pk", "v"]).select(*t.columns), with_row_hash(s)
    changed = changed_keys(hashed, active(t), "pk").cache()
    assert may_broadcast(changed)
    for update, delete in PAIRS:
        cfg = EntityConfig(1, "E", "s", "t", "pk", delete_strategy=delete, update_strategy=update)
        assert flags(next_rows_of_few(hashed, active(t), changed, cfg, NOW)) == flags(next_rows(hashed, active(t), cfg, NOW)), (update, delete)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_a_target_is_the_same_with_few_and_many_changed_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(apply.skew, "LISTED_KEYS", limit)
    target, staging = scenario(14)
    t, s, _ = frames(spark, target, staging)
    t = with_row_hash(t, columns=["pk", "v"]).select(*t.columns)
    for update, delete in PAIRS:
        cfg = EntityConfig(1, "E", "s", "t", "pk", delete_strategy=delete, update_strategy=update)
        expected = next_rows(with_row_hash(s), active(t), cfg, NOW).unionByName(t.where(~F.col("is_active")))
        assert flags(apply_cdc(s, t, cfg, NOW).target) == flags(expected), (update, delete)
    none = t.where(F.lit(False))
    cfg = EntityConfig(1, "E", "s", "t", "pk")
    assert flags(apply_cdc(s, None, cfg, NOW).target) == flags(next_rows(with_row_hash(s), none, cfg, NOW))


def test_keys_that_occur_twice_are_not_broadcast(spark):
    rows = [("1", "U", "h"), ("1", "D", "h"), (None, "D", "g")]
    changed = spark.createDataFrame(rows, "_key string, _class string, _hash string")
    assert not may_broadcast(changed) and may_broadcast(changed.where("_class = 'D'"))
