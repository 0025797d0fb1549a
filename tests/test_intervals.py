"""State at a time, interval checks and the join of facts to versions, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest

from snapledger.config import EntityConfig
from snapledger.operators import intervals, skew
from snapledger.plans.run import run_entity

VERSIONS = "id string, v string, start_ts timestamp_ntz, end_ts timestamp_ntz, cdc_operation string"
T0 = datetime(2026, 1, 1)


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_gives_every_state_that_was_published(spark, store):
    cfg, states = EntityConfig(1, "A", "s", "t", "id", distinct_update_ts=False), []
    rng = random.Random(1)
    for n in range(5):
        rows = [(str(k), rng.choice("ab")) for k in range(12) if rng.random() < 0.7]
        run_entity(spark, store, cfg, spark.createDataFrame(rows, "id string, v string"), n + 1, lambda n=n: day(n))
        states.append(sorted(rows))
    target = store.read_target("A")
    assert intervals.interval_errors(target, "id").collect() == []
    assert intervals.as_of(target, day(-1)).collect() == []
    for n, rows in enumerate(states):
        for at in (day(n), day(n) + timedelta(hours=5)):
            assert sorted((r.id, r.v) for r in intervals.as_of(target, at).collect()) == rows
    text = plan(intervals.as_of(store.read_closed("A"), day(1)))
    assert "LessThanOrEqual(start_ts" in text


def test_interval_errors(spark):
    rows = [
        ("ok", "a", day(0), day(2), "I"), ("ok", "b", day(2), None, "U"),
        ("back", "a", day(0), day(2), "D"), ("back", "b", day(5), None, "I"),
        ("gap", "a", day(0), day(2), "I"), ("gap", "b", day(3), None, "U"),
        ("over", "a", day(0), day(4), "I"), ("over", "b", day(3), None, "U"),
        ("open", "a", day(0), None, "I"), ("open", "b", day(3), None, "U"),
        ("empty", "a", day(1), day(1), "I"), (None, "a", day(0), None, "I"),
    ]
    found = intervals.interval_errors(spark.createDataFrame(rows, VERSIONS), "id").collect()
    assert sorted((r.id, r.error, r.previous_end) for r in found) == [
        ("empty", "EMPTY", None), ("gap", "GAP", day(2)), ("open", "OVERLAP", None), ("over", "OVERLAP", day(4)),
    ]


@pytest.mark.parametrize("heavy", [False, True])
def test_facts_meet_the_version_that_held(spark, monkeypatch, heavy):
    if heavy:
        monkeypatch.setattr(intervals, "ROWS_PER_TASK", 3)
    assert intervals.ROWS_PER_TASK == (3 if heavy else skew.ROWS_PER_TASK)
    rng = random.Random(heavy)
    versions = []
    for k in range(8):
        at = 0
        while at < 40:
            end = at + rng.randint(1, 9)
            versions.append((str(k), f"{k}-{at}", day(at), day(end) if end < 40 or rng.random() < 0.5 else None, "U"))
            at = end + rng.choice([0, 0, 3])
    facts = [(n, rng.choice([*"0123456789", "0", "0", "0", None]), day(rng.choice([*range(-2, 45), None]))) for n in range(300)]
    target = spark.createDataFrame([*versions, (None, "none", day(0), None, "I")], VERSIONS)
    frame = spark.createDataFrame(facts, "n int, v string, at timestamp_ntz")
    joined = intervals.as_of_join(frame, target, "v", "at", "id", ["start_ts"])
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)
    want = []
    for n, key, at in facts:
        held = [s for i, _, s, e, _ in versions if i == key and at is not None and s <= at and (e is None or e > at)]
        assert len(held) <= 1
        want.append((n, key, at, held[0] if held else None))
    assert sorted(map(tuple, joined.collect()), key=lambda r: r[0]) == want
