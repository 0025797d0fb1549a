"""The feed that is read from commits, against the comparison of both states."""

import random
from collections import Counter
from datetime import datetime

import pytest

from snapledger.config import EntityConfig
from snapledger.operators.feed import change_feed
from snapledger.plans.commit_feed import FeedGap, commit_feed, consume_commits
from snapledger.plans.run import Limits, run_entity

SCHEMA = "id string, v string, w int"
STRATEGIES = [("HISTORY", "SOFT"), ("OVERWRITE", "HARD")]


def cfg(update="HISTORY", delete="SOFT", **over):
    return EntityConfig(1, "A", "S_A", "T_A", "id", update_strategy=update, delete_strategy=delete, **over)


def go(spark, store, config, rows, day=1, **options):
    return run_entity(spark, store, config, spark.createDataFrame(rows, SCHEMA), day, lambda: datetime(2026, 1, day), **options)


def as_rows(df):
    return Counter(tuple(r[c] for c in ("id", "v", "w", "action", "is_update", "row_id")) for r in df.collect())


def snapshot(rng, n=14):
    rows = [(str(k), rng.choice(["a", "b", None]), rng.randint(0, 1)) for k in range(n) if rng.random() < 0.7]
    return rows + ([rows[0]] if rng.random() < 0.3 else [])  # a repeated key is frozen


@pytest.mark.parametrize("images", [True, False])
@pytest.mark.parametrize("update,delete", STRATEGIES)
def test_feed_between_any_two_commits_equals_the_comparison(spark, store, update, delete, images):
    rng = random.Random(f"{update}{images}")
    config = cfg(update, delete, before_images=images)
    states = {0: spark.createDataFrame([], SCHEMA)}
    for day in range(1, 7):
        go(spark, store, config, snapshot(rng), day, limits=Limits() if day % 2 else Limits(0, 0))
        last = store.latest("A").number
        rows = store.read_active("A").select("id", "v", "w").collect()
        states[last] = spark.createDataFrame(rows, SCHEMA)
    numbers = sorted(states)
    pairs = [(a, b) for a in numbers for b in numbers if a < b]
    for a, b in rng.sample(pairs, 7) + [(0, numbers[-1]), (numbers[-2], numbers[-1])]:
        want = as_rows(change_feed(states[a], states[b], "id"))
        assert as_rows(commit_feed(store, "A", a, b)) == want, (a, b)


@pytest.mark.parametrize("update,delete", STRATEGIES)
def test_overwritten_and_deleted_rows_show_as_they_were(spark, store, update, delete):
    for images in (True, False):
        config = cfg(update, delete, before_images=images)
        go(spark, store, config, [("1", "a", 1), ("2", "b", 2), ("3", "c", 3)])
        start = store.latest("A").number
        go(spark, store, config, [("1", "x", 1), ("3", "c", 3), ("4", "d", 4)], 2)
        found = sorted((r.id, r.v, r.w, r.action, r.is_update) for r in commit_feed(store, "A", start).collect())
        assert found == [
            ("1", "a", 1, "DELETE", True), ("1", "x", 1, "INSERT", True), ("2", "b", 2, "DELETE", False), ("4", "d", 4, "INSERT", False),
        ]
        store.reset("A")


def test_neither_state_is_read(spark, store):
    """The scans of a feed are those of the versions that its commits have written."""
    config = cfg(before_images=True)
    rows = [(str(k), "a", k) for k in range(200)]
    go(spark, store, config, rows)
    start = store.latest("A")
    go(spark, store, config, [("0", "x", 0), *rows[2:]], 2)
    state = store.latest("A")
    feed = commit_feed(store, "A", start.number)
    files = {f.split("version=")[1].split("/")[0] for f in feed.inputFiles()}
    assert files == {str(v) for v in state.opened if v not in start.opened} | {str(store.records("A", start.number, start.number + 1)[0].before)}
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert feed.count() == 3


def test_a_feed_survives_merging_and_needs_what_vacuum_has_removed(spark, store):
    config = cfg()
    go(spark, store, config, [("1", "a", 1), ("2", "b", 2)])
    start = store.latest("A").number
    go(spark, store, config, [("1", "x", 1), ("2", "b", 2)], 2)
    store.compact("A")
    want = as_rows(commit_feed(store, "A", start))
    assert len(want) == 2
    store.move_offset("A", "reader", start)
    store.vacuum("A", older_than=0)
    assert as_rows(commit_feed(store, "A", start)) == want
    store.move_offset("A", "reader", store.latest("A").number)
    store.vacuum("A", older_than=0)
    with pytest.raises(FeedGap):
        commit_feed(store, "A", start)
    assert commit_feed(store, "A", store.latest("A").number).collect() == []


def test_a_reset_begins_anew(spark, store):
    go(spark, store, cfg(), [("1", "a", 1)])
    start = store.latest("A").number
    store.reset("A", logs=False)
    go(spark, store, cfg(), [("2", "b", 2)], 2)
    with pytest.raises(FeedGap):
        commit_feed(store, "A", start)
    assert [(r.id, r.action, r.is_update) for r in commit_feed(store, "A").collect()] == [("2", "INSERT", False)]


def test_an_adopted_target_comes_as_inserts(spark, store):
    from snapledger.plans.apply import apply_cdc

    first = apply_cdc(spark.createDataFrame([("1", "a", 1)], SCHEMA), None, cfg(), "2026-01-01 00:00:00")
    second = apply_cdc(spark.createDataFrame([("1", "x", 1)], SCHEMA), first.target, cfg(), "2026-01-02 00:00:00")
    store.adopt("A", "T_A", "id", second.target)
    assert [(r.id, r.v, r.action, r.is_update) for r in commit_feed(store, "A").collect()] == [("1", "x", "INSERT", False)]


def test_commits_are_consumed_once(spark, store, tmp_path):
    sink = str(tmp_path / "sink")
    with pytest.raises(FeedGap):
        commit_feed(store, "A")
    go(spark, store, cfg(), [("1", "a", 1), ("2", "b", 2)])
    assert consume_commits(store, "A", "reader", sink).count() == 2
    assert consume_commits(store, "A", "reader", sink).count() == 2
    go(spark, store, cfg(), [("1", "a", 1), ("2", "c", 2)], 2)
    # a batch that was written before its offset moved is written again, not twice
    last = store.latest("A").number
    commit_feed(store, "A", 1, last).write.parquet(f"{sink}/upto={last}")
    assert consume_commits(store, "A", "reader", sink).count() == 4
    assert store.offsets("A") == {"reader": last}
    assert consume_commits(store, "A", "other reader", str(tmp_path / "other")).count() == 2
    go(spark, store, cfg(), [("1", "a", 1), ("2", "c", 2)], 3)
    assert consume_commits(store, "A", "reader", sink).count() == 4
