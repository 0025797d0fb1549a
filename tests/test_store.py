"""Deletion vectors, bucket digests and merged versions of the store."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import snapledger.sources.store as stores
from snapledger.config import EntityConfig
from snapledger.functions.hashing import with_row_hash
from snapledger.operators import digests as dg
from snapledger.plans import run as runs
from snapledger.plans.run import run_entity
from snapledger.sources.store import COMPACT, PLACE, Commit, due

SCHEMA = "id string, v string"


def cfg(**over):
    return EntityConfig(1, "A", "S_A", "T_A", "id", **over)


def go(spark, store, rows, day=1, config=None, partitions=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.repartition(partitions, "id") if partitions else df
    return run_entity(spark, store, config or cfg(), df, day, lambda: datetime(2026, 1, 1 + day // 24, day % 24), **options)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_snapshot(rng, n=300):
    return [(f"k{k}", rng.choice("abc")) for k in range(n) if rng.random() < 0.9]


def test_the_active_slice_is_read_without_a_join(spark, store, monkeypatch):
    rng = random.Random(1)
    for day in range(12):
        go(spark, store, random_snapshot(rng), day, cfg(update_strategy=rng.choice(["HISTORY", "OVERWRITE"])), partitions=5, maintain=day % 2 == 0)
        record = store.latest("A")
        rows = store.active_rows(record)
        assert "Join" not in plan(rows) and (not record.ended or "Subquery" in plan(rows))
        by_place = Counter(tuple(r) for r in rows.collect())
        with monkeypatch.context() as m:
            m.setattr(stores, "VECTOR_ROWS", -1)
            joined = store.active_rows(record)
            assert not record.ended or "Join" in plan(joined)
            assert Counter(tuple(r) for r in joined.select(*rows.columns).collect()) == by_place
        assert len(by_place) == record.active_rows == rows.select("id").distinct().count()


def test_vectors_are_not_used_where_they_are_large_or_places_are_not_known(spark, store, monkeypatch):
    go(spark, store, [("1", "a"), ("2", "b")], partitions=2)
    go(spark, store, [("1", "a"), ("2", "c")], 2, maintain=False)
    record = store.latest("A")
    assert "Join" not in plan(store.active_rows(record))
    for change in ({"VECTOR_WORDS": 0}, {"VECTOR_ROWS": 0}):
        store._known_vectors.clear()
        with monkeypatch.context() as m:
            for name, value in change.items():
                m.setattr(stores, name, value)
            assert sorted(r.v for r in store.active_rows(record).collect()) == ["a", "c"]
            assert "Join" in plan(store.active_rows(record))
    # a record of an older library has no sizes
    old = Commit(**{**record.__dict__, "sizes": {}, "dead": {}})
    assert "Join" in plan(store.active_rows(old)) and due(old) == {}


def test_a_run_without_change_exchanges_digests_only(spark, store, monkeypatch):
    rows = [(f"k{k}", "a") for k in range(2000)]
    go(spark, store, rows, partitions=4)
    frames = []
    real = runs.classify
    monkeypatch.setattr(runs, "classify", lambda *a, **k: frames.append(real(*a, **k)) or frames[-1])
    counters = go(spark, store, rows, 2, partitions=3)
    assert counters["rows_unchanged"] == 2000 and sum(counters.values()) == 2000
    (classified,) = frames
    assert "Exchange" not in plan(classified) and "Scan" not in plan(classified).replace("LocalTableScan", "")
    state = store.latest("A")
    grouped = dg.added_up(with_row_hash(spark.createDataFrame(rows, SCHEMA)).select(dg.group_of(dg.bucket("id")).alias("bucket"), *dg.row_sums("row_hash")), F.col("bucket"))
    assert plan(grouped).count("Exchange hashpartitioning") == 1 and "partial_sum" in plan(grouped)
    assert dg.as_dict(grouped) == state.digest_sums


@pytest.mark.parametrize("fine_from", [0, 1 << 24])
def test_digests_follow_the_target_and_hide_no_change(spark, store, monkeypatch, fine_from):
    monkeypatch.setattr(runs, "find_scope", lambda *a, f=runs.find_scope: f(*a, fine_from=fine_from))
    rng = random.Random(fine_from)
    for day in range(9):
        rows = random_snapshot(rng) if day % 3 else [(f"k{k}", "a") for k in range(300)]
        if day % 3 == 2:
            rows = rows[:-1] + [("k1", "z"), ("k1", "y"), ("", "e"), (None, "n"), ("", "e")]
        if day == 4:
            rows = [*store.read_active("A").select("id", "v").collect(), ("new", "x")]  # one bucket differs
        previous = Counter(tuple(r) for r in store.read_active("A").select("id", "v").collect()) if day else Counter()
        found = go(spark, store, rows, day, cfg(update_strategy=rng.choice(["HISTORY", "OVERWRITE"]), delete_strategy=rng.choice(["SOFT", "HARD"])))
        keys = Counter(k for k, _ in rows)
        once = {k: v for k, v in rows if k and keys[k] == 1}
        known = {k: v for k, v in previous}
        assert found["rows_inserted"] == len(once.keys() - known.keys())
        assert found["rows_updated"] == sum(k in known and known[k] != v for k, v in once.items())
        assert found["rows_deleted"] == len(known.keys() - keys.keys())
        assert found["rows_unchanged"] == sum(k in known and known[k] == v for k, v in once.items())
        assert found["key_errors"] == keys[""] + keys[None]
        state = store.latest("A")
        real = dg.digest(store.active_rows(state), "id")
        assert dg.differing(real, store.digests(state)).collect() == []
        assert dg.as_dict(dg.digest(store.active_rows(state), "id", groups=True)) == state.digest_sums


def test_a_target_without_digests_gets_them_by_a_compaction(spark, store):
    go(spark, store, [("1", "a"), ("2", "b")])
    old = store.latest("A")
    store.commit(old.following(kind=COMPACT, digests=None, digest_sums={}, sizes={}, dead={}))
    assert go(spark, store, [("1", "a"), ("2", "c")], 2)["rows_updated"] == 1
    assert store.latest("A").digests is None
    store.compact("A")
    state = store.latest("A")
    assert state.digests and state.digest_sums and state.sizes
    assert go(spark, store, [("1", "a"), ("2", "c")], 3)["rows_unchanged"] == 2


def test_a_key_of_another_number_type_has_the_same_bucket(spark, store):
    config = EntityConfig(1, "N", "S", "T_N", "id")
    run_entity(spark, store, config, spark.range(100).selectExpr("id", "'a' as v"), 1)
    again = run_entity(spark, store, config, spark.range(100).selectExpr("cast(id as int) as id", "'a' as v"), 2)
    assert again["rows_unchanged"] == 100


def simulate(runs_, share, base):
    """Rows written again and the most live versions if every run opens and ends a share of the base."""
    record, fresh, rewritten, most = Commit("A", "t").following(opened=[0]).counted({0: base}), 1, 0, 0
    n = int(base * share)
    for _ in range(runs_):
        largest = max(record.opened, key=record.live)
        record = record.following(opened=[*record.opened, fresh], ended=[*record.ended, fresh + 1]).counted({fresh: n, fresh + 1: n}, {largest: n})
        fresh += 2
        while merge := due(record):
            lists = {p: [v for v in getattr(record, p) if v not in merge.get(p, [])] for p in ("opened", "ended", "closed")}
            sizes = {}
            if "opened" in merge:
                live, dead = sum(record.live(v) for v in merge["opened"]), sum(record.dead.get(str(v), 0) for v in merge["opened"])
                sizes[fresh], sizes[fresh + 1] = live, dead
                lists["opened"].append(fresh)
                if dead:
                    lists["closed"].append(fresh + 1)
                fresh += 2
                rewritten += live + dead
            for part in ("ended", "closed"):
                if part in merge:
                    sizes[fresh] = sum(record.sizes[str(v)] for v in merge[part])
                    lists[part].append(fresh)
                    rewritten += sizes[fresh] if part == "closed" else 0
                    fresh += 1
            record = record.following(**lists).counted(sizes)
        most = max(most, len(record.opened) + len(record.ended) + len(record.closed))
    return rewritten, most


def test_merging_costs_little_and_keeps_versions_few():
    for count, times in ((100, 4), (1000, 6)):
        rewritten, most = simulate(count, 0.01, 1_000_000)
        assert rewritten <= times * (1_000_000 + count * 10_000)
        assert most <= 3 * stores.FANOUT * (stores.size_class(1_000_000 + count * 10_000) + 1)
    assert simulate(3000, 0.01, 1_000_000)[1] <= simulate(300, 0.01, 1_000_000)[1] + 3 * 2 * stores.FANOUT


def test_versions_are_merged_as_runs_go_on(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "FANOUT", 3)
    rng = random.Random(3)
    rows = [(f"k{k}", "a") for k in range(400)]
    most = 0
    for day in range(11):
        rows = [(k, rng.choice("xyz") if rng.random() < 0.02 else v) for k, v in rows]
        go(spark, store, rows, day)
        state = store.latest("A")
        most = max(most, len(state.opened), len(state.ended))
        assert Counter(tuple(r) for r in store.read_active("A").select("id", "v").collect()) == Counter(rows)
        for version in state.opened:
            part = store.active_rows(state).where(F.col("opened_version") == version).count()
            assert state.live(version) == part
    assert most <= 6
    closed, counters = store.read_closed("A").count(), store.entity_log().agg(F.sum("rows_updated")).first()[0]
    assert closed == counters > 15
    store.vacuum("A", older_than=0)
    assert Counter(tuple(r) for r in store.read_active("A").select("id", "v").collect()) == Counter(rows)
    assert store.read_closed("A").count() == closed
    assert set(PLACE).isdisjoint(store.read_target("A").columns)


@pytest.mark.parametrize("fine_from", [0, 1 << 24])
def test_rows_are_not_hashed_for_a_scope_that_their_number_tells(spark, store, monkeypatch, fine_from):
    """All groups and buckets of keys get more rows, so all are compared; with as many rows as before the hashes decide."""
    compared = []
    monkeypatch.setattr(dg, "BUCKETS", 1 << 10)
    monkeypatch.setattr(runs.digests, "group_of", lambda place: F.shiftright(place, 2))
    monkeypatch.setattr(runs.digests, "differing_groups", lambda *a, f=dg.differing_groups: compared.append(a) or f(*a))
    monkeypatch.setattr(runs, "find_scope", lambda *a, f=runs.find_scope: f(*a, fine_from=fine_from))
    go(spark, store, [(f"k{k}", "a") for k in range(6000)], 0)
    assert not compared
    found = go(spark, store, [(f"k{k}", "b" if k % 3 else "a") for k in range(20000)] + [("", "e"), (None, "n")], 1)
    assert not compared
    assert (found["rows_inserted"], found["rows_updated"], found["rows_unchanged"], found["key_errors"]) == (14000, 4000, 2000, 2)
    assert go(spark, store, [(f"k{k}", "b" if k % 3 else "a") for k in range(20000)], 2)["rows_unchanged"] == 20000
    assert len(compared) == 1
