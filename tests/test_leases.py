"""Leases: runs whose driver died, runs that stand still, and what vacuum keeps for runs at work."""

import os
import subprocess
import sys
import time

import pytest

from snapledger.config import EntityConfig
from snapledger.plans.run import claim_run_id, recover, run, run_entity, stored_run_log
from snapledger.sources import fs
from snapledger.sources.leases import Lease, LeaseLost, leases, notes
from snapledger.sources.store import FENCE, CommitConflict

SCHEMA = "id string, v string"
CFG = EntityConfig(1, "A", "S", "T", "id")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import sys, time
sys.path.insert(0, {root!r})
from snapledger.config import EntityConfig
from snapledger.plans.run import run
from snapledger.session import build_session
from snapledger.sources.store import VersionStore
spark = build_session("local[1]", "child", **{{"spark.ui.enabled": "false", "spark.driver.memory": "1g"}})

def slow(s, name):
    def wait(batches):
        for b in batches:
            time.sleep(600)
            yield b
    return s.createDataFrame([("1", "x")], "id string, v string").mapInArrow(wait, "id string, v string")

run(spark, VersionStore(spark, {store!r}), [EntityConfig(1, "A", "S", "T", "id")], slow, lease_seconds=4)
"""


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def states(store):
    return {r.run_id: r.status for r in stored_run_log(store).collect()}


def test_a_run_whose_driver_was_killed_is_failed_by_the_next(spark, store):
    assert run(spark, store, [CFG], lambda s, n: frame(s, ("1", "a"))).status == "COMPLETED"
    child = subprocess.Popen([sys.executable, "-c", CHILD.format(root=ROOT, store=store.root)], stdin=subprocess.DEVNULL)
    try:
        until = time.time() + 90
        while not any(n.run_id == 2 for n in notes(spark, store.leases_path(), "A")) and time.time() < until:
            time.sleep(0.5)
        time.sleep(5)  # longer than its lease, which is touched meanwhile
        assert recover(store) == [] and states(store)[2] == "RUNNING"
    finally:
        child.kill()
        child.wait()
    time.sleep(5)
    result = run(spark, store, [CFG], lambda s, n: frame(s, ("1", "b")))
    assert (result.run_id, result.status) == (3, "COMPLETED")
    assert states(store) == {1: "COMPLETED", 2: "FAILED", 3: "COMPLETED"}
    assert [(r.id, r.v) for r in store.read_active("A").collect()] == [("1", "b")]
    assert leases(spark, store.leases_path()) == []
    store.vacuum("A", older_than=0)
    assert notes(spark, store.leases_path(), "A") == [] and store.latest("A").kind != FENCE  # run 3 had a later number
    assert [(r.id, r.v) for r in store.read_target("A").where("is_active").collect()] == [("1", "b")]


def test_a_run_that_stood_still_commits_nothing(spark, store):
    run(spark, store, [CFG], lambda s, n: frame(s, ("1", "a")))
    found = []

    def source(s, name):
        held = leases(spark, store.leases_path())[-1]
        live = f"{store.leases_path()}/{held.stem}.live"
        fs.rename_new(spark, live, live[:-5] + ".lost")  # as another driver does
        found.append(held.run_id)
        return frame(s, ("1", "b"))

    result = run(spark, store, [CFG], source)
    assert result.status == "FAILED" and "taken over" in result.failures["A"]
    assert store.latest("A").number == 1 and [r.v for r in store.read_active("A").collect()] == ["a"]


def test_one_that_passed_the_check_is_stopped_by_the_number(spark, store):
    run_entity(spark, store, CFG, frame(spark, ("1", "a")), 1)
    run_id = claim_run_id(store)

    class Unaware(Lease):
        """Finds its lease in order, although it is lost: it stands still after the look."""

        def check(self):
            if fs.exists(self.spark, f"{self.folder}/{self.run_id}.bases"):
                os.rename(self.path, self.path[:-5] + ".lost")
                assert recover(store) == []  # not dead yet: its holder may be about to settle it
                assert store.vacuum("A", older_than=0) != []
                assert store.latest("A").kind == FENCE

    with pytest.raises(CommitConflict), Unaware(spark, store.leases_path(), run_id) as lease:
        run_entity(spark, store, CFG, frame(spark, ("1", "b")), run_id, lease=lease)
    assert [r.v for r in store.read_active("A").collect()] == ["a"]
    assert run_entity(spark, store, CFG, frame(spark, ("1", "c")), run_id + 1)["rows_updated"] == 1


def test_vacuum_keeps_what_a_run_at_work_reads(spark, store):
    run(spark, store, [CFG], lambda s, n: frame(s, ("1", "a"), ("2", "a")))
    run(spark, store, [CFG], lambda s, n: frame(s, ("1", "b"), ("2", "a")))
    with Lease(spark, store.leases_path(), claim_run_id(store)) as lease:
        before = store.latest("A")
        lease.note("A", before.number)
        rows = store.active_rows(before)
        time.sleep(1)
        store.compact("A")
        gone = store.vacuum("A", older_than=0)
        assert gone and all("/changes/A/" in path for path in gone)  # key tables of earlier runs only
        assert sorted((r.id, r.v) for r in rows.collect()) == [("1", "b"), ("2", "a")]
    assert store.vacuum("A", older_than=0) != []
    assert sorted((r.id, r.v) for r in store.read_active("A").collect()) == [("1", "b"), ("2", "a")]


def test_a_lease_is_one_runs_and_settled_once(spark, store):
    folder = store.leases_path()
    with Lease(spark, folder, 7, 60):
        with pytest.raises(LeaseLost):
            Lease(spark, folder, 7, 60).__enter__()
        assert [(h.run_id, h.seconds, h.dead) for h in leases(spark, folder)] == [(7, 60.0, False)]
    assert leases(spark, folder) == []
    with pytest.raises(ValueError), Lease(spark, folder, 8, 0.4):
        raise ValueError  # the lease stays
    time.sleep(1)
    assert recover(store) == [8] and recover(store) == []
    assert states(store) == {8: "FAILED"}
