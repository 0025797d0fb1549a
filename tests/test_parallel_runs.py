"""Entities of one run at the same time."""

import threading
import time

from snapledger.config import EntityConfig
from snapledger.plans.run import run, stored_run_log

SCHEMA = "id string, v string"


def configs(n):
    return [EntityConfig(k, f"E{k}", f"S{k}", f"T{k}", "id") for k in range(n)]


def test_entities_at_the_same_time_give_what_they_give_in_turn(spark, store):
    def source(day):
        return lambda s, name: s.createDataFrame([(str(k), f"{name}{k % (day + 2)}") for k in range(10 + day)], SCHEMA)

    for day in range(2):
        assert run(spark, store, configs(4), source(day), at_once=4).status == "COMPLETED"
    for k in range(4):
        assert {(r.id, r.v) for r in store.read_active(f"E{k}").collect()} == {(str(i), f"S{k}{i % 3}") for i in range(11)}
    log = {r.run_id: r for r in stored_run_log(store).collect()}
    assert (log[1].rows_inserted, log[2].rows_inserted, log[2].rows_updated) == (40, 4, 4 * log[2].rows_updated // 4)


def test_a_failure_stops_the_others_and_none_commits_later(spark, store):
    at_work = threading.Event()

    def source(s, name):
        if name == "S1":
            at_work.wait(20)  # fails while the others work
            raise FileNotFoundError(name)
        at_work.set()

        def slowly(batches):
            for batch in batches:
                time.sleep(60)
                yield batch

        return s.createDataFrame([("1", "a")], SCHEMA).mapInArrow(slowly, SCHEMA)

    begin = time.time()
    result = run(spark, store, configs(3), source, at_once=3)
    assert result.status == "FAILED" and list(result.failures) == ["E1"] and time.time() - begin < 50
    assert all(store.latest(f"E{k}") is None for k in range(3))
    assert [r.entity_name for r in store.error_log().collect()] == ["E1"]
    # the session goes on: the next run is not cancelled
    again = run(spark, store, configs(3), lambda s, n: s.createDataFrame([("1", "a")], SCHEMA), at_once=3)
    assert again.status == "COMPLETED" and all(store.latest(f"E{k}") for k in range(3))


def test_with_continue_the_others_commit(spark, store):
    def source(s, name):
        if name in ("S0", "S2"):
            raise FileNotFoundError(name)
        return s.createDataFrame([("1", "a")], SCHEMA)

    result = run(spark, store, configs(4), source, on_entity_failure="continue", at_once=4)
    assert result.status == "FAILED" and list(result.failures) == ["E0", "E2"]
    assert [store.latest(f"E{k}") is not None for k in range(4)] == [False, True, False, True]
    assert stored_run_log(store).first().status == "FAILED"
