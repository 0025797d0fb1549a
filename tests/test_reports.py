from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapledger.operators import reports
from snapledger.plans import runlog
from snapledger.sources.store import COUNTERS, ENTITY_LOG_SCHEMA, RUN_EVENT_SCHEMA

T0 = datetime(2026, 1, 1)


def at(seconds, micros=0):
    return datetime(2026, 1, 1, 0, 0, seconds, micros)


@pytest.fixture(scope="module")
def logs(spark):
    schema = "run_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, rows_inserted bigint"
    a = spark.createDataFrame([(1, T0, at(2, 500000), 10), (2, T0, at(1), 5)], schema)
    b = spark.createDataFrame([(1, T0, at(4), 10), (3, T0, None, 0)], schema)
    return a, b


def test_durations(logs):
    rows = reports.run_durations(*logs, labels=("sql", "python")).collect()
    assert sorted((r.variant, r.run_id, r.duration) for r in rows if r.duration is not None) == [
        ("python", 1, 4.0), ("sql", 1, 2.5), ("sql", 2, 1.0),
    ]


def test_durations_count_millisecond_boundaries(spark):
    schema = "run_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz"
    log = spark.createDataFrame([(1, at(0, 900), at(0, 1100))], schema)
    assert reports.run_durations(log, log.limit(0)).first().duration == 0.001


def test_compare_counts_every_row_once(logs):
    rows = [tuple(r) for r in reports.compare_runs(*logs, labels=("sql", "python")).collect()]
    assert rows == [(1, 2.5, 4.0, 1.5, 20), (2, 1.0, None, None, 5), (3, None, None, None, 0)]


def test_reconcile_is_distinct_and_null_safe(spark):
    src = spark.createDataFrame([("1", None), ("1", None), ("2", "x"), ("2", "x"), ("3", "y")], "id string, v string")
    tgt = spark.createDataFrame(
        [("1", None, True), ("2", "old", True), ("2", "x", False), ("9", "z", True)], "id string, v string, is_active boolean"
    )
    counts = {r.source: r.row_count for r in reports.reconcile(src, tgt, ["id", "v"], both_ways=True).collect()}
    assert counts == {"STAGING": 5, "TARGET": 3, "DIFFERENCES": 2, "DIFFERENCES_REVERSE": 2}
    assert reports.reconcile(src, tgt, ["id", "v"]).count() == 3


def test_check_of_nothing_fails(spark):
    row = reports.check("t", spark.range(0), F.max("id"), F.col("value") == 1, "rows").first()
    assert tuple(row) == ("t", "FAIL", "rows=0")


def test_run_log(spark):
    events = spark.createDataFrame(
        [(1, 0, "RUNNING", T0), (1, 2, "COMPLETED", at(5)), (2, 0, "RUNNING", at(6)), (2, 1, "FAILED", at(7)), (3, 0, "RUNNING", at(8))],
        RUN_EVENT_SCHEMA,
    )
    def entity(run, name, n):
        return (run, T0, at(1), name, *[n] * len(COUNTERS))

    log = spark.createDataFrame([entity(1, "A", 2), entity(1, "B", 3), entity(2, "A", 7)], ENTITY_LOG_SCHEMA)
    rows = {r.run_id: r for r in runlog.run_log(events, log).collect()}
    assert [rows[i].status for i in (1, 2, 3)] == ["COMPLETED", "FAILED", "RUNNING"]
    assert [rows[i].end_ts for i in (1, 2, 3)] == [at(5), at(7), None]
    assert [rows[i].rows_inserted for i in (1, 2, 3)] == [5, 0, 0]
    assert runlog.next_run_id(events).first().next_run_id == 4
    assert runlog.next_run_id(events.limit(0)).first().next_run_id == 1
