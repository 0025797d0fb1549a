"""The seven end-to-end scenarios, as check rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.operators.reports import check, latest_run
from snapledger.plans.run import process, run, stored_run_log


def config(update="HISTORY", delete="SOFT"):
    return EntityConfig(
        1, "Employee", "STAGING.S_EMPLOYEE", "TARGET.T_EMPLOYEE", "employee_id",
        delete_strategy=delete, update_strategy=update,
    )


def load(spark, store, cfg, snapshot):
    return run(spark, store, [cfg], source=lambda s, n: snapshot)


def passed(name, df, value, expected):
    value = F.count(F.lit(1)) if value == ROWS else F.max(value)
    row = check(name, df, value, F.col("value") == expected).first()
    assert row.status == "PASS", f"{row.test_name}: {row.details}"


ROWS = "rows"


def test_inserts_history_updates_and_soft_deletes(spark, store, employees):
    cfg = config()
    load(spark, store, cfg, employees(("E001", 5000, "MGR_A", "IT"), ("E002", 5200, "MGR_A", "IT"), ("E003", 4800, "MGR_B", "HR")))
    target = store.read_target("Employee")
    passed("T01 active rows", target.where("is_active"), ROWS, 3)
    passed("T02 completed", stored_run_log(store).where("status = 'COMPLETED'"), ROWS, 1)
    passed("T03 rows inserted", stored_run_log(store), "rows_inserted", 3)

    load(spark, store, cfg, employees(("E001", 6000, "MGR_A", "IT"), ("E002", 5200, "MGR_A", "IT"), ("E003", 4800, "MGR_B", "HR")))
    target = store.read_target("Employee")
    new = "employee_id = 'E001' and is_active and salary = 6000 and cdc_operation = 'U'"
    passed("T04 new version", target.where(new), ROWS, 1)
    passed("T05 versions", target.where("employee_id = 'E001'"), ROWS, 2)
    passed("T06 rows updated", latest_run(stored_run_log(store)), "rows_updated", 1)
    assert latest_run(stored_run_log(store)).first().rows_unchanged == 2

    load(spark, store, cfg, employees(("E001", 6000, "MGR_A", "IT"), ("E003", 4800, "MGR_B", "HR")))
    target = store.read_target("Employee")
    gone = "employee_id = 'E002' and not is_active and end_ts is not null and cdc_operation = 'D'"
    passed("T07 deleted", target.where(gone), ROWS, 1)
    passed("T08 rows deleted", latest_run(stored_run_log(store)), "rows_deleted", 1)


def test_quality_errors(spark, store, employees):
    load(
        spark, store, config(),
        employees(
            ("E100", 5000, "MGR_A", "IT"), ("E100", 5000, "MGR_A", "IT"),
            ("E200", 4000, "MGR_B", "HR"), ("E200", 4500, "MGR_B", "HR"),
            (None, 3500, "MGR_C", "OPS"), ("", 3600, "MGR_C", "OPS"), ("E300", 3700, "MGR_D", "FIN"),
        ),
    )
    errors = store.error_log()
    passed("T09 duplicate inserts", errors.where("error_code = 'DUPLICATE_INSERT'"), ROWS, 2)
    passed("T10 duplicate updates", errors.where("error_code = 'DUPLICATE_UPDATE'"), ROWS, 2)
    passed("T11 key errors", errors.where("error_code = 'PRIMARY_KEY_ERROR'"), ROWS, 2)
    passed("T12 active rows", store.read_active("Employee"), ROWS, 1)
    assert store.read_active("Employee").first().employee_id == "E300"


def test_failed_run(spark, store):
    store.append_event(999001, 0, "RUNNING", datetime(2026, 1, 1))
    message = process(spark, store, [config()], -1, 999001)
    assert "no active configuration" in message
    passed("T13 failed", stored_run_log(store).where("run_id = 999001 and status = 'FAILED'"), ROWS, 1)
    passed("T14 entity log", store.entity_log().where("run_id = 999001"), ROWS, 0)


def test_overwrite(spark, store, employees):
    cfg = config(update="OVERWRITE")
    load(spark, store, cfg, employees(("E500", 5000, "MGR_X", "IT")))
    load(spark, store, cfg, employees(("E500", 6500, "MGR_Y", "FIN")))
    target = store.read_target("Employee")
    passed("T15 rows", target.where("employee_id = 'E500'"), ROWS, 1)
    new = "is_active and salary = 6500 and manager = 'MGR_Y' and department = 'FIN' and cdc_operation = 'U'"
    passed("T16 new values", target.where(new), ROWS, 1)
    passed("T17 rows updated", latest_run(stored_run_log(store)), "rows_updated", 1)


def test_hard_delete(spark, store, employees):
    cfg = config(delete="HARD")
    load(spark, store, cfg, employees(("E601", 4200, "MGR_H", "OPS"), ("E602", 4300, "MGR_H", "OPS")))
    load(spark, store, cfg, employees(("E601", 4200, "MGR_H", "OPS")))
    target = store.read_target("Employee")
    passed("T18 gone", target.where("employee_id = 'E602'"), ROWS, 0)
    passed("T19 rows deleted", latest_run(stored_run_log(store)), "rows_deleted", 1)
    passed("T20 active rows", target.where("is_active"), ROWS, 1)


@pytest.mark.parametrize("update,delete,rows", [("HISTORY", "SOFT", 3), ("OVERWRITE", "HARD", 2)])
def test_demo(spark, store, update, delete, rows):
    cfg = EntityConfig(1, "Test_with_CDC", "s", "t", "id", delete_strategy=delete, update_strategy=update)
    schema = "id string, naam string, woonplaats string"
    load(spark, store, cfg, spark.createDataFrame([("1", "John Doe", "Arnhem"), ("2", "Jane Doe", "Arnhem")], schema))
    load(
        spark, store, cfg,
        spark.createDataFrame(
            [("1", "John Doe", "Arnhem"), ("2", "Jane de Wit", "Maastricht"), ("", "Emma Ptykee", "Rotterdam")], schema
        ),
    )
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_updated, last.key_errors, last.rows_deleted) == (1, 1, 0)
    assert store.read_target("Test_with_CDC").count() == rows
