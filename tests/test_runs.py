import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapledger.config import CONFIG_SCHEMA, ConfigError, EntityConfig, load_configs
from snapledger.operators.reports import latest_run
from snapledger.plans.run import Limits, claim_run_id, run, run_entity, stored_run_log

SCHEMA = "id string, v string"
BROADCAST, JOINED = Limits(), Limits(rows=0, key_bytes=0)


def cfg(config_id=1, name="A", **over):
    return EntityConfig(config_id, name, f"S_{name}", f"T_{name}", "id", **over)


def snapshots(spark, **tables):
    frames = {f"S_{n}": spark.createDataFrame(rows, SCHEMA) for n, rows in tables.items()}

    def source(_, name):
        if name not in frames:
            raise FileNotFoundError(name)
        return frames[name]

    return source


def versions(store, name="A"):
    return sorted(
        ((r.id, r.v, r.is_active, r.cdc_operation) for r in store.read_target(name).collect()), key=str
    )


def test_same_snapshot_twice_changes_nothing_and_writes_nothing(spark, store):
    source = snapshots(spark, A=[("1", "a"), ("2", "b")])
    run(spark, store, [cfg()], source)
    before = versions(store)
    state = store.latest("A")
    run(spark, store, [cfg()], source)
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_inserted, last.rows_updated, last.rows_deleted, last.rows_unchanged) == (0, 0, 0, 2)
    assert versions(store) == before
    after = store.latest("A")
    assert (after.opened, after.ended, after.number) == (state.opened, state.ended, state.number + 1)


def test_reactivation_is_an_insert_next_to_the_history(spark, store):
    for rows in ([("1", "a"), ("2", "b")], [("1", "a")], [("1", "a"), ("2", "b")]):
        run(spark, store, [cfg()], snapshots(spark, A=rows))
    assert versions(store) == [
        ("1", "a", True, "I"), ("2", "b", False, "D"), ("2", "b", True, "I"),
    ]


def test_repeated_keys_are_frozen(spark, store):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a"), ("2", "b")]))
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "x"), ("1", "y")]))
    assert versions(store) == [("1", "a", True, "I"), ("2", "b", False, "D")]
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_unchanged, last.duplicate_updates, last.rows_deleted) == (0, 2, 1)


def test_empty_snapshot_deletes_everything_unless_guarded(spark, store):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a")]))
    guarded = run(spark, store, [cfg(allow_empty_snapshot=False)], snapshots(spark, A=[]))
    assert guarded.status == "FAILED" and versions(store) == [("1", "a", True, "I")]
    run(spark, store, [cfg()], snapshots(spark, A=[]))
    assert versions(store) == [("1", "a", False, "D")]
    run(spark, store, [cfg()], snapshots(spark, A=[("3", "c")]))
    assert versions(store) == [("1", "a", False, "D"), ("3", "c", True, "I")]


def test_hard_delete_keeps_closed_history(spark, store):
    hard = cfg(delete_strategy="HARD")
    for rows in ([("1", "a"), ("2", "b")], [("1", "x"), ("2", "b")], [("2", "b")]):
        run(spark, store, [hard], snapshots(spark, A=rows))
    assert versions(store) == [("1", "a", False, "I"), ("2", "b", True, "I")]


def test_hard_delete_of_everything(spark, store):
    hard = cfg(delete_strategy="HARD")
    run(spark, store, [hard], snapshots(spark, A=[("1", "a")]))
    run(spark, store, [hard], snapshots(spark, A=[]))
    assert versions(store) == []


def test_null_business_values_are_values(spark, store):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", None), ("2", "b")]))
    run(spark, store, [cfg()], snapshots(spark, A=[("1", None), ("2", None)]))
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_updated, last.rows_unchanged) == (1, 1)


def test_key_only_table(spark, store):
    only = EntityConfig(1, "K", "S_K", "T_K", "id")
    for rows in ([("1",), ("2",)], [("2",), ("3",)]):
        source = lambda s, n, rows=rows: spark.createDataFrame(rows, "id string")
        assert run(spark, store, [only], source).status == "COMPLETED"
    assert sorted((r.id, r.is_active) for r in store.read_target("K").collect()) == [
        ("1", False), ("2", True), ("3", True),
    ]


def test_inactive_configs_are_skipped_and_order_is_by_id(spark, store):
    configs = [cfg(3, "C"), cfg(1, "A"), cfg(2, "B", is_active=False)]
    source = snapshots(spark, A=[("1", "a")], C=[("1", "c")])
    assert run(spark, store, configs, source).status == "COMPLETED"
    assert [r.entity_name for r in store.entity_log().orderBy("start_ts").collect()] == ["A", "C"]


@pytest.mark.parametrize("mode,done", [("stop", ["A"]), ("continue", ["A", "C"])])
def test_failure_of_one_entity(spark, store, mode, done):
    configs = [cfg(1, "A"), cfg(2, "B"), cfg(3, "C")]
    source = snapshots(spark, A=[("1", "a")], C=[("1", "c")])
    result = run(spark, store, configs, source, on_entity_failure=mode)
    assert result.status == "FAILED" and list(result.failures) == ["B"]
    assert sorted(r.entity_name for r in store.entity_log().collect()) == done
    log = latest_run(stored_run_log(store)).first()
    assert (log.status, log.rows_inserted) == ("FAILED", 0) and log.end_ts is not None
    (error,) = store.error_log().where("error_code = 'RUNTIME_ERROR'").collect()
    assert error.entity_name == "B" and json.loads(error.error_row)["config_id"] == 2


@pytest.mark.parametrize("mode,status", [("completed", "COMPLETED"), ("failed", "FAILED")])
def test_run_without_configs(spark, store, mode, status):
    assert run(spark, store, [], on_no_config=mode).status == status
    assert stored_run_log(store).first().status == status


def test_failed_entity_keeps_its_errors_and_publishes_nothing(spark, store):
    limited = cfg(length_limits={"v": 3})
    run(spark, store, [limited], snapshots(spark, A=[("1", "abc")]))
    for limits in (BROADCAST, JOINED):
        bad = snapshots(spark, A=[("1", "abcd"), ("2", "x"), ("2", "x"), (None, "y")])
        result = run(spark, store, [limited], bad, limits=limits)
        assert result.status == "FAILED" and "longer than 3" in result.failures["A"]
        assert versions(store) == [("1", "abc", True, "I")]
        logged = store.error_log().where(F.col("run_id") == result.run_id).collect()
        assert sorted(e.error_code for e in logged) == [
            "DUPLICATE_INSERT", "DUPLICATE_INSERT", "PRIMARY_KEY_ERROR", "RUNTIME_ERROR",
        ]
    # a long value in a row that is not written does no harm
    assert run(spark, store, [limited], snapshots(spark, A=[("1", "abc"), ("2", "long"), ("2", "long")])).status == "COMPLETED"


def test_error_strategy_stop(spark, store):
    stop = cfg(error_strategy="STOP")
    assert run(spark, store, [stop], snapshots(spark, A=[("1", "a")])).status == "COMPLETED"
    result = run(spark, store, [stop], snapshots(spark, A=[("1", "b"), (None, "x")]))
    assert result.status == "FAILED" and versions(store) == [("1", "a", True, "I")]
    assert store.error_log().where("error_code = 'PRIMARY_KEY_ERROR'").count() == 1


@pytest.mark.parametrize("field", ["update_strategy", "delete_strategy", "error_strategy"])
def test_unknown_strategy_fails_the_entity(spark, store, field):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a")]))
    result = run(spark, store, [cfg(**{field: "sfot"})], snapshots(spark, A=[]))
    assert result.status == "FAILED" and "SFOT" in result.failures["A"]
    assert versions(store) == [("1", "a", True, "I")]


def test_strategies_match_in_any_case():
    assert cfg(update_strategy="overwrite", delete_strategy="Hard").validate().update_strategy == "OVERWRITE"


def test_config_table(spark, store):
    rows = [
        (2, "B", "S_B", "T_B", "id", None, None, None, True),
        (1, "A", "S_A", "T_A", "id", "HARD", "STOP", "OVERWRITE", True),
        (3, "C", "S_C", "T_C", "id", None, None, None, False),
    ]
    table = spark.createDataFrame(rows, CONFIG_SCHEMA)
    a, b = load_configs(table)
    assert (a.config_id, a.delete_strategy, a.error_strategy, a.update_strategy) == (1, "HARD", "STOP", "OVERWRITE")
    assert (b.delete_strategy, b.error_strategy, b.update_strategy) == ("SOFT", "CONTINUE", "HISTORY")
    assert run(spark, store, table, snapshots(spark, A=[("1", "a")], B=[("1", "b")])).status == "COMPLETED"


def test_new_staging_column_fails_and_missing_one_becomes_null(spark, store):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a"), ("2", "b")]))
    wider = spark.createDataFrame([("1", "a", 1)], "id string, v string, extra int")
    result = run(spark, store, [cfg()], lambda s, n: wider)
    assert result.status == "FAILED" and "extra" in result.failures["A"]
    narrower = spark.createDataFrame([("1",), ("2",)], "id string")
    assert run(spark, store, [cfg()], lambda s, n: narrower).status == "COMPLETED"
    assert [r.v for r in store.read_active("A").collect()] == [None, None]


def test_overwrite_keeps_columns_the_snapshot_lacks(spark, store):
    over = cfg(update_strategy="OVERWRITE")
    run(spark, store, [over], snapshots(spark, A=[("1", "a")]))
    for limits in (BROADCAST, JOINED):
        narrower = spark.createDataFrame([("1",)], "id string")
        assert run(spark, store, [over], lambda s, n: narrower, limits=limits).status == "COMPLETED"
        assert [(r.id, r.v, r.is_active) for r in store.read_target("A").collect()] == [("1", "a", True)]


def test_declared_target_types_are_kept(spark, store):
    from snapledger.functions.columns import target_schema

    declared = target_schema(spark.sql("select '' as id, cast(0 as decimal(18,2)) as v").schema, "id")
    load = spark.createDataFrame([("1", "100.50")], SCHEMA)
    assert run(spark, store, [cfg()], lambda s, n: load, schemas={"A": declared}).status == "COMPLETED"
    assert str(store.read_active("A").first().v) == "100.50"
    bad = spark.createDataFrame([("1", "many")], SCHEMA)
    assert run(spark, store, [cfg()], lambda s, n: bad, schemas={"A": declared}).status == "FAILED"


@pytest.mark.parametrize("limits", [BROADCAST, JOINED])
def test_distinct_update_times(spark, store, limits):
    one = cfg(distinct_update_ts=True)
    run_entity(spark, store, one, spark.createDataFrame([(f"{i:02d}", "a") for i in range(20)], SCHEMA), 1, lambda: datetime(2026, 1, 1), limits)
    run_entity(spark, store, one, spark.createDataFrame([(f"{i:02d}", "b") for i in range(20)], SCHEMA), 2, lambda: datetime(2026, 1, 2), limits)
    starts = {r.id: r.start_ts for r in store.read_active("A").collect()}
    ends = {r.id: r.end_ts for r in store.read_closed("A").collect()}
    assert starts == ends == {f"{i:02d}": datetime(2026, 1, 2, 0, 0, 0, i) for i in range(20)}


def test_uncommitted_files_are_never_read(spark, store, monkeypatch):
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a")]))
    real = store.commit
    monkeypatch.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    assert run(spark, store, [cfg()], snapshots(spark, A=[("1", "b")])).status == "FAILED"
    assert versions(store) == [("1", "a", True, "I")]
    monkeypatch.setattr(store, "commit", real)
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "c")]))
    assert versions(store) == [("1", "a", False, "I"), ("1", "c", True, "U")]


def test_run_ids_are_taken_once(spark, store):
    assert [claim_run_id(store) for _ in range(3)] == [1, 2, 3]


def test_reset(spark, store):
    run(spark, store, [cfg(), cfg(2, "B")], snapshots(spark, A=[("1", "a")], B=[("1", "b")]))
    store.reset("A", logs=False)
    assert store.schema("A") is None and store.read_target("B").count() == 1
    store.reset("A", "B")
    assert store.entity_log().count() == store.run_events().count() == store.error_log().count() == 0
    assert run(spark, store, [cfg()], snapshots(spark, A=[("1", "a")])).run_id == 1


def test_config_error_names_the_entity():
    with pytest.raises(ConfigError, match="entity A"):
        cfg(hash_nulls="sometimes").validate()


def test_upper_and_lower_case_do_not_matter(spark, store):
    upper = EntityConfig(1, "A", "S_A", "T_A", "ID")
    run(spark, store, [upper], snapshots(spark, A=[("1", "a"), ("2", "b")]))
    shouted = spark.createDataFrame([("1", "x"), ("2", "b")], "ID string, V string")
    assert run(spark, store, [upper], lambda s, n: shouted).status == "COMPLETED"
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_updated, last.rows_unchanged) == (1, 1)


def test_unknown_key_column_fails(spark, store):
    wrong = EntityConfig(1, "A", "S_A", "T_A", "no_such")
    result = run(spark, store, [wrong], snapshots(spark, A=[("1", "a")]))
    assert result.status == "FAILED" and "no_such" in result.failures["A"]


def test_overlapping_runs_of_an_entity_do_not_lose_changes(spark, store, monkeypatch):
    """The other run commits between the last look and the commit."""
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a"), ("2", "a")]))
    real = store.commit

    def overtaken(record):
        monkeypatch.setattr(store, "commit", real)
        run(spark, store, [cfg()], snapshots(spark, A=[("1", "b"), ("2", "a")]))
        real(record)

    monkeypatch.setattr(store, "commit", overtaken)
    late = run(spark, store, [cfg()], snapshots(spark, A=[("1", "a"), ("2", "c")]))
    assert late.status == "FAILED" and "meanwhile" in late.failures["A"]
    assert versions(store) == [("1", "a", False, "I"), ("1", "b", True, "U"), ("2", "a", True, "I")]
    assert run(spark, store, [cfg()], snapshots(spark, A=[("1", "b"), ("2", "c")])).status == "COMPLETED"


def test_a_failed_first_run_leaves_no_schema_behind(spark, store):
    limited = cfg(length_limits={"v": 2})
    assert run(spark, store, [limited], snapshots(spark, A=[("1", "long")])).status == "FAILED"
    assert store.schema("A") is None
    wider = spark.createDataFrame([("1", "a", 5)], "id string, v string, extra int")
    assert run(spark, store, [limited], lambda s, n: wider).status == "COMPLETED"
    assert store.read_active("A").first().extra == 5


def test_a_run_writes_in_proportion_to_what_changes(spark, store):
    from snapledger.sources import fs

    def snapshot(changed):
        rows = spark.range(100_000).selectExpr("concat('k', id) as id", f"if(id < {changed}, 'new', sha2(string(id), 256)) as v")
        return lambda s, n: rows

    run(spark, store, [cfg()], snapshot(0))
    full = fs.size(spark, f"{store.root}/targets") + fs.size(spark, f"{store.root}/changes")
    run(spark, store, [cfg()], snapshot(100))
    both = fs.size(spark, f"{store.root}/targets") + fs.size(spark, f"{store.root}/changes")
    assert both - full < 0.05 * full
    assert store.read_active("A").where("v = 'new'").count() == 100 and store.read_closed("A").count() == 100


def test_compaction_and_vacuum_change_no_row(spark, store):
    days = [[("1", "a"), ("2", "b"), ("3", "c")], [("1", "x"), ("2", "b")], [("1", "y"), ("3", "c")]]
    for rows in days:
        run(spark, store, [cfg()], snapshots(spark, A=rows))
    before = versions(store)
    store.compact("A")
    state = store.latest("A")
    assert versions(store) == before and len(state.opened) == 1 and state.ended == []
    assert store.vacuum("A") == [] and len(store.vacuum("A", older_than=0)) >= 5
    assert versions(store) == before
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "z"), ("3", "c")]))
    store.compact("A")
    assert ("1", "y", False, "U") in versions(store) and ("1", "z", True, "U") in versions(store)
    assert [r.run_id for r in store.entity_log().orderBy("run_id").collect()] == [1, 2, 3, 4]


def test_another_hash_fails_the_entity(spark, store):
    source = snapshots(spark, A=[("1", None), ("2", "b")])
    run(spark, store, [cfg()], source)
    result = run(spark, store, [cfg(hash_nulls="drop")], source)
    assert result.status == "FAILED" and "encoding" in result.failures["A"]


def test_hashes_can_change_without_a_change_of_rows(spark, store):
    days = [[("1", None), ("2", "b"), ("3", "c")], [("1", None), ("2", "x")]]
    for rows in days:
        run(spark, store, [cfg()], snapshots(spark, A=rows))
    before = versions(store)
    hashes = {(r.id, r.row_hash) for r in store.read_active("A").collect()}
    for nulls in ("drop", "keep"):
        store.rehash("A", nulls)
        assert versions(store) == before
        assert ({(r.id, r.row_hash) for r in store.read_active("A").collect()} == hashes) == (nulls == "keep")
        assert run(spark, store, [cfg(hash_nulls=nulls)], snapshots(spark, A=days[1])).status == "COMPLETED"
        last = latest_run(stored_run_log(store)).first()
        assert (last.rows_inserted, last.rows_updated, last.rows_deleted, last.rows_unchanged) == (0, 0, 0, 2)
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "n"), ("2", "x")]))
    assert ("1", "n", True, "U") in versions(store)


def test_the_target_table_names_the_place_and_cannot_move(spark, store):
    from snapledger.sources import fs

    run(spark, store, [cfg()], snapshots(spark, A=[("1", "a")]))
    assert fs.list_names(spark, f"{store.root}/targets") == ["T_A"]
    moved = EntityConfig(1, "A", "S_A", "T_other", "id")
    assert "T_other" in run(spark, store, [moved], snapshots(spark, A=[("1", "b")])).failures["A"]
    for bad in ("", ".", ".."):
        with pytest.raises(ConfigError):
            EntityConfig(1, bad, "s", "t", "id").validate()
        with pytest.raises(ValueError):
            store.reset(bad)


def test_a_versioned_frame_is_adopted_with_its_history(spark, store):
    from snapledger.plans.apply import apply_cdc

    first = apply_cdc(spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA), None, cfg(), "2026-01-01 00:00:00")
    second = apply_cdc(spark.createDataFrame([("1", "x"), ("2", "b")], SCHEMA), first.target, cfg(), "2026-01-02 00:00:00")
    store.adopt("A", "T_A", "id", second.target)
    assert versions(store) == [("1", "a", False, "I"), ("1", "x", True, "U"), ("2", "b", True, "I")]
    run(spark, store, [cfg()], snapshots(spark, A=[("1", "x"), ("2", "c")]))
    assert versions(store) == [
        ("1", "a", False, "I"), ("1", "x", True, "U"), ("2", "b", False, "I"), ("2", "c", True, "U"),
    ]
    assert {r.start_ts for r in store.read_active("A").where("id = '1'").collect()} == {datetime(2026, 1, 2)}
    with pytest.raises(ValueError):
        store.adopt("A", "T_A", "id", second.target)


def test_lengths_come_from_the_declared_target(spark, store):
    from pyspark.sql import types as T

    declared = T.StructType(
        [
            T.StructField("row_hash", T.StringType()), T.StructField("start_ts", T.TimestampNTZType()),
            T.StructField("end_ts", T.TimestampNTZType()), T.StructField("is_active", T.BooleanType()),
            T.StructField("cdc_operation", T.StringType()), T.StructField("id", T.VarcharType(10)), T.StructField("v", T.VarcharType(2)),
        ]
    )
    result = run(spark, store, [cfg()], snapshots(spark, A=[("1", "abc")]), schemas={"A": declared})
    assert result.status == "FAILED" and "longer than 2" in result.failures["A"]
    assert run(spark, store, [cfg()], snapshots(spark, A=[("1", "ab")]), schemas={"A": declared}).status == "COMPLETED"


def test_all_settings_come_from_a_config_table(spark, store):
    from snapledger.config import OPTIONAL_SCHEMA, T

    schema = T.StructType([*CONFIG_SCHEMA, *OPTIONAL_SCHEMA])
    rows = [
        (1, "A", "S_A", "T_A", "id", None, None, None, True, "drop", False, {"v": 3}, False, True, True),
        (2, "B", "S_B", "T_B", "id", None, None, None, True, None, None, None, None, None, None),
    ]
    a, b = load_configs(spark.createDataFrame(rows, schema))
    assert (a.hash_nulls, a.dup_includes_empty_key, a.length_limits, a.allow_empty_snapshot, a.distinct_update_ts, a.before_images) == ("drop", False, {"v": 3}, False, True, True)
    assert b == cfg(2, "B")


def test_a_snapshot_that_changes_during_the_run_fails_it(spark, store, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA).write.parquet(path)
    real = store.append_errors

    def exchanged(*a, **k):
        spark.createDataFrame([("1", "a")], SCHEMA).write.mode("overwrite").parquet(path)
        return real(*a, **k)

    store.append_errors = exchanged
    with pytest.raises(Exception):
        run_entity(spark, store, cfg(), spark.read.parquet(path), 1)
    assert store.latest("A") is None


def test_overwrite_has_one_time_for_all_updates(spark, store):
    one = cfg(update_strategy="OVERWRITE", distinct_update_ts=True)
    run_entity(spark, store, one, spark.createDataFrame([("1", "a"), ("2", "a")], SCHEMA), 1, lambda: datetime(2026, 1, 1))
    run_entity(spark, store, one, spark.createDataFrame([("1", "b"), ("2", "b")], SCHEMA), 2, lambda: datetime(2026, 1, 2))
    assert {r.start_ts for r in store.read_target("A").collect()} == {datetime(2026, 1, 2)}


def test_lazy_result_with_distinct_update_times(spark):
    from snapledger.plans.apply import apply_cdc

    one = cfg(distinct_update_ts=True)
    first = apply_cdc(spark.createDataFrame([("1", "a"), ("2", "a")], SCHEMA), None, one, "2026-01-01 00:00:00")
    second = apply_cdc(spark.createDataFrame([("1", "b"), ("2", "b")], SCHEMA), first.target, one, "2026-01-02 00:00:00")
    live = {r.id: r.start_ts for r in second.target.where("is_active").collect()}
    assert live == {"1": datetime(2026, 1, 2), "2": datetime(2026, 1, 2, 0, 0, 0, 1)}


@pytest.mark.parametrize("limits", [BROADCAST, JOINED])
def test_business_columns_may_have_any_name(spark, store, limits):
    names = ["copies", "ordinal", "n_rows", "is_conflict", "cdc_class", "old_end_ts", "in_target", "s", "t", "min_hash"]
    schema = ", ".join(["id string", *[f"{n} string" for n in names]])

    def snapshot(*rows):
        frame = spark.createDataFrame([(k, *[v] * len(names)) for k, v in rows], schema)
        return lambda s, n: frame

    assert run(spark, store, [cfg()], snapshot(("1", "a"), ("2", "b")), limits=limits).status == "COMPLETED"
    result = run(spark, store, [cfg()], snapshot(("1", "x"), ("3", "c"), ("3", "c"), ("3", "d")), limits=limits)
    assert result.status == "COMPLETED", result
    last = latest_run(stored_run_log(store)).first()
    assert (last.rows_updated, last.rows_deleted, last.duplicate_inserts, last.duplicate_updates) == (1, 1, 2, 3)
    assert {(r.id, r.copies, r.is_active) for r in store.read_target("A").collect()} == {
        ("1", "a", False), ("1", "x", True), ("2", "b", False),
    }
