from datetime import datetime

from snapledger.config import EntityConfig
from snapledger.operators.feed import change_feed
from snapledger.streaming import manifest

SCHEMA = "id string, v string"


def feed(spark, before, after):
    rows = change_feed(spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), "id").collect()
    return sorted(((r.id, r.v, r.action, r.is_update) for r in rows), key=str)


def test_update_is_a_delete_and_an_insert(spark):
    assert feed(spark, [("1", "a"), ("2", "b"), ("3", "c")], [("1", "x"), ("3", "c"), ("4", "d")]) == [
        ("1", "a", "DELETE", True), ("1", "x", "INSERT", True), ("2", "b", "DELETE", False), ("4", "d", "INSERT", False),
    ]


def test_null_is_a_value_and_equal_to_itself(spark):
    assert feed(spark, [("1", None), (None, "n")], [("1", None), (None, "n")]) == []
    assert feed(spark, [("1", None)], [("1", "")]) == [("1", "", "INSERT", True), ("1", None, "DELETE", True)]


def test_copies_are_netted(spark):
    assert feed(spark, [("1", "a")] * 2, [("1", "a")] * 5) == [("1", "a", "INSERT", False)] * 3
    assert feed(spark, [("1", "a")] * 3, []) == [("1", "a", "DELETE", False)] * 3


def test_row_ids_are_those_of_the_key(spark):
    rows = change_feed(
        spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA), spark.createDataFrame([("1", "x")], SCHEMA), "id"
    ).collect()
    ids = {}
    for r in rows:
        ids.setdefault(r.id, set()).add(r.row_id)
    assert all(len(v) == 1 for v in ids.values()) and ids["1"] != ids["2"]


def test_each_snapshot_is_run_once_in_order(spark, store, tmp_path):
    cfg = EntityConfig(1, "A", "s", "t", "id")
    root = str(tmp_path)
    clock = lambda: datetime(2026, 1, 1)

    def announce(snapshot_id, rows):
        path = f"{root}/snap{snapshot_id}"
        spark.createDataFrame(rows, SCHEMA).write.parquet(path)
        manifest.announce(spark, f"{root}/manifest", snapshot_id, "A", path)

    def consume():
        return manifest.stream_cdc(spark, f"{root}/manifest", cfg, store, f"{root}/checkpoint", clock)

    announce(2, [("1", "b")])
    announce(1, [("1", "a"), ("2", "x")])
    assert [r.status for r in consume()] == ["COMPLETED", "COMPLETED"]
    assert consume() == []
    log = {r.run_id: r for r in store.entity_log().collect()}
    assert (log[1].rows_inserted, log[2].rows_updated, log[2].rows_deleted) == (2, 1, 1)
    announce(3, [("1", "b"), ("3", "n")])
    assert len(consume()) == 1 and consume() == []
    assert sorted((r.id, r.v) for r in store.read_active("A").collect()) == [("1", "b"), ("3", "n")]


def test_a_crash_after_the_commit_repeats_nothing(spark, store, tmp_path, monkeypatch):
    cfg = EntityConfig(1, "A", "s", "t", "id")
    root = str(tmp_path)
    path = f"{root}/snap"
    spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), ("2", "c")], SCHEMA).write.parquet(path)
    manifest.announce(spark, f"{root}/manifest", 1, "A", path)
    real = manifest.run

    def crash(*args, **options):
        real(*args, **options)
        raise KeyboardInterrupt

    monkeypatch.setattr(manifest, "run", crash)
    try:
        manifest.stream_cdc(spark, f"{root}/manifest", cfg, store, f"{root}/checkpoint")
    except KeyboardInterrupt:
        pass
    monkeypatch.setattr(manifest, "run", real)
    assert manifest.stream_cdc(spark, f"{root}/manifest", cfg, store, f"{root}/checkpoint") == []
    assert store.entity_log().count() == 1 and store.error_log().count() == 5


def test_failed_snapshot_is_tried_again(spark, store, tmp_path):
    cfg = EntityConfig(1, "A", "s", "t", "id", length_limits={"v": 2})
    root = str(tmp_path)
    path = f"{root}/snap"
    spark.createDataFrame([("1", "long")], SCHEMA).write.parquet(path)
    manifest.announce(spark, f"{root}/manifest", 1, "A", path)
    for _ in range(2):
        (result,) = manifest.stream_cdc(spark, f"{root}/manifest", cfg, store, f"{root}/checkpoint")
        assert result.status == "FAILED"
    relaxed = EntityConfig(1, "A", "s", "t", "id")
    (result,) = manifest.stream_cdc(spark, f"{root}/manifest", relaxed, store, f"{root}/checkpoint")
    assert result.status == "COMPLETED" and store.read_active("A").count() == 1


def test_feed_is_consumed_once(spark, tmp_path):
    root = str(tmp_path)
    def publish(before, after):
        out = change_feed(spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), "id")
        out.write.mode("append").parquet(f"{root}/feed")
        return out.schema

    schema = publish([("1", "a")], [("1", "b")])
    args = (f"{root}/feed", schema, f"{root}/sink", f"{root}/checkpoint")
    assert manifest.consume(spark, *args) == 2
    assert manifest.consume(spark, *args) == 0
    publish([("1", "b")], [])
    assert manifest.consume(spark, *args) == 1
    assert manifest.consume_feed(spark, *args).count() == 3
