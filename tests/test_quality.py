import json

import pytest
from pyspark.sql import functions as F

from snapledger.functions.hashing import with_row_hash
from snapledger.operators import quality, skew


@pytest.fixture
def src(spark):
    rows = [
        ("k1", 1), ("k1", 1), ("k1", 2),  # two equal rows and another version
        ("k2", 5),
        ("k3", 7), ("k3", 7),
        ("", 9), ("", 9), ("", 8),
        (None, 3), (None, 3),
    ]
    return with_row_hash(spark.createDataFrame(rows, "id string, v int"))


def pairs(df):
    return sorted(((r.id, r.v) for r in df.collect()), key=str)


def test_duplicate_inserts_are_all_rows_of_a_group(src):
    found = quality.duplicate_inserts(src, "id")
    assert pairs(found) == [("", 9), ("", 9), ("k1", 1), ("k1", 1), ("k3", 7), ("k3", 7)]
    assert {r.cnt for r in found.collect()} == {2}
    assert pairs(quality.duplicate_inserts(src, "id", include_empty_key=False)) == [
        ("k1", 1), ("k1", 1), ("k3", 7), ("k3", 7),
    ]


def test_duplicate_updates_overlap_with_duplicate_inserts(src):
    assert pairs(quality.duplicate_updates(src, "id")) == [
        ("", 8), ("", 9), ("", 9), ("k1", 1), ("k1", 1), ("k1", 2),
    ]
    assert pairs(quality.duplicate_updates(src, "id", include_empty_key=False)) == [
        ("k1", 1), ("k1", 1), ("k1", 2),
    ]


def test_key_errors(src):
    assert pairs(quality.key_errors(src, "id")) == [("", 8), ("", 9), ("", 9), (None, 3), (None, 3)]


def test_numeric_key(spark):
    src = with_row_hash(spark.sql("select * from values (1, 'a'), (null, 'b') as t(id, v)"))
    assert [r.v for r in quality.key_errors(src, "id").collect()] == ["b"]
    assert quality.detect_errors(src, "id", 1, "E", "2026-01-01 00:00:00").count() == 1


def test_detected_errors(src):
    errors = quality.detect_errors(src, "id", 3, "E", "2026-01-01 00:00:00").collect()
    codes = [e.error_code for e in errors]
    assert {c: codes.count(c) for c in set(codes)} == {
        "DUPLICATE_INSERT": 6, "DUPLICATE_UPDATE": 6, "PRIMARY_KEY_ERROR": 5,
    }
    assert len({e.error_id for e in errors}) == len(errors)
    assert all(e.run_id == 3 and e.entity_name == "E" for e in errors)
    missing = [json.loads(e.error_row) for e in errors if e.error_code == "PRIMARY_KEY_ERROR"]
    assert sorted("id" in m for m in missing) == [False, False, True, True, True]
    assert all("row_hash" in m for m in missing)
    assert {json.loads(e.error_row)["cnt"] for e in errors if e.error_code == "DUPLICATE_INSERT"} == {2}


def test_error_ids_are_the_same_when_computed_again(src):
    def ids():
        return {r.error_id for r in quality.detect_errors(src.repartition(3), "id", 3, "E", "2026-01-01").collect()}

    assert ids() == ids()


def test_known_keys_give_the_same_errors(src):
    from snapledger.operators.keys import repeated_keys

    def ids(**options):
        return {r.error_id for r in quality.detect_errors(src, "id", 3, "E", "2026-01-01", **options).collect()}

    assert ids() == ids(keys=repeated_keys(src, "id"), keys_fit=True) == ids(keys=repeated_keys(src, "id"))


def test_error_counts(src):
    counts = quality.error_counts(quality.detect_errors(src, "id", 1, "E", "2026-01-01")).first()
    assert tuple(counts) == (6, 6, 5)


def test_error_counts_of_nothing(spark, src):
    none = quality.detect_errors(src.where("id = 'k2'"), "id", 1, "E", "2026-01-01")
    assert tuple(quality.error_counts(none).first()) == (0, 0, 0)


def test_length_violations(spark):
    df = spark.createDataFrame([("a", "NL"), ("b", "NLD"), ("c", None)], "id string, country string")
    assert [r.id for r in quality.length_violations(df, {"country": 2}).collect()] == ["b"]
    assert quality.length_violations(df, {}).count() == 0


def test_many_copies_are_written_out_in_runs(spark, monkeypatch):
    monkeypatch.setattr(skew, "COPIES_PER_RUN", 10)
    rows = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 47)], "id string, _copies bigint")
    out = skew.expand_copies(rows).groupBy("id").agg(
        F.count("*").alias("n"), F.min("_ordinal").alias("lo"), F.max("_ordinal").alias("hi"),
        F.count_distinct("_ordinal").alias("u"),
    )
    assert {r.id: (r.n, r.lo, r.hi, r.u) for r in out.collect()} == {
        "a": (1, 1, 1, 1), "b": (10, 1, 10, 10), "c": (11, 1, 11, 11), "d": (47, 1, 47, 47),
    }


@pytest.mark.parametrize("heavy", [10, 100, 1000])
def test_heavy_and_light_keys_make_up_the_whole_join(spark, monkeypatch, heavy):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", heavy)
    rows = spark.range(1000).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % 7) end as id", "id as v")
    keys = rows.where("id <> 'k2'").groupBy("id").agg(F.count("*").alias("n"))
    joined = skew.match_keys(rows, keys, "id", "n")
    expected = rows.join(keys, "id")
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    assert joined.count() == rows.where("id <> 'k2'").count()


def test_counts_without_error_rows(src):
    assert tuple(quality.count_errors(src, "id").first()) == (6, 6, 5)
    assert tuple(quality.count_errors(src, "id", include_empty_key=False).first()) == (4, 3, 5)
    assert tuple(quality.count_errors(src.where("id = 'k2'"), "id").first()) == (0, 0, 0)


def test_a_key_of_few_long_rows_is_dealt_to_several_tasks(spark, monkeypatch):
    """100 rows of one key are far fewer than a task takes, but their texts are more bytes than that."""
    monkeypatch.setattr(skew, "BYTES_PER_TASK", 1000, raising=False)
    seen = []
    monkeypatch.setattr(skew, "_dealt", lambda rows, *a, f=skew._dealt: seen.append(f(rows, *a)) or seen[-1])
    src = with_row_hash(spark.range(100).selectExpr("'only' as id", "repeat(cast(id % 50 as string), 50) as v"))
    assert quality.duplicate_updates(src, "id").count() == 100
    assert seen[0].select("_deal").distinct().count() > 1


def test_rows_without_a_twin_do_not_travel_to_find_the_others(spark, monkeypatch):
    """Of 100 rows of one key 20 have a twin, and these alone are folded as a whole."""
    folded = []
    monkeypatch.setattr(quality, "count_copies", lambda rows, f=skew.count_copies: folded.append(rows) or f(rows))
    src = with_row_hash(spark.range(100).selectExpr("'only' as id", "if(id < 20, id % 10, id) as v"))
    assert sorted((r.v, r.cnt) for r in quality.duplicate_inserts(src, "id").collect()) == sorted([(v, 2) for v in range(10)] * 2)
    assert folded[0].count() == 20
