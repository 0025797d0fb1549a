from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapledger.functions.hashing import with_row_hash
from snapledger.operators.keys import key_summary


def hashes(df, **options):
    return [r.row_hash for r in with_row_hash(df, **options).select("row_hash").collect()]


def test_hash_is_sha256_hex(spark):
    (h,) = hashes(spark.sql("select 'a' as k, 1 as v"))
    assert len(h) == 64 and set(h) <= set("0123456789abcdef")


def test_hash_does_not_depend_on_column_order(spark):
    df = spark.sql("select 'a' as k, 1 as v, cast(null as string) as n")
    assert hashes(df) == hashes(df.select("n", "v", "k"))


def test_incoming_hash_is_replaced(spark):
    df = spark.sql("select 'a' as k, 1 as v")
    assert hashes(df) == hashes(df.withColumn("row_hash", F.lit("stale")))


@pytest.mark.parametrize(
    "left,right",
    [
        (("a|", "b"), ("a", "|b")),
        (("a;", "b"), ("a", ";b")),
        ((None, "b"), ("", "b")),
        ((None, "b"), ("N", "b")),
        ((None, "b"), ("b", None)),
        (("V1:x;", ""), ("V1:x", ";")),
    ],
)
def test_neighbouring_columns_do_not_collide(spark, left, right):
    a, b = hashes(spark.createDataFrame([left, right], "x string, y string"))
    assert a != b


@pytest.mark.parametrize("nulls,same", [("keep", False), ("drop", True)])
def test_new_null_column(spark, nulls, same):
    old = spark.sql("select 'a' as k, 1 as v")
    new = old.withColumn("added", F.lit(None).cast("string"))
    assert (hashes(old, nulls=nulls) == hashes(new, nulls=nulls)) is same


def test_unknown_null_mode(spark):
    with pytest.raises(ValueError):
        with_row_hash(spark.range(1), nulls="maybe")


def test_doubles_are_hashed_without_loss(spark):
    df = spark.createDataFrame([(1.001,), (1.002,), (1.2345678e7,), (12345678.0,)], "v double")
    a, b, c, d = hashes(df)
    assert a != b and c == d


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    query = "select timestamp_micros(1700000000123456) as ts, timestamp_ntz'2024-01-01 00:00:00' as n"
    before = hashes(spark.sql(query))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert hashes(spark.sql(query)) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nested_and_binary_columns(spark):
    df = spark.sql(
        "select * from values (map('a', 1, 'b', 2), array(1, null), named_struct('x', null), X'FF'),"
        " (map('b', 2, 'a', 1), array(1, null), named_struct('x', null), X'FF'),"
        " (map('a', 1, 'b', 2), array(1), named_struct('x', null), X'FF'),"
        " (map('a', 1, 'b', 2), array(1, null), named_struct('x', null), X'FE') as t(m, a, s, b)"
    )
    a, b, c, d = hashes(df)
    assert a == b and len({a, c, d}) == 3


def test_nested_values_lose_nothing(spark):
    def of(micros):
        t = f"timestamp_micros({micros})"
        n = f"cast({t} as timestamp_ntz)"
        return spark.sql(f"select named_struct('a', {t}, 'b', {n}) as s, array({t}) as a, map('k', {t}) as m, map('k', named_struct('x', {n})) as d")

    for name in ("s", "a", "m", "d"):
        assert hashes(of(1700000000123456).select(name)) != hashes(of(1700000000123464).select(name)), name
    zone, before = spark.conf.get("spark.sql.session.timeZone"), hashes(of(1700000000123456).select("s", "a", "m"))
    text = "named_struct('m', map('a', 1, 'b', 2)) as s"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        instants = spark.sql("select array(timestamp_micros(1700000000123456)) as a, map('k', timestamp_micros(1700000000123456)) as m")
        mine = hashes(instants)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert mine == hashes(of(1700000000123456).select("a", "m")) and before
    assert hashes(spark.sql(f"select {text}")) == hashes(spark.sql("select named_struct('m', map('b', 2, 'a', 1)) as s"))


def test_neighbouring_nested_values_do_not_collide(spark):
    df = spark.sql(
        "select * from values (array('a;', 'b'), named_struct('x', 'N;', 'y', cast(null as string))),"
        " (array('a', ';b'), named_struct('x', cast(null as string), 'y', 'N;')),"
        " (array('a;b'), named_struct('x', 'N;y=N;', 'y', '')), (cast(array() as array<string>), cast(null as struct<x:string,y:string>)),"
        " (cast(null as array<string>), named_struct('x', cast(null as string), 'y', cast(null as string))) as t(a, s)"
    )
    for name in ("a", "s"):
        assert len(set(hashes(df.select(name)))) == 5, name


def test_decimal_scale_is_part_of_the_text(spark):
    df = spark.createDataFrame([(Decimal("1.50"),), (Decimal("1.5"),)], "v decimal(18,2)")
    a, b = hashes(df)
    assert a == b


def test_a_hash_is_folded_as_whole_numbers_without_loss(spark):
    """Digits at both ends of the range of a number, and leading zeros, come back as they were."""
    hashes = ["0" * 64, "f" * 64, "8" + "0" * 63, "7" + "f" * 63, "0" * 15 + "1" + "f" * 16 + "8" + "0" * 15 + "0" * 15 + "a", "0123456789abcdef" * 4]
    rows = spark.createDataFrame([(f"k{i}", h) for i, h in enumerate(hashes)] + [("twice", hashes[0]), ("twice", hashes[4])], "id string, row_hash string")
    found = {r.id: r for r in key_summary(rows, "id").collect()}
    assert [found[f"k{i}"].only_hash for i in range(len(hashes))] == hashes
    assert found["twice"].is_conflict and not found["k1"].is_conflict
    assert plan_numbers(rows) == 4


def plan_numbers(rows):
    """Numbers that are made of a hash: each once, not again for the other end."""
    optimized = key_summary(rows, "id")._jdf.queryExecution().optimizedPlan().toString()
    return optimized.count("conv(")
