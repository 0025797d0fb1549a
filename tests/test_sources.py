from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.operators import corrections
from snapledger.plans.run import run_entity
from snapledger.sources import generate, staging

HEADER = "EMPLOYEE_ID,SALARY,MANAGER,DEPARTMENT\n"


def test_csv_with_missing_keys(spark, store, tmp_path):
    path = tmp_path / "employees.csv"
    path.write_text(HEADER + "R000001,2100,Eva,Sales\n,3200,Bob,Tester\nR000003,4300,,Sales\n")
    snapshot = staging.load_snapshot_csv(spark, str(path), staging.EMPLOYEE)
    rows = {r.salary: r for r in snapshot.collect()}
    assert [r.employee_id for r in rows.values()] == ["R000001", None, "R000003"]
    assert rows[4300].manager is None
    cfg = EntityConfig(1, "Employee", "s", "t", "employee_id")
    counters = run_entity(spark, store, cfg, snapshot, 1)
    assert (counters["rows_inserted"], counters["key_errors"]) == (2, 1)


def test_quoted_empty_fields_are_empty_texts(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text(HEADER + '"",2100,"",Sales\n,"",Bob,""\n"R1","4300","a b, c",\n')
    rows = sorted((tuple(map(str, r)) for r in staging.load_snapshot_csv(spark, str(path), staging.EMPLOYEE).collect()))
    assert rows == [("", "2100.00", "", "Sales"), ("None", "None", "Bob", ""), ("R1", "4300.00", 'a b, c', "None")]


def test_a_table_is_emptied_and_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", 2)], "id string, v int").write.parquet(path)
    staging.empty_table(spark, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id", "v"]


def test_generated_employees_do_not_depend_on_partitions(spark):
    a = generate.generate_employees(spark, 500, seed=1)
    b = generate.generate_employees(spark, 500, seed=1).repartition(7)
    assert a.exceptAll(b).isEmpty()
    assert not a.exceptAll(generate.generate_employees(spark, 500, seed=2)).isEmpty()
    s = a.agg(
        F.count_distinct("employee_id").alias("ids"), F.min("employee_id").alias("first"),
        F.min("salary").alias("lo"), F.max("salary").alias("hi"),
        F.collect_set("manager").alias("m"), F.collect_set("department").alias("d"),
    ).first()
    assert (s.ids, s.first) == (500, "R000001") and s.lo >= 2000 and s.hi < 10000
    assert set(s.m) == set(generate.MANAGERS) and set(s.d) == set(generate.DEPARTMENTS)


def test_patch_and_drop_by_list_and_by_frame(spark):
    df = spark.createDataFrame([("1", 10), ("2", 20), ("2", 21), (None, 30)], "id string, v int")
    listed = spark.createDataFrame([("2",), ("2",), ("9",)], "k string")
    for keys in (["2", "9"], listed):
        patched = corrections.patch_snapshot(df, "id", keys, {"v": F.col("v") + 400})
        assert sorted(r.v for r in patched.collect()) == [10, 30, 420, 421]
        kept = corrections.drop_keys(df, "id", keys)
        assert sorted(r.v for r in kept.collect()) == [10, 30]


def test_append_load_keeps_faulty_rows(spark):
    schema = "id string, naam string, woonplaats string"
    first = spark.createDataFrame([("1", "John Doe", "Arnhem"), ("2", "Jane Doe", "Arnhem")], schema)
    second = spark.createDataFrame([("2", "Jane de Wit", "Maastricht"), ("", "Emma Ptykee", "Rotterdam")], schema)
    assert [r.id for r in corrections.append_load([first, second], "id").collect()] == ["", "1", "2", "2"]


def test_flags_with_heavy_and_missing_keys(spark, monkeypatch):
    from snapledger.operators import skew

    rows = spark.range(600).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('k', id % 10) end as id", "id as v"
    )
    listed = spark.createDataFrame([("hot",), ("k1",), ("k1",), (None,), ("none",)], "id string")
    for listed_keys, per_task in ((0, 7), (0, 1000), (100, 7)):
        monkeypatch.setattr(skew, "LISTED_KEYS", listed_keys)
        monkeypatch.setattr(skew, "ROWS_PER_TASK", per_task)
        out = skew.flag_keys(rows, listed, "id", "hit")
        assert out.count() == 600
        assert out.where("hit <> coalesce(id in ('hot', 'k1'), false)").isEmpty()
