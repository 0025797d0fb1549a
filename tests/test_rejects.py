"""Lines of a file that are no rows of the snapshot."""

import json
from collections import Counter

from pyspark.sql import functions as F

from snapledger.config import EntityConfig
from snapledger.operators.reports import reconcile
from snapledger.plans.run import run
from snapledger.sources.staging import load_snapshot_csv, stage_csv

SCHEMA = "id string, amount decimal(8,2), day date, note string"
GOOD = ["1,10.50,2026-01-01,a", '2,,2026-01-02,"b, c"', "3, 7 ,,", '4,1.00,2026-01-01,""']
BAD = ["5,abc,2026-01-01,x", "6,1.00,2026-13-01,x", "7,12345678.00,no day,x", "8,1.00", "9,1,2026-01-01,x,y,z", "5,abc,2026-01-01,x"]


def files(tmp_path, *parts):
    folder = tmp_path / "csv"
    folder.mkdir()
    for k, lines in enumerate(parts):
        (folder / f"{k}.csv").write_text("\n".join(["id,amount,day,note", *lines]) + "\n")
    return str(folder)


def test_bad_lines_are_kept_beside_the_rows(spark, tmp_path):
    path = files(tmp_path, [GOOD[0], BAD[0], GOOD[1], BAD[3]], [*BAD[1:3], *GOOD[2:], BAD[4], BAD[5]])
    staged = stage_csv(spark, path, SCHEMA, str(tmp_path / "out"))
    good = tmp_path / "good"
    good.mkdir()
    (good / "g.csv").write_text("\n".join(["id,amount,day,note", *GOOD]) + "\n")
    plain = load_snapshot_csv(spark, str(good), SCHEMA)
    assert Counter(map(tuple, staged.rows.collect())) == Counter(map(tuple, plain.collect()))
    assert staged.rows.schema.simpleString() == plain.schema.simpleString()
    found = sorted((r.file.rpartition("/")[2], r.line.strip(), tuple(r.columns)) for r in staged.rejected.collect())
    assert found == sorted(
        [
            ("0.csv", BAD[0], ("amount",)), ("0.csv", BAD[3], ()), ("1.csv", BAD[1], ("day",)), ("1.csv", BAD[2], ("amount", "day")),
            ("1.csv", BAD[4], ()), ("1.csv", BAD[5], ("amount",)),
        ]
    )


def test_a_clean_and_an_empty_file(spark, tmp_path):
    staged = stage_csv(spark, files(tmp_path, GOOD, []), SCHEMA, str(tmp_path / "out"))
    assert staged.rows.count() == len(GOOD) and staged.rejected.count() == 0
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("id,amount,day,note\n")
    empty = stage_csv(spark, str(tmp_path / "none"), SCHEMA, str(tmp_path / "out2"))
    assert empty.rows.count() == empty.rejected.count() == 0


def test_a_run_logs_rejected_lines_or_stops_on_them(spark, store, tmp_path):
    path = files(tmp_path, [*GOOD, BAD[0], BAD[0], BAD[3]])
    for strategy, status in (("CONTINUE", "COMPLETED"), ("STOP", "FAILED")):
        cfg = EntityConfig(1, strategy, "s", f"T_{strategy}", "id", error_strategy=strategy)
        result = run(spark, store, [cfg], lambda s, n, k=strategy: stage_csv(s, path, SCHEMA, str(tmp_path / k)))
        assert result.status == status
        lines = store.error_log().where(F.col("error_code") == "REJECTED_LINE").where(F.col("entity_name") == strategy).collect()
        assert len(lines) == 3 and len({r.error_id for r in lines}) == 3
        assert {json.loads(r.error_row)["line"].strip() for r in lines} == {BAD[0], BAD[3]}
    assert store.read_active("CONTINUE").count() == len(GOOD)


def test_equal_sides_are_told_by_digests_alone(spark):
    src = spark.range(500).selectExpr("cast(id as string) as id", "id % 7 as v")
    tgt = src.withColumn("is_active", F.lit(True))
    same = reconcile(src, tgt, ["id", "v"], both_ways=True)
    text = same._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in text and "Join" not in text
    assert {r.source: r.row_count for r in same.collect()} == {"STAGING": 500, "TARGET": 500, "DIFFERENCES": 0, "DIFFERENCES_REVERSE": 0}
    more = src.unionByName(src.where("id < 3")).unionByName(spark.sql("select 'x' as id, cast(null as bigint) as v"))
    assert {r.source: r.row_count for r in reconcile(more, tgt.where("id <> '9'"), ["id", "v"], both_ways=True).collect()} == {
        "STAGING": 500 + src.where("id < 3").count() + 1, "TARGET": 499, "DIFFERENCES": 2, "DIFFERENCES_REVERSE": 0,
    }


def test_error_rows_are_objects_and_older_text_is_still_read(spark, store):
    from datetime import datetime

    from snapledger.operators.quality import ERROR_SCHEMA
    from snapledger.operators.reports import error_fields

    at = datetime(2026, 1, 1)
    new = [("e1", 1, "A", "X", '{"id":"1","amount":12.50,"a \\"b\\"":"q","deep":{"x":[1,2]}}', at), ("e2", 1, "A", "X", "no object", at)]
    store.append_errors(1, "A", spark.createDataFrame(new, ERROR_SCHEMA))
    old = [("e0", 0, "A", "X", '{"id":"0","amount":1}', at)]
    spark.createDataFrame(old, ERROR_SCHEMA).write.parquet(f"{store.root}/logs/error_log/0/A/rows")
    stored = spark.read.parquet(f"{store.root}/logs/error_log/1/A/rows")
    assert dict(stored.dtypes)["error_object"] == "variant" and stored.where("error_row is not null").count() == 1
    fields = error_fields(store.error_objects(), {"id": "string", "amount": "decimal(8,2)", 'a "b"': "string", "deep": "struct<x:array<int>>", "none": "int"})
    rows = {r.error_id: r for r in fields.collect()}
    assert [str(rows["e1"][c]) for c in ("id", "amount", 'a "b"', "none")] == ["1", "12.50", "q", "None"] and rows["e1"].deep.x == [1, 2]
    assert (rows["e0"].id, str(rows["e0"].amount), rows["e2"].id) == ("0", "1.00", None)
    texts = {r.error_id: r.error_row for r in store.error_log().collect()}
    assert texts["e2"] == "no object" and json.loads(texts["e0"]) == {"id": "0", "amount": 1} and json.loads(texts["e1"])["deep"] == {"x": [1, 2]}
    plan = fields.select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan.lower()
