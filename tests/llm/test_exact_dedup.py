import hashlib
import re
from collections import defaultdict

from helpers import frame, messy

from snapledger.llm import exact_dedup


def expected(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    groups = defaultdict(list)
    for i, t in norm.items():
        groups[t].append(i)
    return {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}


def test_groups_are_those_of_a_dictionary(spark):
    rows, docs = messy(spark)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(docs).collect()}
    assert got == expected(rows)


def test_the_filter_lets_every_repeated_digest_through(spark):
    rows = exact_dedup.fingerprints(frame(spark, [(i, f"t{i % 150}") for i in range(200)]), "doc_id", "text")
    tested = exact_dedup.possibly_repeated(rows.cache())
    repeated = {hashlib.sha256(f"t{i}".encode()).digest() for i in range(50)}
    found = {bytes(r.digest) for r in tested.filter("possible").collect()}
    assert repeated <= found and len(found) < 150


def test_repeated_rows_and_missing_ids_keep_one_row_of_a_group(spark):
    docs = frame(spark, [(5, "a  b"), (5, "a b"), (None, "a b"), (None, "z"), (7, None), (8, "")])
    got = sorted((str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in exact_dedup.exact_groups(docs).collect()))
    assert got == sorted(
        ["(5, 5, 3, True)", "(5, 5, 3, False)", "(None, 5, 3, False)", "(None, None, 1, True)", "(7, 7, 2, True)", "(8, 7, 2, False)"]
    )


def test_an_empty_table(spark):
    docs = frame(spark, [(1, "a")]).filter("doc_id < 0")
    assert exact_dedup.exact_groups(docs).collect() == []
    assert exact_dedup.without_copies(docs).collect() == []


def test_copies_go_and_columns_stay(spark):
    rows, docs = messy(spark)
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    kept = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in kept] == sorted(i for i, e in expected(rows).items() if e[2])
    given = {r.doc_id: r for r in docs.collect()}
    assert all(r == given[r.doc_id] for r in kept)


def test_no_python_in_the_plan(spark):
    _, docs = messy(spark)
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_filter_in_slices_is_the_same_and_moves_no_row(spark):
    rows = exact_dedup.written(exact_dedup.fingerprints(frame(spark, [(i, f"t{i % 150}") for i in range(200)]), "doc_id", "text"), "rows")
    whole, sliced = exact_dedup.possibly_repeated(rows), exact_dedup.possibly_repeated(rows, words_per_slice=10)
    assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.collect()))
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.findall(r"Exchange (hash|range|Round)", plan)


def test_a_digest_of_very_many_rows_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    docs = frame(spark, [(i, "hot" if i % 3 else f"t{i // 2}") for i in range(12_000)], partitions=8)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        groups = exact_dedup.exact_groups(docs)
        found = groups.collect()
        plan = groups._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(found) == 12_000 and sum(r.group_size == 8000 for r in found) == 8000
