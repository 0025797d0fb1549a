import zlib
from collections import Counter

import pytest
from helpers import frame, messy
from pyspark.sql import functions as F

from snapledger.llm import hilbert_shards


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (2, 1), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours_in_space(spark, dims, bits):
    side = spark.range(1 << bits)
    cells = side.toDF("c0")
    for d in range(1, dims):
        cells = cells.crossJoin(side.toDF(f"c{d}"))
    names = [f"c{d}" for d in range(dims)]
    rows = cells.select(*names, hilbert_shards.curve_index([F.col(c) for c in names], bits).alias("h")).collect()
    rows.sort(key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(1 << bits * dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[c] - b[c]) for c in names) == 1


def test_shards_are_runs_of_the_curve_of_equal_length(spark):
    rows, docs = messy(spark)
    got = hilbert_shards.hilbert_shards(docs).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and set(sizes) <= set(range(24))
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1
    text = dict(rows)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data)
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    keys = [(r.curve, r.doc_id) for r in ordered]
    assert keys == sorted(keys)


def test_fewer_rows_than_shards_repeated_rows_and_an_empty_table(spark):
    docs = frame(spark, [(1, "a"), (1, "a"), (None, None)])
    got = hilbert_shards.hilbert_shards(docs).collect()
    assert len({(r.shard, r.slot) for r in got}) == 3 and all(r.slot == 0 for r in got)
    assert hilbert_shards.hilbert_shards(docs.filter("false")).collect() == []


def test_files_can_be_skipped_by_every_dimension(spark, tmp_path):
    """Shards cover boxes: on average a value of a dimension is found in few of them."""
    docs = spark.range(4096).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.pmod(F.xxhash64("id"), F.lit(64)) * 10).cast("int")).alias("text"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)).alias("a"),
    )
    placed = hilbert_shards.hilbert_shards(docs, dims=("a",))
    hilbert_shards.write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4096
    box = back.groupBy("shard").agg(F.min("a"), F.max("a"), F.min(F.length("text")), F.max(F.length("text"))).collect()
    spread_a = sum(r[2] - r[1] for r in box) / len(box) / 64
    spread_size = sum(r[4] - r[3] for r in box) / len(box) / 640
    assert spread_a < 0.5 and spread_size < 0.5


def test_no_python_in_the_plan(spark):
    _, docs = messy(spark)
    plan = hilbert_shards.hilbert_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_are_quantised_as_a_whole(spark):
    """Against a plain version: the step of a text is that of the rows with smaller texts."""
    rng = __import__("random").Random(4)
    sources = [f"https://a-very-long-common-prefix.example.org/site{k:03d}" for k in range(200)]
    values = [rng.choice(sources) for _ in range(900)] + [sources[7]] * 500 + [None] * 50 + ["", "ä", "zz"]
    docs = spark.createDataFrame([(k, "x", v) for k, v in enumerate(values)], "doc_id long, text string, source string").repartition(5)
    cuts = hilbert_shards.cuts(docs.select("source"), ["source"], 5)[0]
    known = sorted((v for v in values if v is not None), key=lambda v: v.encode())
    smaller = {}
    for k, v in enumerate(known):
        smaller.setdefault(v, k)
    steps = {v: k * 32 // len(known) for v, k in smaller.items()}
    first = {}
    for v in sorted(smaller, key=lambda v: v.encode()):
        first.setdefault(steps[v], v)
    assert cuts == [v for s, v in sorted(first.items()) if s > 0]
    placed = hilbert_shards.hilbert_shards(docs, dims=("source",)).collect()
    assert len({r.curve for r in placed}) == len(cuts) + 1


def test_equal_texts_may_be_parted_but_row_counts_hold(spark):
    docs = spark.createDataFrame([(k, "same") for k in range(100)], "doc_id long, text string")
    sizes = Counter(r.shard for r in hilbert_shards.hilbert_shards(docs, dims=()).collect())
    assert set(sizes.values()) == {4, 5} and len(sizes) == 24
