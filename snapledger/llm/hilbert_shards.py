"""Shards along a Hilbert curve over several metadata dimensions; DataFrame functions only.

Each dimension is quantised to 2^bits steps of near equal depth, the steps are the coordinates of a
cell, and the rows are sorted by the cell's index on the curve. Shards are runs of that order, so
each shard covers a compact box and a reader can skip files by the minimum and maximum of every
dimension at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import as_text, running_total, written

BITS = 5
SHARDS = 24
#: Bytes counted per row besides its text.
ROW_BYTES = 8


def ordinal(name: str, kind: T.DataType) -> Column:
    """A value that is quantised by its order: a text as a whole, anything else as a number. NULL stays NULL."""
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return col
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return F.when(~F.isnan(col.cast("double")), col.cast("double"))


def text_cuts(rows: DataFrame, name: str, bits: int) -> list[str]:
    """The at most 2^bits - 1 texts at which a new step begins. Different texts are counted and put in
    order as a whole; a text belongs to the step that the rows before it have reached."""
    counted = rows.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(written(counted, "values"), ["value"], "n")
    total = F.lit(ranked.agg(F.sum("n")).first()[0] or 1)
    stepped = ranked.groupBy(F.floor(F.col("start") * (1 << bits) / total).alias("step")).agg(F.min("value").alias("value"))
    return sorted((r.value for r in stepped.filter("step > 0").collect()), key=lambda v: v.encode())


def cuts(rows: DataFrame, names: list[str], bits: int) -> list[list]:
    """Per dimension the at most 2^bits - 1 values at which a new step begins."""
    steps = 1 << bits
    parts = ", ".join(repr(i / steps) + "D" for i in range(1, steps))
    texts = {f.name for f in rows.schema if isinstance(f.dataType, T.StringType)}
    numbers = [n for n in names if n not in texts]
    found = {}
    if numbers:
        found = rows.agg(*[F.expr(f"percentile_approx(`{n}`, array({parts}), 10000)").alias(n) for n in numbers]).first().asDict()
    return [text_cuts(rows, n, bits) if n in texts else sorted(set(found[n] or [])) for n in names]


def step(name: str, bounds: list) -> Column:
    """How many bounds a value reaches; NULL is in the lowest step."""
    if not bounds:
        return F.lit(0).cast("long")
    edges = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.size(F.filter(edges, lambda b: b <= F.col(name))), F.lit(0)).cast("long")


def curve_index(steps: list[Column], bits: int) -> Column:
    """The position on the Hilbert curve, by exclusive-ors of the coordinates from high bit to low."""
    n = len(steps)
    start = F.array(*steps)
    levels = F.array(*[F.lit(1 << q).cast("long") for q in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<bigint>")
    axes = F.array(*[F.lit(i) for i in range(n)])

    def turn(x: Column, q: Column, i: Column) -> Column:
        high = F.get(x, i).bitwiseAND(q) != 0
        swap = F.when(high, F.lit(0).cast("long")).otherwise(F.get(x, F.lit(0)).bitwiseXOR(F.get(x, i)).bitwiseAND(q - 1))
        lead = F.when(high, F.get(x, F.lit(0)).bitwiseXOR(q - 1)).otherwise(F.get(x, F.lit(0)).bitwiseXOR(swap))
        return F.transform(x, lambda v, k: F.when(k == 0, lead).when(k == i, v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(levels, start, lambda x, q: F.aggregate(axes, x, lambda y, i: turn(y, q, i)))
    empty = F.array().cast("array<bigint>")
    prefix = F.aggregate(
        turned,
        empty,
        lambda done, v: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long")).bitwiseXOR(v))),
    )

    def flipped(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        mask = F.aggregate(
            levels, F.lit(0).cast("long"), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
        )
        return F.transform(x, lambda v: v.bitwiseXOR(mask))

    def joined(x: Column) -> Column:
        order = F.array(*[F.lit(q) for q in range(bits - 1, -1, -1)])
        return F.aggregate(
            order,
            F.lit(0).cast("long"),
            lambda h, q: F.aggregate(x, h, lambda g, v: g * 2 + F.floor(v / F.pow(F.lit(2), q)).cast("long") % 2),
        )

    # transform() over one element names a value that is used several times.
    once = F.transform(F.array(prefix), lambda x: flipped(x))
    return F.get(F.transform(once, lambda x: joined(x)), F.lit(0))


def hilbert_order(rows: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve``: the index on the curve of the cell that the dimensions fall into."""
    kinds = {f.name: f.dataType for f in rows.schema}
    names = [f"_o{i}" for i in range(len(dims))]
    rows = rows.select("*", *[ordinal(d, kinds[d]).alias(n) for d, n in zip(dims, names)])
    bounds = cuts(rows, names, bits)
    return rows.withColumn("curve", curve_index([step(n, b) for n, b in zip(names, bounds)], bits)).drop(*names)


def hilbert_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: tuple[str, ...] = ("lang", "source"),
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, curve, shard, slot.

    The dimensions are ``dims`` and the size (bytes of the text plus eight). Shards are runs of the
    curve whose row counts differ by one at most; ``slot`` numbers the rows of a shard from zero in
    the order of the curve. Rows in one cell follow in the order of id, size and checksum, NULL ids
    first; rows equal in all of these are interchangeable and get one slot each. Equal texts are a
    group, but row counts are the law that holds: they lie near one another as far as their
    dimensions agree, and a shard may end between them. NULL text: no bytes. A dimension that is NULL counts as lowest. With fewer rows than shards some shards stay
    empty. Columns that ``docs`` has besides are not read.
    """
    text = as_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *[F.col(d).alias(f"_d{i}") for i, d in enumerate(dims)],
    )
    rows = written(rows, "sizes")
    placed = hilbert_order(rows, [*(f"_d{i}" for i in range(len(dims))), "size"], bits)
    placed = written(placed.drop(*(f"_d{i}" for i in range(len(dims)))), "curve")
    total = placed.count()
    ranked = running_total(placed, ["curve", "doc_id", "size", "text_crc32"])
    shard = F.expr(f"(start * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("start") - first).cast("long"))
        .drop("start")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """``docs`` as one folder per shard, rows in curve order. Ids must be unique and not NULL.

    A shard may be far larger than a file should be: the rows are dealt by ranges of (shard, slot),
    so a shard is spread over as many files as its share of the partitions.
    """
    place = placed.select(F.col("doc_id").alias(id_col), "shard", "slot")
    rows = docs.drop("shard", "slot").join(place, id_col)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
