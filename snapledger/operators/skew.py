"""Joins and expansions that hold when one key carries a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.session import new_dir

# Rows of one key that a reduce task takes; a heavier key is dealt to several tasks.
ROWS_PER_TASK = 1_000_000

# Bytes of texts of one key that a reduce task takes. Rows may be long, so a key of fewer rows is dealt too.
BYTES_PER_TASK = 16 << 20

# Copies of one row are written out in runs of this many.
COPIES_PER_RUN = 65536

# Listed keys that may be broadcast once they are counted.
LISTED_KEYS = 1_000_000


def _dealt(rows: DataFrame, heavy: DataFrame, pk: str) -> DataFrame:
    """``rows`` with ``_deal``: 0, or for a heavy key (``_deals`` tasks) one of its tasks.

    ``heavy`` is broadcast: each of its keys has over ``ROWS_PER_TASK`` rows or ``BYTES_PER_TASK`` bytes, so
    there is at most one in so many. The deal follows from the place of the row in its partition: snapshots are
    read from files, so a repeated task deals alike.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())
    marked = rows.join(F.broadcast(heavy), pk, "left")
    return marked.withColumn("_deal", F.coalesce(F.pmod(spread, F.col("_deals")), F.lit(0))).drop("_deals")


def _deals(rows_of_key: str, bytes_of_key: str | None = None):
    by_rows = F.ceil(F.col(rows_of_key) / F.lit(ROWS_PER_TASK)).cast("long")
    if bytes_of_key is None:
        return by_rows
    return F.greatest(by_rows, F.ceil(F.col(bytes_of_key) / F.lit(BYTES_PER_TASK)).cast("long"))


def text_bytes(rows: DataFrame) -> Column:
    """Bytes of the texts of a row; all other columns are taken as short."""
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)).cast("long") for f in rows.schema if f.dataType.typeName() in ("string", "binary")]
    return reduce(lambda a, b: a + b, sizes, F.lit(0).cast("long"))


def match_keys(
    rows: DataFrame, keys: DataFrame, pk: str, weight: str, keys_fit: bool = False, size: str | None = None
) -> DataFrame:
    """Inner join of ``rows`` with ``keys`` (one row per key, ``weight`` = rows of that key, ``size`` = their
    bytes if they are known).

    A key with more rows or bytes than a task takes is dealt to as many tasks as it asks for, and its
    row of ``keys`` goes to each of them. ``keys_fit`` says that the caller measured ``keys`` and that
    all of them may be broadcast.
    """
    if keys_fit:
        return rows.join(F.broadcast(keys), pk)
    deals = _deals(weight, size)
    heavy = keys.where(deals > 1).select(pk, deals.alias("_deals"))
    copied = keys.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(deals, F.lit(1)) - 1)))
    return _dealt(rows, heavy, pk).join(copied, [pk, "_deal"]).drop("_deal")


def flag_keys(rows: DataFrame, keys: DataFrame, pk: str, flag: str) -> DataFrame:
    """``rows`` with a flag that says whether their key is in ``keys`` (its only column, named as
    ``pk``).

    The listed keys are written and counted once. Few of them are broadcast, and the rows stay where
    they are. Otherwise rows and keys meet by a shuffle, with heavy keys of the rows dealt to several
    tasks and rows without a key dealt evenly.
    """
    listed = keys.where(F.col(pk).isNotNull()).distinct()
    path = new_dir(rows.sparkSession, "listed")
    listed.write.parquet(path)
    listed = rows.sparkSession.read.schema(listed.schema).parquet(path)
    found = F.coalesce(flag, F.lit(False)).alias(flag)
    if listed.count() <= LISTED_KEYS:
        marked = rows.join(F.broadcast(listed.withColumn(flag, F.lit(True))), pk, "left")
        return marked.select(*rows.columns, found)
    heavy = (
        rows.where(F.col(pk).isNotNull())
        .groupBy(pk)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > ROWS_PER_TASK)
        .select(pk, _deals("_n").alias("_deals"))
    )
    copied = listed.join(F.broadcast(heavy), pk, "left").select(
        pk, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_deals", F.lit(1)) - 1)).alias("_deal"), F.lit(True).alias(flag)
    )
    dealt = _dealt(rows, heavy, pk)
    everywhere = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    dealt = dealt.withColumn("_deal", F.when(F.col(pk).isNull(), everywhere).otherwise(F.col("_deal")))
    return dealt.join(copied, [pk, "_deal"], "left").select(*rows.columns, found)


def count_copies(rows: DataFrame, name: str = "_copies") -> DataFrame:
    """Equal rows folded into one with their number. The map side folds most of a hot group."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count(F.lit(1)).alias(name))


def expand_copies(rows: DataFrame, copies: str = "_copies", ordinal: str = "_ordinal") -> DataFrame:
    """Inverse of :func:`count_copies`: one row per copy, numbered from 1.

    A row with few copies is written out where it is. One with more than ``COPIES_PER_RUN`` is first
    cut into runs, the runs are spread over the cluster, and only then is each run written out.
    """
    total = F.col(copies)
    first = F.lit(1).cast("long")
    few = rows.where(total <= COPIES_PER_RUN).withColumn(ordinal, F.explode(F.sequence(first, total)))
    many = rows.where(total > COPIES_PER_RUN).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / COPIES_PER_RUN)))
    )
    spread = many.repartition(*[F.col(f"`{c}`") for c in many.columns])
    begin = F.col("_run") * COPIES_PER_RUN + 1
    end = F.least(total, (F.col("_run") + 1) * COPIES_PER_RUN)
    return few.unionByName(spread.withColumn(ordinal, F.explode(F.sequence(begin, end))).drop("_run"))
