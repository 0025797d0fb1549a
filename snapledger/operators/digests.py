"""Order-independent digests of keyed rows, in two levels of key buckets.

A key belongs to one of ``BUCKETS`` buckets, and buckets make ``GROUPS`` groups. The digest of a bucket
is its number of rows and four sums over 32-bit pieces of two 64-bit hashes of the row hash. Sums of
rows that come or go are added or subtracted, so a target keeps its digests without reading its rows.
Two sides whose digests of a bucket agree hold the same rows there: unlike rows agree with a chance
of about 2^-128.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stored digests depend on them.
BUCKETS, GROUPS = 1 << 16, 1 << 8

SUMS = ["n", "s0", "s1", "s2", "s3"]
DIGEST_SCHEMA = "bucket int, n bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


def bucket(pk: str, key_type: T.DataType | None = None) -> Column:
    """The bucket of a key. Two sides whose keys differ in type name the type to compare in."""
    key = F.col(pk) if key_type is None else F.col(pk).cast(key_type)
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def group_of(bucket_number: Column) -> Column:
    return F.shiftright(bucket_number, 8)


def row_sums(row_hash: str | Column, sign: Column | int = 1) -> list[Column]:
    """What one row adds to its digest, or takes off with a ``sign`` of -1."""
    sign = F.lit(sign).cast("long") if isinstance(sign, int) else sign.cast("long")
    first, second = F.xxhash64(row_hash), F.xxhash64(F.lit(1), row_hash)
    low = F.lit((1 << 32) - 1)
    pieces = [first.bitwiseAND(low), F.shiftrightunsigned(first, 32), second.bitwiseAND(low), F.shiftrightunsigned(second, 32)]
    return [sign.alias("n"), *[(p * sign).alias(f"s{i}") for i, p in enumerate(pieces)]]


def added_up(rows: DataFrame, by: Column) -> DataFrame:
    """Digest rows added up, partially before the exchange."""
    return rows.groupBy(by.alias("bucket")).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS])


def digest(rows: DataFrame, pk: str, key_type: T.DataType | None = None, groups: bool = False) -> DataFrame:
    """Digests of rows with a valid key and ``row_hash``; per group of buckets if ``groups``."""
    place = bucket(pk, key_type)
    summed = rows.select((group_of(place) if groups else place).alias("bucket"), *row_sums("row_hash"))
    return added_up(summed, F.col("bucket"))


def as_dict(digests: DataFrame) -> dict[str, list[int]]:
    """The digests of groups (at most ``GROUPS`` rows) by number; those without a row are left out."""
    return {str(r.bucket): [r[c] for c in SUMS] for r in digests.collect() if any(r[c] for c in SUMS)}


def differing_groups(new: dict[str, list[int]], old: dict[str, list[int]]) -> list[int]:
    return sorted(int(g) for g in {*new, *old} if new.get(g) != old.get(g))


def all_counts_differ(new: dict[int, int], old: dict[str, list[int]]) -> bool:
    """Whether the rows of every single group are more or fewer than before."""
    return all(new.get(g, 0) != old.get(str(g), [0])[0] for g in range(GROUPS))


def counts_differ(rows: DataFrame, old: DataFrame, pk: str, key_type: T.DataType | None = None) -> int:
    """Buckets whose number of rows with a valid key differs from that of their digest."""
    new = rows.groupBy(bucket(pk, key_type).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    net = new.unionByName(old.select("bucket", (-F.col("n")).alias("n"))).groupBy("bucket").agg(F.sum("n").alias("n"))
    return net.where("n <> 0").count()


def differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """Buckets (one column) whose digests differ; at most ``BUCKETS`` rows."""
    signed = new.unionByName(old.select("bucket", *[(-F.col(c)).alias(c) for c in SUMS]))
    net = added_up(signed, F.col("bucket"))
    other = F.lit(False)
    for c in SUMS:
        other = other | (F.col(c) != 0)
    return net.where(other).select("bucket")


def changed_sums(changes: DataFrame, pk: str, key_type: T.DataType | None = None) -> DataFrame:
    """What classified keys add to the digests of a target: ``new_hash`` comes and ``old_hash`` goes."""
    comes, goes = F.col("cdc_class").isin("I", "U"), F.col("cdc_class").isin("U", "D")
    turns = F.array_compact(
        F.array(
            F.when(comes, F.struct(F.lit(1).alias("sign"), F.col("new_hash").alias("hash"))),
            F.when(goes, F.struct(F.lit(-1).alias("sign"), F.col("old_hash").alias("hash"))),
        )
    )
    turned = changes.where(comes | goes).select(bucket(pk, key_type).alias("bucket"), F.explode(turns).alias("t"))
    return added_up(turned.select("bucket", *row_sums(F.col("t.hash"), F.col("t.sign"))), F.col("bucket"))
