"""Per-key view of a snapshot. Every operator that needs to know how often a key occurs uses it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.columns import valid_key
from snapledger.operators.skew import flag_keys, text_bytes

# Where the four parts of a hexadecimal SHA-256 begin, each of as many digits as a signed whole number holds.
HASH_PARTS, PART_DIGITS = [1, 17, 33, 49], 16


def active(target: DataFrame) -> DataFrame:
    """The current versions. Stored targets keep them in their own directory, so this prunes."""
    return target.where(F.col("is_active"))


def key_summary(src: DataFrame, pk: str, sized: bool = False) -> DataFrame:
    """One narrow row per key that is not NULL: row count, whether its rows differ, and the hash of
    its row if they don't. ``row_hash`` is the hexadecimal text of :func:`with_row_hash`.

    The hash is folded as four whole numbers that hold all its digits. Their minima and maxima are
    equal exactly when all rows of the key are equal, so no row is ever compared with another one,
    and numbers are aggregated in place, where texts would have to be sorted first. Partial
    aggregation folds a hot key before the shuffle. ``sized`` adds ``n_bytes``, the bytes of all texts of
    the key's rows.
    """
    more = [text_bytes(src).alias("_bytes")] if sized else []
    total = [F.sum("_bytes").alias("n_bytes")] if sized else []
    parts = [F.conv(F.substring("row_hash", at, PART_DIGITS), 16, -10).cast("long") for at in HASH_PARTS]
    # In columns of their own, or each number would be made for the minimum and again for the maximum.
    rows = src.where(F.col(pk).isNotNull()).select(pk, *more, *[v.alias(f"_part{i}") for i, v in enumerate(parts)])
    low = [F.min(f"_part{i}").alias(f"_low{i}") for i in range(len(parts))]
    high = [F.max(f"_part{i}").alias(f"_high{i}") for i in range(len(parts))]
    folded = rows.groupBy(pk).agg(F.count(F.lit(1)).alias("n_rows"), *total, *low, *high)
    differs = reduce(lambda a, b: a | b, [F.col(f"_low{i}") != F.col(f"_high{i}") for i in range(len(HASH_PARTS))])
    digits = [F.lpad(F.hex(f"_low{i}"), PART_DIGITS, "0") for i in range(len(HASH_PARTS))]
    known = ["n_bytes"] if sized else []
    return folded.select(pk, "n_rows", differs.alias("is_conflict"), F.lower(F.concat(*digits)).alias("only_hash"), *known)


def repeated_keys(src: DataFrame, pk: str, sized: bool = False) -> DataFrame:
    """Keys that occur more than once: ``(pk, n_rows, is_conflict)``, and ``n_bytes`` of their texts if ``sized``."""
    return key_summary(src, pk, sized).where(F.col("n_rows") > 1).drop("only_hash")


def unique_rows(src: DataFrame, pk: str) -> DataFrame:
    """Rows whose key is valid and occurs exactly once. All rows of a repeated key are left out.

    The repeated keys are counted in a narrow pass that folds each key on the map side, and written.
    Few of them are broadcast; more meet the rows by a shuffle that deals heavy keys to several tasks.
    """
    valid = src.where(valid_key(pk))
    repeated = valid.groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return flag_keys(valid, repeated.select(pk), pk, "_repeated").where("not _repeated").select(*src.columns)
