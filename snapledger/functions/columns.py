"""Column conventions shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control columns of a target table, in table order.
CONTROL_COLUMNS = ["row_hash", "start_ts", "end_ts", "is_active", "cdc_operation"]

CONTROL_TYPES = {
    "row_hash": T.StringType(),
    "start_ts": T.TimestampNTZType(),
    "end_ts": T.TimestampNTZType(),
    "is_active": T.BooleanType(),
    "cdc_operation": T.StringType(),
}


def business_columns(df: DataFrame, pk: str) -> list[str]:
    """All columns but the key and the control columns; may be empty for a key-only table."""
    reserved = {c.lower() for c in CONTROL_COLUMNS} | {pk.lower()}
    return [c for c in df.columns if c.lower() not in reserved]


def find_column(names: list[str], wanted: str) -> str | None:
    """The name as it is spelled in ``names``; upper and lower case do not matter."""
    return next((n for n in names if n.lower() == wanted.lower()), None)


def spelled_like(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with its columns spelled as in ``names`` where they are the same but for case."""
    return df.toDF(*[find_column(names, c) or c for c in df.columns])


def key_text(pk: str) -> Column:
    """The key as text. Without the cast a numeric key cannot be compared with ``''``."""
    return F.col(pk).cast("string")


def valid_key(pk: str) -> Column:
    return F.col(pk).isNotNull() & (key_text(pk) != "")


def ts_literal(ts) -> Column:
    """A run timestamp (text, datetime or Column) as a time-zone free timestamp."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    return F.lit(str(ts)).cast("timestamp_ntz")


def target_schema(staging: T.StructType, pk: str) -> T.StructType:
    """Schema of a target for this staging schema: control columns, key, business columns."""
    reserved = {c.lower() for c in CONTROL_COLUMNS}
    control = [T.StructField(c, CONTROL_TYPES[c]) for c in CONTROL_COLUMNS]
    key = [T.StructField(f.name, f.dataType) for f in staging if f.name.lower() == pk.lower()]
    rest = [
        T.StructField(f.name, f.dataType)
        for f in staging
        if f.name.lower() not in reserved | {pk.lower()}
    ]
    return T.StructType(control + key + rest)
