"""Row hash: SHA-256 over a canonical text form of all columns of a row.

Canonical form, encoding version 2: columns in order of their lower-case name, each written as
``name=`` then ``N`` for NULL or ``V<length>:<text>``, then ``;``. Names and lengths make the form
free of collisions between neighbouring columns, and the name order makes it independent of the
column order of the snapshot. Nested values are written by the same rules: the fields of a struct
as columns are, the elements of an array in their order, the entries of a map in the order of their
text. All built-in expressions, so the hash of flat columns stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODING_VERSION = 2


def value_text(col: Column, data_type: T.DataType) -> Column:
    """Lossless text of a value, independent of session settings; NULL for NULL."""
    if isinstance(data_type, T.BinaryType):
        return F.hex(col)
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if isinstance(data_type, T.StructType):
        fields = [F.concat(F.lit(f"{f.name.lower()}="), marked(col.getField(f.name), f.dataType)) for f in data_type]
        return F.when(col.isNotNull(), F.concat(F.lit(""), *fields))
    if isinstance(data_type, T.ArrayType):
        return F.array_join(F.transform(col, lambda x: marked(x, data_type.elementType)), "")
    if isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(col), lambda e: F.concat(marked(e["key"], data_type.keyType), marked(e["value"], data_type.valueType))
        )
        return F.array_join(F.array_sort(entries), "")
    return col.cast("string")


def marked(col: Column, data_type: T.DataType) -> Column:
    """A value inside a nested one, with its length, or the mark of NULL."""
    text = value_text(col, data_type)
    return F.coalesce(F.concat(F.lit("V"), F.char_length(text).cast("string"), F.lit(":"), text, F.lit(";")), F.lit("N;"))


def canonical_text(name: str, data_type: T.DataType) -> Column:
    """Lossless text of one column."""
    return value_text(F.col(f"`{name}`"), data_type)


def canonical_row(df: DataFrame, columns: list[str] | None = None, nulls: str = "keep") -> Column:
    if nulls not in ("keep", "drop"):
        raise ValueError(f"nulls must be 'keep' or 'drop', not {nulls!r}")
    types = {f.name: f.dataType for f in df.schema}
    parts: list[Column] = []
    for name in sorted(columns or df.columns, key=str.lower):
        text = canonical_text(name, types[name])
        tag = f"{name.lower()}="
        value = F.concat(
            F.lit(f"{tag}V"), F.char_length(text).cast("string"), F.lit(":"), text, F.lit(";")
        )
        absent = F.lit(f"{tag}N;") if nulls == "keep" else F.lit("")
        parts.append(F.coalesce(value, absent))
    return F.concat(*parts)


def with_row_hash(df: DataFrame, nulls: str = "keep", columns: list[str] | None = None) -> DataFrame:
    """Add ``row_hash`` over all columns, or over the named ones. A ``row_hash`` that comes with the
    data is replaced."""
    base = df.drop("row_hash")
    return base.withColumn("row_hash", F.sha2(canonical_row(base, columns, nulls), 256))
