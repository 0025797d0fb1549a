"""Tiny frames that the optimizer knows to be tiny: one row of given values, or no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def one_row(spark: SparkSession, schema: str | T.StructType, values: tuple) -> DataFrame:
    fields = _schema(schema).fields

    def cell(value, field: T.StructField) -> Column:
        literal = F.lit(str(value)) if isinstance(field.dataType, T.TimestampNTZType) else F.lit(value)
        return literal.cast(field.dataType).alias(field.name)

    return spark.range(0, 1, 1, 1).select(*[cell(v, f) for v, f in zip(values, fields, strict=True)])


def no_rows(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """An empty frame that joins and unions are planned away with."""
    fields = _schema(schema).fields
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(0, 1, 1, 1).select(*nulls).where(F.lit(False))
