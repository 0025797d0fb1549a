"""Reading full snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schemas of the three sample entities.
EMPLOYEE = "employee_id string, salary decimal(18,2), manager string, department string"
CUSTOMER = "customer_id string, customer_name string, email string, country string, registration_date date"
ORDER = "order_id string, customer_id string, order_date date, total_amount decimal(18,2), status string"

# Most characters the customer target holds.
CUSTOMER_LIMITS = {"customer_name": 50, "email": 50, "country": 2}

# What an empty field without quotes is read as; no text of a file can be equal to it.
MISSING = "\ue000missing\ue000"


def load_snapshot_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """A comma-separated snapshot with one header line. An empty field is NULL; a quoted empty field
    is the empty text, or NULL in a column of another type."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    read = (
        spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("nullValue", MISSING)
        .csv(path)
    )

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):
            return F.col(f"`{f.name}`")
        return F.nullif(F.trim(f"`{f.name}`"), F.lit("")).cast(f.dataType).alias(f.name)

    return read.select(*[column(f) for f in schema])


@dataclass(frozen=True)
class Staged:
    """A snapshot that was loaded, and the lines of its files that were no rows of it.

    ``rejected`` has ``file``, ``line`` and ``columns``: the columns whose value does not fit their type,
    or none if the line has too few or too many values.
    """

    rows: DataFrame
    rejected: DataFrame


def stage_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType, out: str, header: bool = True) -> Staged:
    """Read a comma-separated snapshot once, write its rows as parquet below ``out``, and quarantine bad lines beside them.

    Rows and values are those of :func:`load_snapshot_csv`, which fails at the first bad line instead. A
    line with a wrong number of values is kept as it stands; one with a value that does not fit its
    column is written again from its values. A run reads its snapshot several times, so the text is
    parsed once here.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in schema}
    corrupt = next(n for n in ("_corrupt", "_corrupt_line", "_corrupt_line_of_file") if n not in taken)
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(corrupt, T.StringType())])
    lines = (
        spark.read.schema(texts)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("nullValue", MISSING)
        .csv(path)
    )

    def value(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StringType):
            return F.col(f"`{f.name}`")
        return F.nullif(F.trim(f"`{f.name}`"), F.lit("")).try_cast(f.dataType)

    def bad(f: T.StructField) -> Column:
        given = F.nullif(F.trim(f"`{f.name}`"), F.lit("")).isNotNull()
        return F.when(given & value(f).isNull(), F.lit(f.name))

    misfits = [bad(f) for f in schema if not isinstance(f.dataType, T.StringType)]
    columns = F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")
    line = F.coalesce(F.col(corrupt), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema])))
    checked = lines.select(
        F.struct(*[value(f).alias(f.name) for f in schema]).alias("row"),
        F.when(F.col(corrupt).isNull(), columns).otherwise(F.array().cast("array<string>")).alias("columns"),
        F.col(corrupt).isNotNull().alias("is_corrupt"),
        F.struct(F.col("_metadata.file_path").alias("file"), line.alias("line")).alias("origin"),
    )
    is_bad = F.col("is_corrupt") | (F.size("columns") > 0)
    checked.select(
        is_bad.alias("is_rejected"),
        F.when(~is_bad, F.col("row")).alias("row"),
        F.when(is_bad, F.struct("origin.file", "origin.line", "columns")).alias("rejected"),
    ).write.partitionBy("is_rejected").parquet(out)
    row = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    rejected = T.StructType.fromDDL("file string, line string, columns array<string>")
    full = T.StructType([T.StructField("row", row), T.StructField("rejected", rejected), T.StructField("is_rejected", T.BooleanType())])
    staged = spark.read.schema(full).parquet(out)
    return Staged(staged.where("not is_rejected").select("row.*"), staged.where("is_rejected").select("rejected.*"))


def empty_table(spark: SparkSession, path: str) -> None:
    """Take all rows out of a parquet table; its columns stay."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def read_staging(spark: SparkSession, name: str) -> DataFrame:
    """The whole snapshot: a parquet path if the name has a slash, else a table of the catalog."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)
