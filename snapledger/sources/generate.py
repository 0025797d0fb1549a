"""Synthetic employee snapshots of any size, generated on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sample names.
MANAGERS = ["Albert", "Bob", "Colin", "Diana", "Eva"]
DEPARTMENTS = ["Tester", "Management", "Engineering", "Schoonmaak", "Sales"]


def _draw(salt: str, seed: int, n: int) -> Column:
    """A number in [0, n) that depends on the row and the seed only, not on partitions: the first
    eight hexadecimal digits of the MD5 of ``id|salt|seed``."""
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"|{salt}|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def _pick(names: list[str], salt: str, seed: int) -> Column:
    values = F.array(*[F.lit(v) for v in names])
    return F.element_at(values, (_draw(salt, seed, len(names)) + 1).cast("int"))


def generate_employees(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``n`` employees with ids from R000001 and salaries in [2000, 10000)."""
    return employees_for(spark.range(1, n + 1), seed, max(6, len(str(n))))


def employees_for(ids: DataFrame, seed: int = 42, digits: int = 12) -> DataFrame:
    """One employee for each row of ``ids``, whose only column is ``id``, a whole number."""
    return ids.select(
        F.concat(F.lit("R"), F.lpad(F.col("id").cast("string"), digits, "0")).alias("employee_id"),
        (_draw("salary", seed, 8000) + 2000).cast("decimal(18,2)").alias("salary"),
        _pick(MANAGERS, "manager", seed).alias("manager"),
        _pick(DEPARTMENTS, "department", seed).alias("department"),
    )
