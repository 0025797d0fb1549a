"""The training-data pipeline: STAGES in order, each written as parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm.pipeline import ORACLE_SQL, STAGES
from snapledger.session import new_dir

__all__ = ["ORACLE_SQL", "STAGES", "run"]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table; the result of the last one, as written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
