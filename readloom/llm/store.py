"""Tables of a run: the given ones, and those written on the way in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans import lineage

#: Bytes of an Arrow batch between the JVM and Python: a few long texts, or some thousand usual ones.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Batches small enough that an executor with little memory holds some of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    small_batches(df.sparkSession)
    return lineage.cut(df, name, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
