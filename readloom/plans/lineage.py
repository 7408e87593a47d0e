"""Tables written on the way, in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a file of a table takes whose size the caller knows.
ROWS_A_FILE = 500_000
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Where it is unset, a temporary folder of our own, in local mode only: executors elsewhere would not see it."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _OWN:
        _OWN["dir"] = "file://" + tempfile.mkdtemp(prefix="readloom-")
    return _OWN["dir"]


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's tables. It goes when the driver's JVM ends, or with `release`."""
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        path = f"{shared_dir(spark)}/readloom/{app}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _OWN[app] = path
    return _OWN[app]


def share(spark: SparkSession, local: str, name: str) -> str:
    """A copy of a file of the driver's in the shared folder, for executors to read."""
    path = f"{run_dir(spark)}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = spark._jvm.org.apache.hadoop.fs.Path("file://" + os.path.abspath(local))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(source, target)
    return path


def release(spark: SparkSession) -> None:
    """Deletes the tables written so far. Results that are still to be read need them."""
    if path := _OWN.pop(spark.sparkContext.applicationId, None):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(df: DataFrame) -> None:
    """Deletes a table that `cut` has written and nothing will read again."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def forget(spark: SparkSession) -> None:
    """Lets the files of shuffles go that no plan needs any more: those behind a table that `cut` has written.

    Spark deletes them once the driver's JVM has collected what refers to them, which by itself it may do much later.
    """
    spark._jvm.System.gc()


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and a lost executor costs no recomputation.

    This runs a job. rows: about how many rows there are at most, if the caller knows; then there are no more files than so
    many rows, and a few tasks for each core, call for. The number of files follows the table, whatever the cluster.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE)))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
