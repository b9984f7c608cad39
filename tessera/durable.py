"""Tables in the folder that all executors share: a lost executor costs no rerun, and a run that is started again finds what is done."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Without one a cluster raises; a single machine gets one, as in tests."""
    key = "spark.checkpoint.dir"
    path = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if path:
        return path
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {key} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end there."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def table_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` as the table at ``path``. A table that is there whole is read instead, and nothing of ``df`` runs."""
    spark, schema = df.sparkSession, df.schema
    if not complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._written_at = path
    return out


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """``df`` as a new table of the shared folder, read again: the plan above it is cut."""
    return table_at(df, new_folder(df.sparkSession, label))


def discard(*frames: DataFrame) -> None:
    """Delete tables that no plan needs any more."""
    for df in frames:
        discard_at(df.sparkSession, df._written_at)


def discard_at(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
