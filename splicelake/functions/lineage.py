"""Cutting long lineages through the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder in local mode, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="splicelake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(path: str) -> None:
    """Remove a path in whatever store it is, as long as a session is there."""
    sc = SparkContext._active_spark_context
    if sc is not None and sc._jsc is not None:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def until_exit(path: str) -> str:
    """``path``, which goes when the session ends: results are read from it until then."""
    _WRITTEN.append(path)
    return path


@atexit.register
def _clean() -> None:
    for path in _WRITTEN:
        with contextlib.suppress(Exception):
            delete(path)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: a plan that is a scan, whose size Spark knows. Lost executors cost nothing of it."""
    spark = df.sparkSession
    at = until_exit(f"{shared_dir(spark)}/cut-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """The rows, written to the shared folder in buckets of a key and read as a table that knows them: joins by the key leave its rows where they are."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", until_exit(f"{shared_dir(spark)}/{name}")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern finds, in whatever store they are."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(x.getPath().toString() for x in found or ())
