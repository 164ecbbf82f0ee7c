"""Tables that cut lineage, written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.lineage import delete, shared_dir, until_exit


class Scratch:
    """A fresh folder for one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = until_exit(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it again: its plan is a scan whose size Spark knows."""
        at = self.path(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self, name: str) -> None:
        """Remove a table that no later plan reads."""
        delete(self.path(name))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
