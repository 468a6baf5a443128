"""Intermediate tables in the cluster's shared folder.

A plan that reads one result several times, or that must not be derived again after an executor is lost,
is written here and read back: lineage ends at the files.  A :class:`Scratch` removes its folders
when its work is done, so that nothing is left behind but what was published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import checkpoint_dir


class Scratch:
    """A folder of intermediate tables; ``with Scratch(spark) as s: s.cut(df)``."""

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.tables = 0

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.tables:04d}"
        self.tables += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        from tidemark.sources.sinks import _delete

        _delete(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        self.remove()
