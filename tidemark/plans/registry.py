"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import checkpoint_dir
from tidemark.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        return fn

    return deco


def published_root(t: Tables) -> str:
    """A fresh folder for what a query lands or publishes, shared by all executors."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/published/{uuid.uuid4().hex}"
