"""Join helpers: lookups, anti/semi flags.

No side is hinted for broadcast: the planner takes it from file sizes and AQE from
measured shuffle sizes, each time a query runs, and a side that has grown is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def map_lookup(c: Column | str, mapping: Mapping[str, str], keep_unmapped: bool = False) -> Column:
    """Value map as a literal map (unmapped is NULL, or kept with ``keep_unmapped``)."""
    col = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return col if keep_unmapped else F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, col)
    return F.coalesce(looked, col) if keep_unmapped else looked


def membership_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """1 when the row's key exists in ``keys``, else 0 (a semi join kept as a column)."""
    marks = keys.select(*on).dropDuplicates().withColumn(flag, F.lit(1))
    return df.join(marks, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (NULL keys are orphans too)."""
    p = parent.select(F.col(parent_key).alias("__pk")).dropDuplicates()
    return child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def not_in_anti(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """SQL ``NOT IN`` semantics: a NULL in the parent list empties the result,
    a NULL child key is never returned (unless the parent list is empty: then every
    row is).

    A null-aware anti join would broadcast the whole parent whatever its size.  Here
    the keys meet in an ordinary anti join, and whether the parent is empty or holds a
    NULL are scalar subqueries.
    """
    keys = parent.select(F.col(parent_key).alias("__pk"))
    rows = keys.agg(F.count(F.lit(1))).scalar()
    nulls = keys.agg(F.count_if(F.col("__pk").isNull())).scalar()
    left = child.join(keys.where(F.col("__pk").isNotNull()).dropDuplicates(), F.col(child_key) == F.col("__pk"), "left_anti")
    return left.where((rows == 0) | ((nulls == 0) & F.col(child_key).isNotNull()))
