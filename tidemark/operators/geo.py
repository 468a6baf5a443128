"""Country-name canonicalisation through the alias dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Alias column of the country dimension per source.
ALIAS_COLUMNS = {
    "education": "name_education",
    "home_affairs": "name_home_affairs",
    "abs": "name_abs",
    "skilled_mig": "name_skilled_mig",
}


def alias_long(alias: DataFrame) -> DataFrame:
    """The alias dimension as (source, alias, canonical_name)."""
    cols = list(ALIAS_COLUMNS.values())
    long = alias.select("canonical_name", *cols).unpivot(["canonical_name"], cols, "alias_column", "alias")
    inverse = {v: k for k, v in ALIAS_COLUMNS.items()}
    src = F.create_map(*[F.lit(x) for kv in inverse.items() for x in kv])
    return long.where(F.col("alias").isNotNull()).select(
        F.element_at(src, F.col("alias_column")).alias("source"), "alias", "canonical_name"
    ).distinct()


def canonicalise(df: DataFrame, name_col: str, aliases: DataFrame, source: str) -> DataFrame:
    """Left join source names to canonical names (unmapped stays NULL)."""
    a = aliases.where(F.col("source") == F.lit(source)).select(
        F.col("alias").alias("__alias"), "canonical_name"
    )
    return df.join(a, F.col(name_col) == F.col("__alias"), "left").drop("__alias")


def unmapped_names(frames: Mapping[str, DataFrame], aliases: DataFrame) -> DataFrame:
    """Distinct (source, name) over several sources that no alias maps."""
    parts = [f.select(F.lit(s).alias("source"), F.col(f.columns[0]).alias("name")) for s, f in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.where(F.col("name").isNotNull()).distinct()
    keys = aliases.select("source", F.col("alias").alias("name"))
    return u.join(keys, ["source", "name"], "left_anti")
