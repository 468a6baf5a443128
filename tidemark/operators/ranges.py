"""Ranks and exact quantiles of large facts within groups, by ranges of values.

Nothing here sorts or counts a group in one task.  Values are counted first (map-side, so a
value that a third of the rows hold is one row a task), the counts are dealt by range of (group,
value), and a range's rows before it follow from the totals of the ranges below: one
row a range and group.  A group with a third of all rows is many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import Scratch


def _same(left: str, right: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def counts_before(counts: DataFrame, parts: Sequence[str], value: str, n: str, scratch: Scratch, ranges: int | None = None) -> DataFrame:
    """``counts`` (a row for each group and value, ``n`` rows each) with ``before``, the rows of
    its group below the value, and ``total``, the rows of the group.

    Spark deals the rows by range of (group, value) and they are written with their range, so the
    ranges stay the same whoever reads them.  Running sums are windows within one range; the
    window over ranges has one row for each range of a group.
    """
    parts = list(parts)
    by = [*parts, value]
    dealt = counts.repartitionByRange(ranges, *by) if ranges else counts.repartitionByRange(*by)
    placed = scratch.cut(dealt.withColumn("__range", F.spark_partition_id()))
    sums = placed.groupBy(*parts, "__range").agg(F.sum(n).alias("__n"))
    # a group's ranges follow each other by number
    over = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    lower = over.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*parts, "__range", F.coalesce(F.sum("__n").over(lower), F.lit(0)).alias("__lower"), F.sum("__n").over(over).alias("total"))
    within = Window.partitionBy(*parts, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn("__run", F.sum(n).over(within) - F.col(n))
    joined = running.alias("c").join(offsets.alias("o"), [F.col("c.__range") == F.col("o.__range"), *_same("c", "o", parts)])
    return joined.select(*[F.col(f"c.{c}") for c in counts.columns], (F.col("__lower") + F.col("__run")).alias("before"), "total")


def percentile_rank_in_groups(df: DataFrame, value: str, out: str, parts: Sequence[str], scratch: Scratch, ranges: int | None = None) -> DataFrame:
    """W01 of a large fact within groups: pandas ``rank(pct=True) * 100`` with average ties; NULL and
    NaN have no rank.  NULL group keys are one group.

    The ranks of a group's distinct values come from :func:`counts_before` and are joined back on
    (group, value); a value that many rows hold meets them by a join that adaptive
    execution splits.
    """
    parts = list(parts)
    real = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    counts = df.where(real).groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = counts_before(counts, parts, value, "__n", scratch, ranges)
    rank = (F.col("before") + (F.col("__n") + F.lit(1)) / F.lit(2.0)) / F.col("total") * F.lit(100.0)
    ranked = placed.select(*parts, value, rank.alias(out))
    met = df.alias("d").join(ranked.alias("r"), _same("d", "r", [*parts, value]), "left")
    return met.select("d.*", F.col(f"r.{out}"))


#: Ranks of the approximate bracket around a wanted one, as a share of a group's rows; the sketch's accuracy is five times finer.
BRACKET = 1e-3


def exact_quantiles(df: DataFrame, value: str, parts: Sequence[str], scratch: Scratch, share: float = 0.5,
                    bracket: float = BRACKET, ranges: int | None = None) -> DataFrame:
    """A22 of a fact: the exact quantile of each group, between two values as pandas and SQL do
    (linear), as (parts, n, quantile).  NULL and NaN are left out; a group without values is not in the result.

    1. A sketch of each group, merged map-side, gives two values around the wanted rank.
    2. One pass counts the rows below the lower one and, value by value, those between: a
       thousandth or so of the distinct values.
    3. :func:`counts_before` over these finds the rows at the wanted ranks.
    4. A group whose bracket proves not to hold its ranks is bracketed by its extremes and goes through 2 and 3 again.
    """
    parts = list(parts)
    real = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*parts, F.col(value).cast("double").alias("__v"))
    ends = [max(0.0, share - bracket), min(1.0, share + bracket)]
    told = real.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"),
                                    F.percentile_approx("__v", ends, int(5 / bracket)).alias("__near"))
    at = F.lit(share) * (F.col("n") - 1)
    asked = scratch.cut(told.withColumns({"__first": F.floor(at), "__last": F.ceil(at), "__part": at - F.floor(at)}))
    narrow = asked.withColumns({"lo": F.col("__near")[0] if ends[0] > 0 else F.col("lo"), "hi": F.col("__near")[1] if ends[1] < 1 else F.col("hi")})
    found = scratch.cut(_at_ranks(real, narrow, parts, scratch, ranges))
    left = asked.alias("a").join(found.where("__low IS NOT NULL AND __high IS NOT NULL").alias("f"), _same("a", "f", parts), "left_anti") if parts \
        else asked.join(found.where("__low IS NOT NULL AND __high IS NOT NULL"), F.lit(True), "left_anti")
    missed = scratch.cut(left)
    done = found.where("__low IS NOT NULL AND __high IS NOT NULL")
    if not missed.isEmpty():
        done = done.unionByName(_at_ranks(real, missed, parts, scratch, ranges))
    return done.select(*parts, "n", (F.col("__low") + F.col("__part") * (F.col("__high") - F.col("__low"))).alias("quantile"))


def _at_ranks(real: DataFrame, asked: DataFrame, parts: list[str], scratch: Scratch, ranges: int | None) -> DataFrame:
    """The values at the ranks __first and __last of each group of ``asked``, NULL if outside lo to hi."""
    met = real.alias("d").join(asked.select(*parts, "lo", "hi").alias("a"), _same("d", "a", parts) if parts else F.lit(True)).where("__v <= hi")
    counts = scratch.cut(met.groupBy(*[F.col(f"d.{c}").alias(c) for c in parts], F.when(F.col("__v") >= F.col("lo"), F.col("__v")).alias("__v"))
                         .agg(F.count(F.lit(1)).alias("__n")))
    below = counts.where("__v IS NULL").select(*parts, F.col("__n").alias("__below"))
    placed = counts_before(counts.where("__v IS NOT NULL"), parts, "__v", "__n", scratch, ranges)
    known = asked.alias("a").join(below.alias("b"), _same("a", "b", parts) if parts else F.lit(True), "left") \
        .select("a.*", F.coalesce("__below", F.lit(0)).alias("__below"))
    rows = known.alias("k").join(placed.alias("p"), _same("k", "p", parts) if parts else F.lit(True), "left")
    first = F.col("__below") + F.col("before")

    def holds(rank: str) -> Column:
        return F.max(F.when((first <= F.col(rank)) & (F.col(rank) < first + F.col("__n")), F.col("__v")))

    return rows.groupBy(*[F.col(f"k.{c}").alias(c) for c in parts], "n", "__part").agg(holds("__first").alias("__low"), holds("__last").alias("__high"))
