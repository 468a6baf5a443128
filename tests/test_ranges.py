"""Ranks within groups and exact quantiles against pandas, with hot groups, ties, NULLs and brackets that miss."""

import math
import random
import re

import pandas as pd
import pytest

from tidemark.operators import ranges
from tidemark.sources.scratch import Scratch


def _rows(seed=3, n=3000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "one"] if i < 2990 else ["tail"])
        value = rng.choice([None, float("nan"), 7.0]) if i % 11 == 0 else round(rng.lognormvariate(0, 8), 3)
        out.append((group, 1.5 if group == "one" else value))
    return out + [("null only", None)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


def _frame(rows):
    return pd.DataFrame([(g if g is not None else "<none>", math.nan if v is None else v) for g, v in rows], columns=["g", "v"])


def test_percentile_rank_in_groups(spark, rows):
    want = _frame(rows)
    want["p"] = want.groupby("g")["v"].rank(pct=True) * 100
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    with Scratch(spark) as scratch:
        out = ranges.percentile_rank_in_groups(df, "v", "p", ["g"], scratch, ranges=7)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.g or "<none>", repr(r.v) if r.v is not None else "nan", -1.0 if r.p is None else round(r.p, 9)) for r in out.collect())
    assert got == sorted((g, repr(v) if not math.isnan(v) else "nan", -1.0 if math.isnan(p) else round(p, 9)) for g, v, p in want.itertuples(index=False))
    # every window that orders values has its range in the key
    windows = re.findall(r"windowspecdefinition\(([^)]*)\)", plan)
    assert windows and all("__range" in w for w in windows if "v#" in w)


@pytest.mark.parametrize("share", [0.5, 0.0, 1.0, 0.9])
def test_exact_quantiles(spark, rows, share):
    want = _frame(rows).dropna().groupby("g")["v"].quantile(share)
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    with Scratch(spark) as scratch:
        got = {(r.g or "<none>"): (r.n, r.quantile) for r in ranges.exact_quantiles(df, "v", ["g"], scratch, share, ranges=5).collect()}
    assert set(got) == set(want.index)
    for g, v in want.items():
        assert math.isclose(got[g][1], v, rel_tol=1e-12), g


def test_quantile_of_everything_and_of_nothing(spark, rows):
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    with Scratch(spark) as scratch:
        r = ranges.exact_quantiles(df, "v", [], scratch).collect()
        assert len(r) == 1 and math.isclose(r[0].quantile, _frame(rows)["v"].median(), rel_tol=1e-12)
        assert ranges.exact_quantiles(df.limit(0), "v", ["g"], scratch).collect() == []


def test_brackets_that_miss_are_widened(spark, rows, monkeypatch):
    from pyspark.sql import functions as F

    # a sketch that is off: both ends above every value but the largest
    monkeypatch.setattr(ranges.F, "percentile_approx", lambda v, *a: F.array(F.max(v), F.max(v)))
    want = _frame(rows).dropna().groupby("g")["v"].median()
    with Scratch(spark) as scratch:
        got = {(r.g or "<none>"): r.quantile for r in ranges.exact_quantiles(spark.createDataFrame(rows, "g STRING, v DOUBLE"), "v", ["g"], scratch).collect()}
    assert {g: round(v, 9) for g, v in got.items()} == {g: round(v, 9) for g, v in want.items()}
