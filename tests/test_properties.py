"""Property tests (hypothesis) against plain-Python references: forward fill,
lenient numbers, name normalising, last-wins dedupe, upsert idempotency."""

import math
import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import scalars as X
from tidemark.operators.shape import norm_col
from tidemark.operators.windows import forward_fill, last_wins

SETTINGS = settings(max_examples=6, deadline=None)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=30),
       st.integers(1, 7))
def test_forward_fill_matches_pandas(spark, labels, chunk):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(labels)], "sheet STRING, row_idx INT, v STRING")
    got = [r.v for r in forward_fill(df, ["sheet"], "row_idx", ["v"], chunk_rows=chunk).orderBy("row_idx").collect()]
    want = pd.Series(labels, dtype="object").ffill().tolist()
    assert got == [None if (w is None or (isinstance(w, float) and math.isnan(w))) else w for w in want]


def _py_lenient(text):
    if text is None:
        return None
    try:
        v = float(text.strip())
    except ValueError:
        return None
    return None if (math.isnan(v) or math.isinf(v)) else v


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.from_regex(r"[ ]?-?[0-9]{1,4}(\.[0-9]{1,3})?[ ]?", fullmatch=True),
                          st.sampled_from(["n.p.", "-", "", "1,234", "$5", "nan", "inf", "12-13"])),
                min_size=1, max_size=20))
def test_lenient_double_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = [r.x for r in df.select("i", X.lenient_double("t").alias("x")).orderBy("i").collect()]
    assert got == [_py_lenient(t) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet="AbC xY_-()09 é", min_size=0, max_size=12), min_size=1, max_size=10))
def test_norm_name_expr_matches_norm_col(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i INT, n STRING")
    got = [r.x for r in df.select("i", X.norm_name_expr("n").alias("x")).orderBy("i").collect()]
    # the driver-side rule on the same names; Spark's lower() also folds non-ASCII, then drops it
    assert got == [re.sub(r"[^a-z0-9]+", "_", n.strip().lower()).strip("_") for n in names]
    assert [norm_col(n) for n in names] == got


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 100)), min_size=1, max_size=25))
def test_last_wins_matches_python(spark, rows):
    data = [(k, v, seq) for seq, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k STRING, v INT, seq INT")
    got = {r.k: r.v for r in last_wins(df, ["k"], "seq").collect()}
    want = {}
    for k, v, _ in data:
        want[k] = v
    assert got == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 9)), min_size=1, max_size=8,
                unique_by=lambda r: r[0]))
def test_upsert_is_idempotent(spark, rows):
    import tempfile

    from tidemark.sources import sinks

    root = tempfile.mkdtemp(prefix="tidemark-prop-")
    df = spark.createDataFrame(rows, "name STRING, value INT")
    sinks.upsert(spark, df, root, "t", ["name"])
    first = sorted(tuple(r) for r in sinks.read_table(spark, root, "t").collect())
    res = sinks.upsert(spark, df, root, "t", ["name"])
    second = sorted(tuple(r) for r in sinks.read_table(spark, root, "t").collect())
    assert first == second == sorted(rows)
    assert (res.inserted, res.updated, res.unchanged) == (0, 0, len(rows))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([2020, 2021]), st.integers(1, 12), st.sampled_from(["a", "b", "c"]),
                          st.integers(0, 9)), min_size=1, max_size=25))
def test_accumulate_ytd_matches_brute_force(spark, rows):
    from tidemark.operators.windows import accumulate_ytd

    flows = {}
    for y, m, k, v in rows:
        flows[(y, m, k)] = flows.get((y, m, k), 0) + v
    monthly = spark.createDataFrame([(y, m, k, v) for (y, m, k), v in flows.items()], "y INT, m INT, k STRING, v BIGINT")
    got = sorted(tuple(r) for r in accumulate_ytd(monthly, "y", "m", ["k"], ["v"]).collect())
    published = {(y, m) for (y, m, _k) in flows}
    want = []
    for (y, m) in sorted(published):
        for k in sorted({k for (yy, _mm, k) in flows if yy == y}):
            months = [mm for (yy, mm, kk) in flows if yy == y and kk == k]
            if min(months) <= m:
                want.append((y, m, k, sum(v for (yy, mm, kk), v in flows.items() if yy == y and kk == k and mm <= m)))
    assert got == sorted(want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.sampled_from(["Country", "Year", "total", "x", "Table of country"])),
                         min_size=0, max_size=4), min_size=1, max_size=12))
def test_header_rows_match_brute_force(spark, sheet_rows):
    from tidemark.operators.shape import header_rows

    rows = [("p", "s", i, cells) for i, cells in enumerate(sheet_rows)]
    grid = spark.createDataFrame(rows, "path STRING, sheet STRING, row_idx INT, cells ARRAY<STRING>")

    def first(pred):
        return next((i for i, cells in enumerate(sheet_rows) if i < 20 and pred(cells)), 0)

    def filled(cells):
        return sum(1 for c in cells if c is not None and c.strip() != "")

    def hint(cells):
        return any(c is not None and "country" in c.lower() for c in cells)

    got_hint = header_rows(grid, hint="country").first().header_row
    got_both = header_rows(grid, hint="country", min_nonnull=3).first().header_row
    got_plain = header_rows(grid).first().header_row
    assert got_hint == first(hint)
    assert got_both == first(lambda c: hint(c) and filled(c) >= 3)
    assert got_plain == first(lambda c: filled(c) > 2)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 50)), st.one_of(st.none(), st.integers(-20, 20)),
                          st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=10))
def test_opportunity_scores_match_formula(spark, rows):
    from tidemark.operators.scoring import WEIGHTS, opportunity_scores

    data = [(f"n{i}", v, None if g is None else float(g), None if s is None else float(s))
            for i, (v, g, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "nationality STRING, current_volume BIGINT, growth_pct DOUBLE, visa_volume DOUBLE")
    got = {r.nationality: (r.opportunity_score, r.data_confidence_pct) for r in opportunity_scores(df).collect()}
    pdf = pd.DataFrame(data, columns=["nationality", "current_volume", "growth_pct", "visa_volume"])
    ranks = {
        "growth": pdf["growth_pct"].astype("float64").rank(pct=True) * 100,
        "market_size": pdf["current_volume"].astype("float64").rank(pct=True) * 100,
        "visa_pathway": pdf["visa_volume"].astype("float64").rank(pct=True) * 100,
    }
    for i, name in enumerate(pdf["nationality"]):
        present = {k: ranks[k][i] for k in WEIGHTS if not math.isnan(ranks[k][i])}
        score, conf = got[name]
        assert abs(conf - round(len(present) / 3 * 100, 1)) < 1e-9
        if not present:
            assert score is None
        else:
            tw = sum(WEIGHTS[k] for k in present)
            want = sum(WEIGHTS[k] / tw * v for k, v in present.items())
            assert abs(score - want) <= 0.05 + 1e-9
