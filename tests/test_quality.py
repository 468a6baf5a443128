"""Each check with a passing and a failing input."""

from tidemark.operators import quality as qa


def _passed(df):
    return df.first().passed


def test_checks_pass_and_fail(spark):
    ok = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "k INT, period STRING")
    bad = spark.createDataFrame([(1, "2024-1"), (1, None), (None, "x")], "k INT, period STRING")
    empty = ok.limit(0)
    assert _passed(qa.non_empty(ok, "t")) and not _passed(qa.non_empty(empty, "t"))
    assert _passed(qa.null_keys(ok, "t", ["k"])) and not _passed(qa.null_keys(bad, "t", ["k"]))
    assert _passed(qa.duplicate_keys(ok, "t", ["k"])) and not _passed(qa.duplicate_keys(bad, "t", ["k"]))
    assert _passed(qa.format_violations(ok, "t", "period", r"^\d{4}-\d{2}$"))
    assert not _passed(qa.format_violations(bad, "t", "period", r"^\d{4}-\d{2}$"))
    assert _passed(qa.distinct_count_equals(ok, "t", "k", 2)) and not _passed(qa.distinct_count_equals(bad, "t", "k", 2))
    assert _passed(qa.at_least(ok, "t", 2)) and not _passed(qa.at_least(ok, "t", 9))
    assert _passed(qa.in_range(ok, "t", "k", 0, 5)) and not _passed(qa.in_range(ok, "t", "k", 0, 1))
    parent = spark.createDataFrame([(1,), (2,)], "k INT")
    assert _passed(qa.orphans_count(ok, parent, "t", "k", "k"))
    assert not _passed(qa.orphans_count(bad, parent.where("k = 2"), "t", "k", "k"))


def test_grain_guard_and_redundancy(spark):
    rows = [(2024, 12, "Chile", "ELICOS", 8, 8), (2024, 12, "Chile", "Science", 5, 5), (2024, 12, "Vietnam", "IT", 12, 12)]
    df = spark.createDataFrame(rows, "y INT, m INT, nat STRING, field STRING, ytd BIGINT, total BIGINT")
    g = qa.grain_guard(df, ["y", "m", "nat"], ["y", "m", "nat", "field"]).first()
    assert g.colliding_rows == 2 and g.wide_key_unique and abs(g.colliding_pct - 66.666667) < 1e-6
    r = qa.redundant_share(df, "ytd", "total").first()
    assert r.same_pct == 100.0
    mask = qa.duplicate_rows_mask(df, ["y", "m", "nat"])
    assert mask.count() == 2


def test_delta_and_known_empty(spark):
    before = spark.createDataFrame([("a", 10), ("b", 5)], "table_name STRING, rows BIGINT")
    after = spark.createDataFrame([("a", 10), ("b", 6)], "table_name STRING, rows BIGINT")
    d = {r.table_name: r.passed for r in qa.count_delta(before, after).collect()}
    assert d == {"a": True, "b": False}
    d5 = {r.table_name: r.passed for r in qa.count_delta(before, after, tolerance_pct=25).collect()}
    assert d5 == {"a": True, "b": True}
    empty = spark.createDataFrame([], "x INT")
    assert qa.known_empty(empty, "dim_occupation", {"dim_occupation": "no source"}).first().passed
    assert not qa.known_empty(empty, "other", {"dim_occupation": "no source"}).first().passed
    nulls = {r.column_name: r.nulls for r in qa.nulls_per_column(
        spark.createDataFrame([(1, None), (None, None)], "a INT, b STRING")).collect()}
    assert nulls == {"a": 1, "b": 2}


def test_keyed_table_checks_one_pass(spark):
    ok = spark.createDataFrame([("2024-01", "a"), ("2024-02", "b")], "p STRING, k STRING")
    bad = spark.createDataFrame([("2024-1", "a"), ("2024-1", "a"), (None, "b")], "p STRING, k STRING")
    res_ok = {r.check: (r.observed, r.passed) for r in qa.keyed_table_checks(
        ok, "t", ["p", "k"], distinct=("k", 2), formats={"p": r"^\d{4}-\d{2}$"}).collect()}
    assert all(p for _, p in res_ok.values()) and res_ok["non_empty"] == (2, True)
    res_bad = {r.check: (r.observed, r.passed) for r in qa.keyed_table_checks(
        bad, "t", ["p", "k"], distinct=("k", 2), formats={"p": r"^\d{4}-\d{2}$"}).collect()}
    assert res_bad["null_keys"] == (1, False) and res_bad["duplicate_keys"] == (1, False)
    assert res_bad["format_p"] == (3, False) and res_bad["distinct_k"] == (2, True)


def test_grain_guard_non_nested_keys(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "a", "y")], "k INT, f STRING, g STRING")
    g = qa.grain_guard(df, ["k"], ["f", "g"]).first()  # narrow key not inside the wide key: two passes
    assert (g.rows, g.colliding_rows, g.wide_key_unique) == (3, 2, True)
