"""Publishing: atomic replace, upsert modes and counts, appends, multi-table release."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.sources import sinks

ENROL = "enrol_year INT, enrol_month INT, nationality STRING, state_code STRING, ytd_enrolments BIGINT"
KEY = ["enrol_year", "enrol_month", "nationality", "state_code"]


def _rows(n):
    return [(2020 + i // 12, 1 + i % 12, "India", "NSW", 100) for i in range(n)]


def test_replace_rejects_duplicates_before_writing(spark, tmp_root):
    df = spark.createDataFrame(_rows(3) + _rows(1), ENROL)
    with pytest.raises(sinks.LoadError):
        sinks.replace_table(spark, df, tmp_root, "enrol", KEY)
    assert sinks.current_version(spark, tmp_root, "enrol") is None


def test_replace_twice_is_idempotent_and_keeps_old_on_failure(spark, tmp_root):
    df = spark.createDataFrame(_rows(250), ENROL)
    r1 = sinks.replace_table(spark, df, tmp_root, "enrol", KEY)
    r2 = sinks.replace_table(spark, df, tmp_root, "enrol", KEY)
    assert r1.rows_written == r2.rows_written == 250
    assert sinks.read_table(spark, tmp_root, "enrol").count() == 250
    with pytest.raises(sinks.LoadError):  # short count is fatal
        sinks.replace_table(spark, df, tmp_root, "enrol", KEY, expected_rows=251)
    assert sinks.current_version(spark, tmp_root, "enrol") == r2.version
    assert sinks.read_table(spark, tmp_root, "enrol").count() == 250


def test_wider_key_accepts(spark, tmp_root):
    rows = [(2024, 6, "China", "NSW", 60), (2024, 6, "China", "NSW", 40)]
    df = spark.createDataFrame(rows, ENROL).withColumn("field", F.when(F.col("ytd_enrolments") > 50, "IT").otherwise("Law"))
    with pytest.raises(sinks.LoadError):
        sinks.replace_table(spark, df, tmp_root, "basic", KEY)
    assert sinks.replace_table(spark, df, tmp_root, "detailed", KEY + ["field"]).rows_written == 2


def test_dry_run_writes_nothing(spark, tmp_root):
    df = spark.createDataFrame(_rows(5), ENROL)
    res = sinks.replace_table(spark, df, tmp_root, "enrol", KEY, dry_run=True)
    assert res.dry_run and res.rows_written == 5
    assert sinks.current_version(spark, tmp_root, "enrol") is None


def test_upsert_update_and_replace_row(spark, tmp_root):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "name STRING, value INT, note STRING")
    sinks.replace_table(spark, base, tmp_root, "t", ["name"])
    new = spark.createDataFrame([("a", 10), ("c", 3), ("b", 2)], "name STRING, value INT")
    res = sinks.upsert(spark, new, tmp_root, "t", ["name"], mode="update")
    assert (res.inserted, res.updated, res.unchanged) == (1, 1, 1)
    got = {r.name: (r.value, r.note) for r in sinks.read_table(spark, tmp_root, "t").collect()}
    assert got == {"a": (10, "x"), "b": (2, "y"), "c": (3, None)}  # note kept on update
    res2 = sinks.upsert(spark, new.where("name = 'a'"), tmp_root, "t", ["name"], mode="replace_row")
    got2 = {r.name: (r.value, r.note) for r in sinks.read_table(spark, tmp_root, "t").collect()}
    assert got2["a"] == (10, None)  # whole row replaced, missing column NULL
    assert res2.unchanged == 0 and res2.updated == 1


def test_upsert_last_wins_and_nan_to_null(spark, tmp_root):
    batch = spark.createDataFrame(
        [("2020-01-02", "FX", 1.0, 1), ("2020-01-02", "FX", float("nan"), 2), ("2020-01-03", "FX", 2.0, 1)],
        "d STRING, s STRING, v DOUBLE, seq INT",
    )
    sinks.upsert(spark, batch, tmp_root, "fx", ["d", "s"], order_col="seq")
    got = {r.d: r.v for r in sinks.read_table(spark, tmp_root, "fx").collect()}
    assert got["2020-01-02"] is None and got["2020-01-03"] == 2.0
    with pytest.raises(sinks.LoadError):
        sinks.upsert(spark, batch.drop("seq"), tmp_root, "fx", ["d", "s"])


def test_null_key_is_a_value_and_text_none_stays_text(spark, tmp_root):
    df = spark.createDataFrame([("Alice", 1), ("Bob", 2), (None, 3), ("None", 4)], "name STRING, value INT")
    sinks.replace_table(spark, df, tmp_root, "names", ["name"])
    out = sinks.read_table(spark, tmp_root, "names")
    assert out.where(F.col("name").isNull()).count() == 1 and out.where(F.col("name") == "None").count() == 1
    dup = spark.createDataFrame([(None, 1), (None, 2)], "name STRING, value INT")
    with pytest.raises(sinks.LoadError):
        sinks.replace_table(spark, dup, tmp_root, "names2", ["name"], blanks={"name": ""})


def test_append_counts_and_empty(spark, tmp_root):
    a = spark.createDataFrame([(i,) for i in range(25)], "a INT")
    assert sinks.append_rows(spark, a, tmp_root, "app").rows_written == 25
    assert sinks.append_rows(spark, a.limit(0), tmp_root, "app").rows_written == 0
    assert sinks.append_rows(spark, a, tmp_root, "app").rows_written == 25
    assert sinks.read_table(spark, tmp_root, "app").count() == 50


def test_release_all_or_nothing(spark, tmp_root):
    good = spark.createDataFrame([(1,), (2,)], "k INT")
    sinks.publish_release(spark, tmp_root, {"basic": good, "detailed": good}, {"basic": ["k"], "detailed": ["k"]})
    v_basic = sinks.current_version(spark, tmp_root, "basic")
    bad = spark.createDataFrame([(1,), (1,)], "k INT")
    with pytest.raises(sinks.LoadError):
        sinks.publish_release(spark, tmp_root, {"basic": good.union(good.select((F.col("k") + 10).alias("k"))),
                                                "detailed": bad}, {"detailed": ["k"]})
    assert sinks.current_version(spark, tmp_root, "basic") == v_basic
    assert sinks.read_table(spark, tmp_root, "basic").count() == 2


def test_csv_export_row_cap(spark, tmp_root):
    import glob

    df = spark.range(10).repartition(1)
    sinks.export_csv(df, f"{tmp_root}/out", null_value="\\N", max_records=4)
    files = glob.glob(f"{tmp_root}/out/*.csv")
    assert len(files) == 3


def test_partitioned_version_prunes(spark, tmp_root):
    df = spark.createDataFrame(_rows(30), ENROL)
    sinks.replace_table(spark, df, tmp_root, "enrol_p", KEY, partition_by=["enrol_year"])
    t = sinks.read_table(spark, tmp_root, "enrol_p")
    assert t.count() == 30
    q = t.where(F.col("enrol_year") == 2021)
    assert q.count() == 12
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(enrol_year" in plan


def test_upsert_null_key_rerun_changes_nothing(spark, tmp_root):
    batch = spark.createDataFrame([(None, "NSW", 1), ("India", None, 2)], "name STRING, state STRING, value INT")
    batch = batch.withColumn("_etl_loaded_at", F.current_timestamp())
    for expected in ((2, 0, 0), (0, 0, 2)):
        res = sinks.upsert(spark, batch, tmp_root, "n", ["name", "state"])
        assert (res.inserted, res.updated, res.unchanged) == expected
    res = sinks.upsert(spark, batch.withColumn("value", F.col("value") + 1), tmp_root, "n", ["name", "state"])
    assert (res.inserted, res.updated, res.unchanged) == (0, 2, 0)
    assert sinks.read_table(spark, tmp_root, "n").count() == 2


def test_upsert_blank_equals_null(spark, tmp_root):
    sinks.upsert(spark, spark.createDataFrame([(None, 1)], "name STRING, value INT"), tmp_root, "b", ["name"], blanks={"name": ""})
    res = sinks.upsert(spark, spark.createDataFrame([("", 5)], "name STRING, value INT"), tmp_root, "b", ["name"], blanks={"name": ""})
    assert (res.inserted, res.updated) == (0, 1)
    assert [tuple(r) for r in sinks.read_table(spark, tmp_root, "b").collect()] == [(None, 5)]


def test_release_switches_with_one_commit(spark, tmp_root, monkeypatch):
    one = spark.createDataFrame([(1,)], "k INT")
    sinks.publish_release(spark, tmp_root, {"a": one, "b": one})
    before = sinks.live_tables(spark, tmp_root)

    def broken(*_):
        raise OSError("the store went away")

    monkeypatch.setattr(sinks, "_write_new", broken)
    with pytest.raises(OSError):
        sinks.publish_release(spark, tmp_root, {"a": one.union(one), "b": one.union(one)})
    monkeypatch.undo()
    assert sinks.live_tables(spark, tmp_root) == before
    assert sinks.read_table(spark, tmp_root, "a").count() == sinks.read_table(spark, tmp_root, "b").count() == 1


def test_append_leaves_open_readers_alone(spark, tmp_root):
    a = spark.range(5)
    sinks.append_rows(spark, a, tmp_root, "app")
    reader = sinks.read_table(spark, tmp_root, "app")
    sinks.append_rows(spark, a, tmp_root, "app")
    assert reader.count() == 5 and sinks.read_table(spark, tmp_root, "app").count() == 10


def _files(root, table):
    import os

    out = {}
    for folder, _, names in os.walk(os.path.join(root, table)):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(folder, n)
                out[path] = (os.path.getmtime(path), os.path.getsize(path))
    return out


def test_upsert_by_period_leaves_other_periods_alone(spark, tmp_root):
    first = spark.createDataFrame([*_rows(48), (None, 1, "India", "NSW", 7)], ENROL)
    res = sinks.upsert(spark, first, tmp_root, "enrol", KEY, by="enrol_year")
    assert res.rows_written == 49
    live, files = sinks.live_tables(spark, tmp_root)["enrol"], _files(tmp_root, "enrol")
    assert [f.rsplit("=", 1)[1] for f in live] == ["k2020", "k2021", "k2022", "k2023", "null"]
    batch = spark.createDataFrame([(2021, 1, "India", "NSW", 200), (2021, 13, "India", "NSW", 1), (2024, 1, "India", "NSW", 5), (None, 1, "India", "NSW", 7)], ENROL)
    res = sinks.upsert(spark, batch.withColumn("note", F.lit("n")).where("enrol_year IS NOT NULL"), tmp_root, "enrol", KEY, by="enrol_year")
    assert (res.inserted, res.updated, res.unchanged) == (2, 1, 0) and res.rows_written == 14  # of 50 rows, those of 2021 and 2024
    now = sinks.live_tables(spark, tmp_root)["enrol"]
    assert {f for f in now if f in live} == {f for f in live if not f.endswith("2021")} and len(now) == 6
    assert {k: v for k, v in _files(tmp_root, "enrol").items() if k in files} == files
    rows = {(r.enrol_year, r.enrol_month): (r.ytd_enrolments, r.note) for r in sinks.read_table(spark, tmp_root, "enrol").collect()}
    assert len(rows) == 51 and rows[2021, 1] == (200, "n") and rows[2021, 2] == (100, None) and rows[2024, 1] == (5, "n") and rows[None, 1] == (7, None)
    again = sinks.upsert(spark, batch.where("enrol_year IS NULL"), tmp_root, "enrol", KEY, by="enrol_year")
    assert (again.inserted, again.updated, again.unchanged) == (0, 0, 1)
    assert sinks.read_table(spark, tmp_root, "enrol").count() == 51
    # an older commit still reads the older folders
    assert sinks.read_table(spark, tmp_root, "enrol", commit_number=1).count() == 49 and sinks.last_commit(spark, tmp_root) == 3


def test_upsert_by_refuses_what_could_move_rows(spark, tmp_root):
    df = spark.createDataFrame(_rows(3), ENROL)
    with pytest.raises(ValueError, match="key column"):
        sinks.upsert(spark, df, tmp_root, "t", KEY, by="ytd_enrolments")
    sinks.upsert(spark, df, tmp_root, "t", KEY, by="enrol_year")
    with pytest.raises(sinks.LoadError, match="'by'"):
        sinks.upsert(spark, df, tmp_root, "t", KEY)
    with pytest.raises(sinks.LoadError):
        sinks.append_rows(spark, df, tmp_root, "t")
    assert sinks.upsert(spark, df.limit(0), tmp_root, "t", KEY, by="enrol_year").rows_written == 0


def test_folders_of_odd_values(spark, tmp_root):
    names = ["a/b", "k1", "1", "null", None, "", "é=%", "x" * 300]
    df = spark.createDataFrame([(n, 1) for n in names], "name STRING, v INT")
    sinks.upsert(spark, df, tmp_root, "t", ["name"], by="name")
    res = sinks.upsert(spark, df.withColumn("v", F.lit(2)).where("name IS NULL OR name IN ('null', 'a/b')"), tmp_root, "t", ["name"], by="name")
    assert (res.inserted, res.updated) == (0, 3)
    got = {r.name: r.v for r in sinks.read_table(spark, tmp_root, "t").collect()}
    assert got == {n: 2 if n in (None, "null", "a/b") else 1 for n in names}
