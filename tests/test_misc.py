"""Smaller public helpers: SDMX and landed-file readers, filters, seeds, audit
statuses, scalar helpers, workbook loader."""

import os

from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import scalars as X
from tidemark.operators import filters as flt
from tidemark.operators.audit import invalid_statuses
from tidemark.operators.joins import map_lookup, membership_flag
from tidemark.plans import loaders
from tidemark.sources import readers, sinks


def test_sdmx_and_landed_files(spark, tmp_root):
    d = os.path.join(tmp_root, "sdmx")
    os.makedirs(d)
    with open(os.path.join(d, "03_2025_189_SUBMITTED_occupation_by_state.csv"), "w") as fh:
        fh.write("TIME_PERIOD,MEASURE,REGION,OBS_VALUE\n2023-Q4,M1,AUS,1.5\n2024-Q1,M1,AUS,2.5\n2024-Q2,M1,AUS,n.a.\n")
    df = readers.read_sdmx_csv(spark, d, start_period="2024-Q1")
    assert [(r.period, r.value) for r in df.collect()] == [("2024-Q1", 2.5)]
    ctx = readers.file_context(spark.read.option("header", True).csv(d)).first()
    assert (ctx.as_at_month, ctx.visa_type, ctx.source_view) == ("03/2025", "189", "occupation_by_state")
    assert readers.newest_file(spark, d, "*.csv").endswith("occupation_by_state.csv")
    assert readers.first_available(spark, [(os.path.join(tmp_root, "missing"), "*.csv"), (d, "*.xlsx"),
                                          (d, "*.csv")]) == (d, "*.csv")


def test_filters_and_lookups(spark):
    df = spark.createDataFrame([("Employed total ; Persons", "Data1", 120), ("Hours", "Notes", 50)],
                               "measure STRING, sheet STRING, prev INT")
    assert df.where(flt.like_any("measure", ["employed%"], case_insensitive=True)).count() == 1
    assert df.where(flt.like_any("measure", ["employed%"])).count() == 0
    assert flt.sheets_matching(df, ["data"]).count() == 1 and flt.sheets_excluding(df, ["note"]).count() == 1
    assert flt.minimum_base(df, "prev", 100).count() == 1
    keys = spark.createDataFrame([("Hours",)], "measure STRING")
    flags = {r.measure: r.hit for r in membership_flag(df, keys, ["measure"], "hit").collect()}
    assert flags == {"Employed total ; Persons": 0, "Hours": 1}
    m = df.select(map_lookup("sheet", {"Data1": "D"}).alias("a"), map_lookup("sheet", {"Data1": "D"}, True).alias("b"))
    assert [(r.a, r.b) for r in m.collect()] == [("D", "D"), (None, "Notes")]


def test_seeds_and_statuses(spark):
    states = schema.state_seed_frame(spark)
    existing = spark.createDataFrame([("NSW", "New South Wales", 0)], states.schema)
    merged = schema.insert_ignore(existing, states, ["state_code"])
    assert merged.count() == 9 and schema.visa_seed_frame(spark).count() == 11
    ev = spark.createDataFrame([("r1", "running"), ("r2", "done"), ("r3", None)], "run_id STRING, status STRING")
    assert sorted(r.run_id for r in invalid_statuses(ev).collect()) == ["r2", "r3"]


def test_scalar_helpers(spark):
    r = spark.range(1).select(
        X.date_text(F.lit("2024-03-05").cast("date"), "yyyy-MM").alias("a"),
        X.title_part(F.lit("Employed total ;  Males ;  Trend"), r";\s+(Males|Females|Persons)").alias("b"),
        X.trim_keep_null(F.lit(None).cast("string")).alias("c"),
        X.fill_rate(F.lit(30), F.lit(120)).alias("d"),
        X.truncate_text(F.lit("x" * 3000)).alias("e"),
        X.absolute_url(F.lit("/download/1/xlsx"), "https://host.example/").alias("f"),
        X.python_round(F.lit(2.25), 1).alias("g"),
        X.null_safe_key(F.lit(None).cast("string"), "0").alias("h"),
        X.code_level(F.lit("261313"), 2).alias("i"),
    ).first()
    assert (r.a, r.b, r.c, r.d, len(r.e), r.f, r.g, r.h, r.i) == (
        "2024-03", "Males", None, 25.0, 2000, "https://host.example/download/1/xlsx", 2.2, "0", "26")


def test_workbook_loader(spark, tmp_root):
    from tests_helpers import write_workbook

    d = os.path.join(tmp_root, "wb")
    os.makedirs(d)
    write_workbook(os.path.join(d, "providers.xlsx"), {
        "Institutions": [["Register of providers"], ["Provider Code", "Provider Name", "State"],
                         ["00001A", "Alpha College", "NSW"], ["00002B", "Beta Institute", None]],
    })
    n = loaders.load_workbook_table(spark, d, tmp_root, "dim_provider", "provider", ["provider_code", "provider_name",
                                    "state"], ["provider_code"], fill=["state"])
    assert n == 2
    got = {r.provider_code: r.state for r in sinks.read_table(spark, tmp_root, "dim_provider").collect()}
    assert got == {"00001A": "NSW", "00002B": "NSW"}
    assert loaders.missing_columns(sinks.read_table(spark, tmp_root, "dim_provider"), ["state", "cricos"]) == ["cricos"]


def test_session_settings(spark):
    from tidemark.session import checkpoint_dir, cluster_conf

    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    # the folder named by the session (set in conftest) is used, never replaced
    assert checkpoint_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/").replace("file:", "")) or \
        spark.conf.get("spark.checkpoint.dir") in checkpoint_dir(spark)


def test_not_in_and_orphans_null_semantics(spark):
    from tidemark.operators.joins import not_in_anti, orphans

    child = spark.createDataFrame([("c1", "p1"), ("c2", "p9"), ("c3", None)], "c STRING, pk STRING")
    parent = spark.createDataFrame([("p1",)], "pk STRING")
    assert sorted(r.c for r in orphans(child, parent, "pk", "pk").collect()) == ["c2", "c3"]  # NULL key is an orphan
    assert [r.c for r in not_in_anti(child, parent, "pk", "pk").collect()] == ["c2"]          # NOT IN skips NULL keys
    with_null = parent.union(spark.createDataFrame([(None,)], "pk STRING"))
    assert not_in_anti(child, with_null, "pk", "pk").count() == 0                            # a NULL in the list empties it


def test_guarded_sum_refuses_rates_and_mixed_measures(spark):
    import pytest

    from tidemark.operators.macro import guarded_corr, guarded_sum

    df = spark.createDataFrame([("2020", "lodged", 5.0), ("2020", "grant_rate_pct", 50.0)], "fy STRING, measure STRING, v DOUBLE")
    with pytest.raises(ValueError):
        guarded_sum(df, ["fy"], "v", "t", measure="grant_rate_pct")
    with pytest.raises(ValueError):
        guarded_sum(df, ["fy"], "v", "t")
    assert guarded_sum(df, ["fy"], "v", "t", measure="lodged").first().t == 5.0
    assert guarded_sum(df, ["fy", "measure"], "v", "t").count() == 2
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (4.0, None)], "x DOUBLE, y DOUBLE")
    c = guarded_corr(pairs, "x", "y").first()
    assert c.n_pairs == 3 and c.correlation > 0.99
    const = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "x DOUBLE, y DOUBLE")
    assert guarded_corr(const, "x", "y").first().correlation is None       # constant side: no correlation
    assert guarded_corr(pairs.limit(2), "x", "y").first().correlation is None  # fewer than 3 pairs


def test_year_alignment_and_gaps(spark):
    from tidemark.operators.macro import aggregate_or_member, align_years, coverage_gaps

    a = spark.createDataFrame([(2019, 10), (2020, 12)], "year INT, enrol BIGINT")
    b = spark.createDataFrame([("2020", 1.5), ("2021", 2.5)], "year STRING, ind DOUBLE")
    full = {r.year: (r.enrol, r.ind) for r in align_years(a, b).collect()}
    assert full == {"2019": (10, None), "2020": (12, 1.5), "2021": (None, 2.5)}
    gaps = {(r.year, r.only_in) for r in coverage_gaps(a, b).collect()}
    assert gaps == {("2019", "left"), ("2021", "right")}
    pop = spark.createDataFrame([("Total", 100), ("India", 7)], "country_name STRING, n INT")
    assert aggregate_or_member(pop, "country_name").first().n == 100
    assert aggregate_or_member(pop, "country_name", "India").first().n == 7


def test_competition_and_aliases(spark):
    from tidemark.operators import geo, providers

    prov = spark.createDataFrame([("1", "A", "NSW"), ("2", "B", "NSW"), ("3", "C", "VIC"), ("4", "D", None)],
                                 "provider_id STRING, provider_name STRING, state_code STRING")
    course = spark.createDataFrame([("c1", "1"), ("c2", "1"), ("c3", "3"), ("c4", "4"), ("c5", None)],
                                   "cricos_code STRING, provider_id STRING")
    dens = {r.state_code: (r.provider_count, r.course_count, r.courses_per_provider)
            for r in providers.competition_density(prov, course).collect()}
    assert dens == {"NSW": (2, 2, 1.0), "VIC": (1, 1, 1.0)}
    ext = providers.competition_extremes(providers.competition_density(prov, course)).first()
    assert (ext.highest_competition_state, ext.lowest_competition_state) == ("VIC", "NSW")  # ties by name
    alias = spark.createDataFrame([("Korea", "Korea, Republic of", "KOREA", "Korea", None)],
                                  "canonical_name STRING, name_education STRING, name_home_affairs STRING, "
                                  "name_abs STRING, name_skilled_mig STRING")
    long = geo.alias_long(alias)
    src = spark.createDataFrame([("Korea, Republic of",), ("Atlantis",)], "name STRING")
    got = {r.name: r.canonical_name for r in geo.canonicalise(src, "name", long, "education").collect()}
    assert got == {"Korea, Republic of": "Korea", "Atlantis": None}
    un = {(r.source, r.name) for r in geo.unmapped_names({"education": src}, long).collect()}
    assert un == {("education", "Atlantis")}


def test_occupation_view_and_mart(spark):
    from tidemark.operators import occupation as occ

    shortage = spark.createDataFrame([("261313", "Software Engineer", "Shortage", "cat", "2025", "AUS")],
                                     "anzsco_code STRING, occupation_name STRING, shortage_status STRING, "
                                     "osca_category STRING, assessment_year STRING, state_code STRING")
    vac = spark.createDataFrame([("2024-01", "2613", "AUS", "Seasonally Adjusted", 10),
                                 ("2024-03", "2613", "AUS", "Seasonally Adjusted", 12),
                                 ("2024-04", "2613", "AUS", "Trend", 99)],
                                "vacancy_period STRING, anzsco_code STRING, state_code STRING, measure STRING, "
                                "vacancy_count BIGINT")
    prof = spark.createDataFrame([("261313", "median_full_time_earnings_per_week", "2000.50"),
                                  ("261313", "employed", "150000")],
                                 "anzsco_code STRING, dimension STRING, value_text STRING")
    exact = occ.occupation_view(shortage, vac, prof).first()
    assert exact.latest_vacancies is None  # six-digit vs four-digit codes never match exactly
    pref = occ.occupation_view(shortage, vac, prof, code_prefix=4).first()
    assert (pref.latest_vacancies, pref.vacancy_as_at, float(pref.median_annual_salary_aud), pref.employment_size) == (
        12, "2024-03", 104026.0, "150000")
    ceil = spark.createDataFrame(
        [("261313", "SE", "189", "NATIONAL", 100, 50, 50.0, "UP", 1), ("261313", "SE", "189", "ALL", 120, 60, 50.0, "DOWN", 2),
         ("261313", "SE", "190", "NSW", 9, 9, 100.0, "UP", 3)],
        "anzsco_code STRING, occupation_name STRING, visa_subclass STRING, state STRING, ceiling BIGINT, "
        "invitations_issued BIGINT, fill_rate_pct DOUBLE, trend STRING, source_row BIGINT")
    osl = spark.createDataFrame([("261313", "SE", "National Shortage", "L1", "National", 1), ("261313", "SE", "A", "L0", "National", 2)],
                                "anzsco_code STRING, occupation_name STRING, shortage_status STRING, shortage_level STRING, state STRING, "
                                "source_row INT")
    lists = spark.createDataFrame([("261313", "SE", "MLTSSL", "ACS", "189, 190", 1), ("261313", "SE", "A", "AAA", "190", 2)],
                                  "anzsco_code STRING, occupation_name STRING, list_type STRING, assessing_body STRING, visa_subclass STRING, "
                                  "source_row INT")
    m = occ.occupation_mart(ceil, osl, lists, "2025-06").first()
    assert (m.ceiling_189, m.trend_189, m.ceiling_190) == (120, "DOWN", None)  # last national row wins; NSW ignored
    assert (m.shortage_national, m.eligible_189, m.eligible_190, m.eligible_491, m.list_type) == (1, 1, 1, 0, "MLTSSL")
    # the first row of the source counts, whatever its text
    swapped = occ.occupation_mart(ceil.unionByName(ceil.withColumn("anzsco_code", F.lit(None).cast("string"))),
                                  osl.withColumn("source_row", -F.col("source_row")), lists, "2025-06").collect()
    assert [(r.anzsco_code, r.shortage_status, r.shortage_national) for r in swapped] == [("261313", "A", 0)]


def test_sector_yoy_new_and_vanished(spark):
    from tidemark.operators.scoring import sector_yoy

    rows = [(2020, 6, "A", "HE", "x", 100, 0), (2020, 6, "A", "VET", "x", 50, 0),
            (2021, 6, "A", "HE", "x", 120, 0), (2021, 6, "A", "ELICOS", "x", 30, 0)]
    fact = spark.createDataFrame(rows, "enrol_year INT, enrol_month INT, nationality STRING, sector STRING, "
                                       "state_code STRING, ytd_enrolments BIGINT, ytd_commencements BIGINT")
    got = {r.sector: (r.current_total, r.previous_total, r.yoy_pct) for r in sector_yoy(fact).collect()}
    assert got == {"HE": (120, 100, 20.0), "VET": (0, 50, -100.0), "ELICOS": (30, 0, None)}


def test_crosstabs(spark):
    from tidemark.operators.reshape import crosstab_periods_to_long, crosstab_to_long

    ct = spark.createDataFrame([("India", 5, None), ("Nepal", 2, 3)], "country STRING, `2006_07` INT, `2007_08` INT")
    long = {(r.country, r.period): r.v for r in crosstab_periods_to_long(ct, ["country"], "v").collect()}
    assert long == {("India", "2006-07"): 5, ("Nepal", "2006-07"): 2, ("Nepal", "2007-08"): 3}
    two = spark.createDataFrame([("189", 4, None)], "visa STRING, NSW INT, VIC INT")
    assert [(r.visa, r.state, r.n) for r in crosstab_to_long(two, "visa", "state", "n").collect()] == [("189", "NSW", 4.0)]


def test_trend_labels_and_ytd_checks(spark):
    from tidemark.operators.windows import trend_label, ytd_decreases

    s = spark.createDataFrame([("A", 2019, 10), ("A", 2020, 12), ("A", 2021, 12), ("A", 2022, 5)], "k STRING, y INT, v INT")
    got = [r.trend for r in trend_label(s, ["k"], "y", "v").orderBy("y").collect()]
    assert got == [None, "UP", "STABLE", "DOWN"]
    ytd = spark.createDataFrame([(2020, 1, "A", 5), (2020, 2, "A", 4), (2020, 3, "A", 6), (2021, 1, "A", 1)],
                                "y INT, m INT, k STRING, ytd INT")
    bad = ytd_decreases(ytd, "y", "m", ["k"], "ytd").collect()
    assert [(r.y, r.m, r.ytd, r.prev_ytd) for r in bad] == [(2020, 2, 4, 5)]  # a new year may restart lower
