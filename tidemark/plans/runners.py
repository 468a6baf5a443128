"""Source runners (L05): a release's sheets, parsed once, to the facts of the star schema.

A ``*_facts`` function takes the grid ``(path, sheet, row_idx, cells)`` of a source's workbooks (from
:func:`tidemark.sources.xlsx.read_grid`, or of CSVs from :func:`csv_grid`) and gives a frame for each table with
the place it came from (``__place``); :func:`load` merges them into the published tables by
key and makes all of them live with one commit.  Of rows with one key the last wins: that of the later
file by name, then of the later row.  Loading the same release again changes no row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.filters import PROVIDER_SHEET_ROUTES, exclude_totals, route_sheet, sheets_excluding
from tidemark.operators.joins import map_lookup
from tidemark.operators.reshape import union_by_name
from tidemark.operators.shape import add_lineage, filename_context, header_rows, view_dimensions
from tidemark.operators.sheets import contains_any, is_any, melted_rows, named_rows, series_rows
from tidemark.sources import readers, sinks
from tidemark.sources.scratch import Scratch

#: Natural keys of the tables that the runners load.
KEYS = {
    "dim_provider": ["provider_id"], "dim_course": ["cricos_code"], "dim_provider_location": ["location_id"],
    "bridge_course_location": ["cricos_code", "location_id"],
    "fact_job_vacancy": ["vacancy_period", "anzsco_code", "state_code", "measure"],
    "fact_occupation_shortage": ["anzsco_code", "anzsco_level", "state_code", "assessment_year"],
    "ref_occupation_profile": ["anzsco_code", "profile_measure", "dimension"],
    "fact_student_visa_activity": ["applicant_type", "sector", "financial_year", "measure"],
    "fact_temp_skilled_visa": ["visa_subclass", "nationality", "financial_year", "state_code", "measure"],
    "fact_temp_graduate_visa": ["stream", "nationality", "financial_year", "measure"],
    "fact_permanent_migration": ["visa_type", "birth_country", "outcome_measure"],
    "fact_labour_force": ["lf_period", "series_id"], "fact_cpi": ["cpi_period", "series_id"],
    "fact_overseas_migration": ["nom_period", "country_name", "state_code", "direction"],
    "fact_population_by_cob": ["erp_period", "country_name", "state_code"],
    "fact_skilled_migration": ["financial_year", "visa_subclass", "stream", "state_code", "measure"],
    "ref_skilled_migration_by_cob_occupation": ["financial_year", "country_name", "anzsco_code", "visa_subclass", "measure"],
    "stg_skillselect_eoi": ["as_at_month", "visa_type", "eoi_status", "source_view", "dimension_1_val", "dimension_2_val"],
}
YEAR_HEADING = r"^\d{4}"


def place() -> Column:
    """Where a row stands in its release: a later file by name comes after an earlier one."""
    return F.concat_ws("\x01", "path", "sheet", F.lpad(F.col("row_idx").cast("string"), 19, "0")).alias("__place")


def _where(grid: DataFrame, *words: str) -> DataFrame:
    """The sheets whose names contain any of ``words``."""
    return grid.where(contains_any(*words)(F.lower("sheet")))


# --- provider register -----------------------------------------------------------------------------------------------

#: Fixed headings of the register's sheets, normalised, in order of preference.
REGISTER_COLUMNS = {
    "provider": {"provider_id": ["provider_id", "providerid", "provider_code", "cricos_provider_code"],
                 "provider_name": ["provider_name", "tradingname", "provider_legal_name", "name", "institution_name"],
                 "provider_type": ["provider_type", "providertype", "institution_type"],
                 "state_code": ["state", "state_or_territory", "postal_address_state"], "website": ["website", "webaddress", "website_address"],
                 "registration_status": ["status"]},
    "course": {"cricos_code": ["cricos_code", "cricos_course_code", "coursecode", "course_code"], "course_name": ["course_name", "coursename", "course_name_full"],
               "field_of_education": ["field_of_education", "fieldofeducation", "field_of_education_code_and_name"],
               "duration_weeks": ["duration_weeks", "durationfulltimeweeks", "duration_in_weeks"],
               "annual_fees_aud": ["fees_aud", "annualcostasinternationalstudent", "total_cost_aud"],
               "provider_id": ["provider_id", "providerid", "cricos_provider_code"]},
    "location": {"location_id": ["location_id", "locationid"], "provider_id": ["provider_id", "providerid", "cricos_provider_code"],
                 "location_name": ["location_name", "locationname", "campus_name"], "suburb": ["suburb", "suburb_or_town", "city"],
                 "state_code": ["state", "state_or_territory"], "postcode": ["postcode"]},
}
REGISTER_COLUMNS["course_location"] = {**{c: REGISTER_COLUMNS["course"][c] for c in ("cricos_code", "provider_id")},
                                       **{c: REGISTER_COLUMNS["location"][c] for c in ("location_id", "location_name")}}


def register_facts(grid: DataFrame) -> dict[str, DataFrame]:
    """Institutions, courses, locations and what is taught where."""
    routed = grid.withColumn("__entity", route_sheet(F.col("sheet"), PROVIDER_SHEET_ROUTES))
    hdr = header_rows(grid, hint="cricos provider code", max_scan_rows=10)

    def rows(entity: str) -> DataFrame:
        return named_rows(routed.where(F.col("__entity") == entity), hdr, REGISTER_COLUMNS[entity])

    at = F.coalesce("location_id", X.synth_location_id("provider_id", "location_name"))
    return {
        "dim_provider": rows("provider").where("provider_id IS NOT NULL").select(*REGISTER_COLUMNS["provider"], place()),
        "dim_course": rows("course").where("cricos_code IS NOT NULL").select(
            "cricos_code", "course_name", "field_of_education", X.lenient_double("duration_weeks").alias("duration_weeks"),
            X.strip_money("annual_fees_aud").alias("annual_fees_aud"), "provider_id", place()),
        "dim_provider_location": rows("location").select(at.alias("location_id"), "provider_id", "location_name", "suburb", "state_code", "postcode", place()),
        "bridge_course_location": rows("course_location").where("cricos_code IS NOT NULL").select("cricos_code", at.alias("location_id"), "provider_id", place()),
    }


# --- labour market: vacancies, shortages, profiles ------------------------------------------------------------------------


def labour_market_facts(vacancies: DataFrame, shortages: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
    """Vacancies with their sheet as measure and months in the
    headings, shortage lists (a list without a state column is national) and profiles as text and number."""
    ids = [("anzsco_code", is_any("anzsco_code", "anzsco", "code")), ("occupation_name", is_any("occupation", "occupation_name", "anzsco_description", "title")),
           ("state_code", is_any("state", "state_territory", "state_or_territory", "geography"))]
    v = _where(vacancies, "sa", "trend", "data", "original", "seasonally")
    long = melted_rows(v, header_rows(v, hint="anzsco|state", min_nonnull=3), ids, "heading", "value", r"\d{4}")
    period, number = X.mangled_header_month("heading"), X.lenient_double("value")
    vacancy = long.select(period.alias("vacancy_period"), F.coalesce("anzsco_code", F.lit("")).alias("anzsco_code"),
                          F.length("anzsco_code").alias("anzsco_level"), F.when(F.col("state_code") == "AUST", F.lit("AUS")).otherwise(F.col("state_code")).alias("state_code"),
                          F.trim("sheet").alias("measure"), number.alias("vacancy_count"), place()).dropna(subset=["vacancy_period", "vacancy_count"])

    roles = [("anzsco_code", contains_any("anzsco+code")), ("anzsco_code", is_any("anzsco")), ("occupation_name", contains_any("occupation", "title")),
             ("shortage_status", contains_any("shortage")), ("osca_category", contains_any("osca", "category")), ("state_code", contains_any("state", "territory")),
             ("assessment_year", contains_any("year", "assessment"))]
    s = shortages
    names = ["anzsco_code", "occupation_name", "shortage_status", "osca_category", "state_code", "assessment_year"]
    listed = _by_roles(s, header_rows(s, hint="anzsco|shortage", min_nonnull=3), roles, names)
    shortage = listed.select("anzsco_code", F.length("anzsco_code").alias("anzsco_level"), "occupation_name", "shortage_status", "osca_category", "assessment_year",
                             F.coalesce("state_code", F.lit("AUS")).alias("state_code"), place()).dropna(subset=["shortage_status", "anzsco_code"])

    p_ids = [("anzsco_code", contains_any("anzsco")), ("occupation_name", contains_any("occupation", "title"))]
    eav = melted_rows(profiles, header_rows(profiles, hint="anzsco|occupation", min_nonnull=3), p_ids, "dimension", "value_text")
    profile = eav.where("anzsco_code IS NOT NULL").select("anzsco_code", "occupation_name", F.trim("sheet").alias("profile_measure"), "dimension",
                                                          X.lenient_double("value_text").alias("value_num"), "value_text", place())
    return {"fact_job_vacancy": vacancy, "fact_occupation_shortage": shortage, "ref_occupation_profile": profile}


def _by_roles(grid: DataFrame, headers: DataFrame, roles: list, names: list[str]) -> DataFrame:
    """P10 by sheet without values: the id columns alone, a row for each row of the sheet."""
    unique = list(dict.fromkeys(r for r, _ in roles))

    def either(role: str):
        rules = [rule for r, rule in roles if r == role]
        return lambda n: F.greatest(*[rule(n) for rule in rules]) if len(rules) > 1 else rules[0](n)

    whole = [(r, either(r)) for r in unique]
    from tidemark.operators.sheets import ROW, SHEET, _cell, _headed

    found = F.transform("__names", lambda n: F.coalesce(*[F.when(rule(n), F.lit(role)) for role, rule in whole]))
    at = [F.coalesce(F.array_position("__roles", n), F.lit(0)).alias(f"__at{i}") for i, n in enumerate(names)]
    body = _headed(grid, headers, "header_row", lambda h: h.withColumn("__roles", found).select(*SHEET, *at))
    return body.select(*ROW, *[_cell(F.col(f"__at{i}")).alias(n) for i, n in enumerate(names)])


# --- visas -----------------------------------------------------------------------------------------------------------------


def _visa(grid: DataFrame, word: str, ids: list, hints: str, fill: list[str]) -> DataFrame:
    """The sheets with ``word`` in their names: merged labels filled down, years to rows, counts stripped to numbers."""
    g = _where(grid, word)
    long = melted_rows(g, header_rows(g, hint=hints, min_nonnull=3), ids, "heading", "value", YEAR_HEADING, fill=fill)
    return long.select("path", "sheet", "row_idx", *[r for r, _ in ids], X.header_period("heading").alias("financial_year"), X.strip_to_number("value").alias("value"))


def visa_facts(grid: DataFrame) -> dict[str, DataFrame]:
    """Four visa facts, each a union of its sheets by measure."""
    country = contains_any("nationality", "country", "citizenship")
    student = [("applicant_type", is_any("applicant_type", "type", "category")), ("sector", is_any("sector", "programme", "program"))]
    skilled = [("visa_subclass", contains_any("visa+subclass", "visa+type")), ("nationality", country), ("state_code", contains_any("state", "territory"))]
    graduate = [("stream", contains_any("stream", "subclass", "visa")), ("nationality", country)]

    def united(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
        return union_by_name([p.withColumn("measure", F.lit(m)) for m, p in parts.items()]).dropna(subset=["value"]).select(*keys, "value", place())

    g = {name: grid.where(F.col("path").contains(name)) for name in ("student", "skilled", "graduate", "outcomes")}
    activity = {m: _visa(g["student"], w, student, "applicant type|sector", ["applicant_type"]) for m, w in
                (("lodged", "lodged"), ("granted", "granted"), ("grant_rate_pct", "rate"))}
    students = exclude_totals(united(activity, KEYS["fact_student_visa_activity"]).where("sector IS NOT NULL"), ["applicant_type", "sector"])
    temp = {m: _visa(g["skilled"], w, skilled, "visa|subclass", ["visa_subclass"]).withColumn("state_code", F.coalesce("state_code", F.lit("AUS")))
            for m, w in (("granted", "grant"), ("holders", "holder"))}
    grads = {m: _visa(g["graduate"], w, graduate, "stream|nationality", ["stream"]) for m, w in (("lodged", "lodged"), ("granted", "grant"))}
    o = g["outcomes"].where(~F.lower("sheet").isin("contents", "notes", "glossary", "introduction"))
    born = [("visa_type", contains_any("visa", "type")), ("birth_country", contains_any("country", "birth"))]
    outcome = melted_rows(o, header_rows(o, hint="visa|country|birth|outcome", min_nonnull=3), born, "outcome_measure", "value")
    permanent = outcome.select("visa_type", "birth_country", "outcome_measure", X.lenient_double("value").alias("value"), place()).dropna(subset=["value"])
    return {"fact_student_visa_activity": students, "fact_temp_skilled_visa": united(temp, KEYS["fact_temp_skilled_visa"]),
            "fact_temp_graduate_visa": united(grads, KEYS["fact_temp_graduate_visa"]), "fact_permanent_migration": permanent}


# --- macro statistics ------------------------------------------------------------------------------------------------------

#: Fixed parts of the labour series' titles.
SEX_PATTERN, ADJUSTMENT_PATTERN = "(Persons|Males|Females)", "(Trend|Seasonally Adjusted|Original)"


def macro_facts(grid: DataFrame) -> dict[str, DataFrame]:
    """Labour and price series with their metadata rows, migration and population
    cross-tabs of country by year (its direction is the sheet's name)."""
    lf = series_rows(grid.where(F.col("path").contains("labour"))).withColumn("number", X.lenient_double("value")).where("number IS NOT NULL")
    labour = lf.select(F.col("period").alias("lf_period"), "series_id", F.col("title").alias("measure"), X.title_part("title", SEX_PATTERN).alias("sex"),
                       F.coalesce("series_type", X.title_part("title", ADJUSTMENT_PATTERN)).alias("adjustment_type"), F.lit("AUS").alias("state_code"),
                       F.col("number").alias("value"), "unit", place())
    pr = series_rows(grid.where(F.col("path").contains("price"))).withColumn("number", X.lenient_double("value")).where("number IS NOT NULL")
    prices = pr.select(F.col("period").alias("cpi_period"), "series_id", "title", F.lit("Index").alias("measure"), F.col("number").alias("value"), place())
    ids = [("country_name", contains_any("country", "birth")), ("state_code", is_any("state"))]

    def crosstab(word: str) -> DataFrame:
        g = grid.where(F.col("path").contains(word))
        long = melted_rows(g, header_rows(g, hint="country", min_nonnull=3), ids, "heading", "value", YEAR_HEADING)
        return long.select("path", "sheet", "row_idx", X.header_period("heading").alias("period"), "country_name",
                           F.coalesce("state_code", F.lit("AUS")).alias("state_code"), X.lenient_double("value").alias("number")).where("number IS NOT NULL AND country_name IS NOT NULL")

    moved = crosstab("migration").select(F.col("period").alias("nom_period"), "country_name", "state_code", F.lower(F.trim("sheet")).alias("direction"), F.col("number").alias("value"), place())
    people = crosstab("population").select(F.col("period").alias("erp_period"), "country_name", "state_code", F.col("number").cast("long").alias("population"), place())
    return {"fact_labour_force": labour, "fact_cpi": prices, "fact_overseas_migration": moved, "fact_population_by_cob": people}


# --- skilled migration -----------------------------------------------------------------------------------------------------


def skilled_facts(grid: DataFrame) -> dict[str, DataFrame]:
    """The programme's summaries (the sheet is the measure) and its
    grants by country of birth and occupation; sheets of notes are left out."""
    ids = [("visa_subclass", contains_any("visa", "subclass")), ("stream", contains_any("stream")), ("state_code", contains_any("state", "territory"))]
    s = sheets_excluding(grid.where(F.col("path").contains("summar")), ("note", "content", "glossary"))
    summary = melted_rows(s, header_rows(s, hint="visa|stream", min_nonnull=3), ids, "heading", "value", YEAR_HEADING, fill=["visa_subclass"])
    summaries = exclude_totals(summary, ["visa_subclass", "stream"]).select(
        X.header_period("heading").alias("financial_year"), X.leading_digits("visa_subclass").alias("visa_subclass"), "stream",
        F.coalesce("state_code", F.lit("AUS")).alias("state_code"), F.trim("sheet").alias("measure"), X.strip_to_number("value").alias("value"), place()).dropna(subset=["value"])
    o = sheets_excluding(grid.where(F.col("path").contains("occupation")), ("note", "content", "glossary"))
    cols = {"financial_year": ["financial_year", "year"], "country_name": ["country_of_birth", "country"], "anzsco_code": ["anzsco_code", "anzsco"],
            "occupation_name": ["occupation", "occupation_name"], "visa_subclass": ["visa_subclass", "subclass"], "value": ["grants", "total", "count"]}
    rows = named_rows(o, header_rows(o, hint="country", min_nonnull=3), cols)
    births = rows.select("financial_year", *[F.coalesce(c, F.lit("")).alias(c) for c in ("country_name", "anzsco_code")], "occupation_name",
                         F.coalesce(X.leading_digits("visa_subclass"), F.lit("")).alias("visa_subclass"), F.lit("granted").alias("measure"),
                         X.strip_to_number("value").alias("value"), place()).dropna(subset=["financial_year", "value"])
    return {"fact_skilled_migration": summaries, "ref_skilled_migration_by_cob_occupation": births}


# --- expressions of interest -----------------------------------------------------------------------------------------------


def csv_grid(spark: SparkSession, path: str, width: int, glob: str = "*.csv", name: Column | None = None) -> DataFrame:
    """CSVs of at most ``width`` columns in UTF-8 or Latin-1 as a grid: sheet is the file's stem (or ``name`` of ``_path``),
    row_idx is 0 for the header and otherwise grows down the file."""
    schema = ", ".join(f"c{i} STRING" for i in range(width))
    rows = readers.read_csv_any_encoding(spark, path, schema, glob, header=False)
    cells = F.transform(F.array(*[F.col(f"c{i}") for i in range(width)]), lambda c: F.regexp_replace(c, "^﻿", ""))
    stem = F.regexp_replace(F.element_at(F.split("_path", "/"), -1), r"\.[^.]*$", "") if name is None else name
    numbered = rows.select(F.col("_path").alias("path"), stem.alias("sheet"), F.monotonically_increasing_id().alias("__id"), F.col("_at").alias("__block"), cells.alias("cells"))
    # a file's blocks may be read in any order: its first line is the first of its first block
    heads = numbered.groupBy("path").agg(F.min(F.struct("__block", "__id")).alias("__first"))
    at = F.when((F.col("__block") == F.col("__first.__block")) & (F.col("__id") == F.col("__first.__id")), F.lit(0)).otherwise(F.col("__block") + 1 + F.col("__id") % (1 << 33))
    return numbered.join(heads, "path").select("path", "sheet", at.cast("long").alias("row_idx"), "cells")


#: Fixed headings that mark a list that is long already.
LONG_MARKERS = ("eoi_count", "count", "number_of_eois", "dimension_1", "dim1")


def interest_facts(grid: DataFrame) -> dict[str, DataFrame]:
    """Exports that are long already, and cross-tabs, whose dimensions the file's name tells.
    Counts that are missing or not positive are left out."""
    heads = grid.where("row_idx = 0").select("path", F.transform("cells", lambda c: F.coalesce(X.norm_name_expr(c), F.lit(""))).alias("__names"))
    kinds = heads.select("path", F.exists("__names", lambda n: n.isin(*LONG_MARKERS)).alias("__long"))
    tagged = grid.join(kinds, "path")
    hdr = grid.select("path", "sheet").distinct().withColumn("header_row", F.lit(0))
    cols = {"dimension_1_name": ["dimension_1_name"], "dimension_1_val": ["dimension_1_val", "dimension_1_value"], "dimension_2_name": ["dimension_2_name"],
            "dimension_2_val": ["dimension_2_val", "dimension_2_value"], "count": ["eoi_count", "number_of_eois", "eoi_number", "count"]}
    long = named_rows(tagged.where("__long"), hdr, cols)
    # in a cross-tab the first column holds the first dimension, whatever it is called, and headings are values: they stay as written
    names = grid.where("row_idx = 0").select("path", F.col("cells").alias("__heads"))
    body = tagged.where("NOT __long AND row_idx > 0").join(names, "path")
    cell = body.select("path", "sheet", "row_idx", F.trim(F.try_element_at("cells", F.lit(1))).alias("dimension_1_val"),
                       F.posexplode(F.arrays_zip(F.col("__heads").alias("h"), F.col("cells").alias("c"))).alias("__at", "x")).where("__at > 0 AND x.h IS NOT NULL")
    dims = view_dimensions(F.col("__view"))
    context = filename_context(F.concat("sheet", F.lit(".csv")))
    wide = cell.withColumn("__view", context["source_view"]).select("path", "sheet", "row_idx", dims["dimension_1_name"].alias("dimension_1_name"), "dimension_1_val",
                                                                    dims["dimension_2_name"].alias("dimension_2_name"), F.trim("x.h").alias("dimension_2_val"), F.col("x.c").alias("count"))
    number = X.strip_money("count")
    both = long.select(*wide.columns).unionByName(wide).withColumn("eoi_count", number).where("eoi_count > 0")
    return {"stg_skillselect_eoi": both.select(*[c.alias(k) for k, c in context.items()], "dimension_1_name", "dimension_1_val", "dimension_2_name", "dimension_2_val", "eoi_count", place())}


# --- loading ---------------------------------------------------------------------------------------------------------------


def load(spark: SparkSession, source: str, facts: Mapping[str, DataFrame], root: str, gate: Callable[[str, DataFrame], None] | None = None) -> dict[str, sinks.LoadResult]:
    """The facts of one source merged into their tables and made live by one commit.
    ``gate`` may look at a frame before anything is written, and raise."""
    with Scratch(spark, f"load-{source}") as scratch:
        # the sheets are parsed once; checks, merges and counts read the parsed rows
        parsed = {k: scratch.cut(df) for k, df in facts.items()}
        if gate is not None:
            for table, df in parsed.items():
                gate(table, df)
        return sinks.upsert_release(spark, root, {k: add_lineage(df, source) for k, df in parsed.items()}, {k: KEYS[k] for k in parsed}, order_col="__place")
