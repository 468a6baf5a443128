"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each callable builds its marts from the landed tables and calls the library
operators.  Parameters (years, members, thresholds) are fixed per query so that the SQL
oracle states the same question.  Pivot headers (periods, priorities) are read from their
column while a plan is built; no other rows reach the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import audit
from tidemark.operators import enrolment as en
from tidemark.operators import filters as flt
from tidemark.operators import geo
from tidemark.operators import joins
from tidemark.operators import macro
from tidemark.operators import occupation as occ
from tidemark.operators import providers as prov
from tidemark.operators import quality as qa
from tidemark.operators import reshape
from tidemark.operators import scoring
from tidemark.operators import shape
from tidemark.operators.windows import forward_fill
from tidemark.operators.windows import percentile_rank
from tidemark.plans import marts
from tidemark.plans.registry import QUERIES, query
from tidemark.schema import state_seed_frame
from tidemark.session import checkpoint_dir
from tidemark.sources.tables import SCHEMAS
from tidemark.sources.tables import Tables
from tidemark.streaming import ingest

# ---------------------------------------------------------------------------
# Enrolment snapshots


@query("m_enrol")
def q_m_enrol(t: Tables) -> DataFrame:
    return marts.m_enrol(t)


@query("a06_latest_period")
def q_latest_period(t: Tables) -> DataFrame:
    return en.latest_period(marts.m_enrol(t))


@query("a04_yearly_snapshot_totals")
def q_yearly_snapshot_totals(t: Tables) -> DataFrame:
    res = en.at_latest_month_of_year(
        marts.m_enrol(t),
        measures={"total_enrolments": en.YTD, "total_commencements": en.COMMENCE},
    )
    return res.orderBy(en.YEAR)


@query("a04_yearly_snapshot_nationality_filtered")
def q_yearly_snapshot_filtered(t: Tables) -> DataFrame:
    return en.at_latest_month_of_year(
        marts.m_enrol(t),
        where=F.col("nationality") == "NATION_7",
        scope="filtered",
        measures={"total_enrolments": en.YTD, "total_commencements": en.COMMENCE},
    )


@query("a01_enrolment_by_country_at_latest")
def q_by_country_latest(t: Tables) -> DataFrame:
    res = en.snapshot_at_latest(marts.m_enrol_recent(t), by=["nationality"])
    return res.orderBy(F.col("total_enrolments").desc(), "nationality")


@query("a01_enrolment_by_country_at")
def q_by_country_at(t: Tables) -> DataFrame:
    return en.snapshot_totals(marts.m_enrol(t, years=(2000, 2000)), 2000, 8, by=["nationality"])


@query("a02_sector_breakdown_at")
def q_sector_at(t: Tables) -> DataFrame:
    return en.snapshot_totals(marts.m_enrol(t, years=(1999, 1999)), 1999, 6, by=["sector"])


@query("a02_sector_breakdown_for_nationality")
def q_sector_for_nat(t: Tables) -> DataFrame:
    return en.snapshot_totals(
        marts.m_enrol(t, years=(1999, 1999)), 1999, 6, by=["sector"], where=F.col("nationality") == "NATION_3"
    )


@query("a03_country_sector_comparison")
def q_country_sector(t: Tables) -> DataFrame:
    members = ("NATION_1", "NATION_4", "NATION_9")
    return en.snapshot_totals(
        marts.m_enrol(t, years=(2000, 2000)), 2000, 12, by=["nationality", "sector"],
        where=F.col("nationality").isin(*members),
    )


@query("a05_sector_yearly_trend")
def q_sector_trend(t: Tables) -> DataFrame:
    return en.at_latest_month_of_year(marts.m_enrol(t), by=["sector"], scope="global").drop(en.MONTH)


@query("a05_country_yearly_trend")
def q_country_trend(t: Tables) -> DataFrame:
    members = ("NATION_2", "NATION_11", "NATION_20")
    res = en.at_latest_month_of_year(
        marts.m_enrol(t), by=["nationality"], where=F.col("nationality").isin(*members), scope="global"
    )
    return res.drop(en.MONTH)


@query("j02_country_growth")
def q_country_growth(t: Tables) -> DataFrame:
    return en.country_growth_latest(marts.m_enrol_recent(t))


GROWTH_MIN_BASE = 40


@query("w05_top_growth")
def q_top_growth(t: Tables) -> DataFrame:
    top, _ = en.growth_movers(en.country_growth_latest(marts.m_enrol_recent(t)), min_previous=GROWTH_MIN_BASE)
    return top.withColumn("growth_pct", F.round("growth_pct", 6))


@query("w05_top_decline")
def q_top_decline(t: Tables) -> DataFrame:
    _, bottom = en.growth_movers(en.country_growth_latest(marts.m_enrol_recent(t)), min_previous=GROWTH_MIN_BASE)
    return bottom.withColumn("growth_pct", F.round("growth_pct", 6))


@query("b06_kpi_block")
def q_kpi(t: Tables) -> DataFrame:
    return en.kpi_block(marts.m_enrol_recent(t))


@query("a13_all_nationalities")
def q_all_nationalities(t: Tables) -> DataFrame:
    return en.distinct_sorted(marts.m_enrol(t), "nationality")


# ---------------------------------------------------------------------------
# Macro series and market drivers


@query("a07_yearly_exchange_rate")
def q_fx_yearly(t: Tables) -> DataFrame:
    res = macro.yearly_mean_by_date(marts.m_fx(t), "rate_date", "value", "avg_rate", F.col("series_id") == "purchase")
    return res.withColumn("avg_rate", F.round("avg_rate", 6)).orderBy("year")


@query("a07_yearly_exchange_rate_monthly_only")
def q_fx_yearly_monthly(t: Tables) -> DataFrame:
    cond = (F.col("series_id") == "click") & (F.col("frequency") == "Monthly")
    res = macro.yearly_mean_by_date(marts.m_fx(t), "rate_date", "value", "avg_rate", cond)
    return res.withColumn("avg_rate", F.round("avg_rate", 6))


@query("a08_yearly_cpi")
def q_cpi_yearly(t: Tables) -> DataFrame:
    res = macro.yearly_by_period_prefix(marts.m_cpi(t), "cpi_period", "value", "avg_cpi", "avg", F.col("series_id") == "CPI_N")
    return res.withColumn("avg_cpi", F.round("avg_cpi", 6)).orderBy("year")


@query("a08_yearly_labour_force")
def q_lf_yearly(t: Tables) -> DataFrame:
    cond = F.col("measure") == "Unemployment rate ;  Persons ;  Seasonally Adjusted"
    res = macro.yearly_by_period_prefix(marts.m_labour(t), "lf_period", "value", "avg_value", "avg", cond)
    return res.withColumn("avg_value", F.round("avg_value", 6))


@query("f05_labour_force_measures")
def q_lf_measures(t: Tables) -> DataFrame:
    pats = ["Employed total%", "Unemployed total%", "Unemployment rate%", "%Participation rate%"]
    return macro.distinct_like(marts.m_labour(t), "measure", pats)


@query("a09_yearly_population_total")
def q_pop_total(t: Tables) -> DataFrame:
    pop = macro.aggregate_or_member(marts.m_population(t), "country_name")
    return macro.yearly_by_period_prefix(pop, "erp_period", "population", "total_population", "sum")


@query("a09_yearly_population_member")
def q_pop_member(t: Tables) -> DataFrame:
    pop = macro.aggregate_or_member(marts.m_population(t), "country_name", "NATION_5")
    return macro.yearly_by_period_prefix(pop, "erp_period", "population", "total_population", "sum")


@query("a09_yearly_overseas_migration")
def q_nom(t: Tables) -> DataFrame:
    nom = macro.aggregate_or_member(marts.m_nom(t), "country_name").where(F.col("direction") == "net")
    return macro.yearly_by_period_prefix(nom, "nom_period", "value", "total_value", "sum")


@query("m_population")
def q_m_population(t: Tables) -> DataFrame:
    return marts.m_population(t)


def _enrol_yearly(t: Tables) -> DataFrame:
    return en.at_latest_month_of_year(marts.m_enrol(t)).select(
        F.col(en.YEAR).cast("string").alias("year"), "total_enrolments"
    )


def _nom_yearly(t: Tables) -> DataFrame:
    nom = macro.aggregate_or_member(marts.m_nom(t), "country_name").where(F.col("direction") == "net")
    return macro.yearly_by_period_prefix(nom, "nom_period", "value", "indicator_value", "sum")


@query("j08_enrolment_vs_migration")
def q_align(t: Tables) -> DataFrame:
    return macro.align_years(_enrol_yearly(t), _nom_yearly(t), how="full")


@query("u03_coverage_gaps")
def q_gaps(t: Tables) -> DataFrame:
    return macro.coverage_gaps(_enrol_yearly(t), _nom_yearly(t))


def _cpi_yearly(t: Tables) -> DataFrame:
    res = macro.yearly_by_period_prefix(marts.m_cpi(t), "cpi_period", "value", "indicator_value", "avg",
                                        F.col("series_id") == "CPI_N")
    return res


@query("j09_enrolment_vs_cpi")
def q_j09(t: Tables) -> DataFrame:
    enrol = en.snapshot_month_per_year(marts.m_enrol(t), 12).select(
        F.col(en.YEAR).cast("string").alias("year"), "total_enrolments"
    )
    res = macro.align_years(enrol, _cpi_yearly(t), how="inner")
    return res.withColumn("indicator_value", F.round("indicator_value", 6))


@query("a21_enrolment_migration_correlation")
def q_corr(t: Tables) -> DataFrame:
    res = macro.guarded_corr(macro.align_years(_enrol_yearly(t), _nom_yearly(t)), "total_enrolments", "indicator_value")
    return res.withColumn("correlation", F.round("correlation", 6))


@query("b10_market_drivers")
def q_b10(t: Tables) -> DataFrame:
    pairs = macro.align_years(_enrol_yearly(t), _cpi_yearly(t), how="full")
    return pairs.withColumn("indicator_value", F.round("indicator_value", 6)).orderBy("year")


# ---------------------------------------------------------------------------
# Scoring and rules


def _score_inputs(t: Tables) -> DataFrame:
    return scoring.opportunity_inputs(marts.m_enrol_recent(t), marts.m_skilled_cob(t))


@query("b01_opportunity_score_inputs")
def q_b01(t: Tables) -> DataFrame:
    return _score_inputs(t).withColumn("growth_pct", F.round("growth_pct", 6))


@query("b02_opportunity_scores")
def q_b02(t: Tables) -> DataFrame:
    s = scoring.opportunity_scores(_score_inputs(t))
    return s.select(
        "nationality",
        F.round("growth_score", 6).alias("growth_score"),
        F.round("market_size_score", 6).alias("market_size_score"),
        F.round("visa_score", 6).alias("visa_score"),
        "opportunity_score",
        "data_confidence_pct",
        scoring.weights_text().alias("weights_used"),
    )


@query("w01_percentile_rank_growth")
def q_w01(t: Tables) -> DataFrame:
    g = en.country_growth_latest(marts.m_enrol_recent(t)).withColumn(
        "growth_pct", X.pct_change("current_total", "previous_total")
    )
    r = percentile_rank(g, "previous_total", "prev_rank")
    return r.select("nationality", "previous_total", F.round("prev_rank", 6).alias("prev_rank"))


@query("a22_median_current_volume")
def q_a22(t: Tables) -> DataFrame:
    return scoring.median_of(_score_inputs(t), "current_volume").withColumn(
        "median_volume", F.round("median_volume", 6)
    )


@query("b03_marketing_recommendation")
def q_b03(t: Tables) -> DataFrame:
    r = scoring.recommendations(_score_inputs(t))
    return r.select(
        "nationality",
        F.round("growth_pct", 6).alias("growth_pct"),
        "current_volume",
        F.round("median_volume", 6).alias("median_volume"),
        "recommendation",
    )


@query("b04_sector_yoy")
def q_b04(t: Tables) -> DataFrame:
    return scoring.sector_yoy(marts.m_enrol_recent(t))


@query("x20_formatted_kpis")
def q_x20(t: Tables) -> DataFrame:
    k = en.kpi_block(marts.m_enrol_recent(t))
    return k.select(
        X.period_label(en.YEAR, en.MONTH).alias("period"),
        X.fmt_number("current_total").alias("current_text"),
        X.fmt_number("same_month_last_year").alias("prior_text"),
        X.fmt_pct("yoy_pct", 1, signed=True).alias("yoy_text"),
        X.safe_ratio("current_total", "same_month_last_year").alias("ratio"),
    ).withColumn("ratio", F.round("ratio", 6))


# ---------------------------------------------------------------------------
# Occupation marts


@query("b08_occupation_view_exact")
def q_b08_exact(t: Tables) -> DataFrame:
    v = occ.occupation_view(marts.m_shortage(t), marts.m_vacancy(t), marts.m_profile(t))
    return v.withColumn("median_annual_salary_aud", F.col("median_annual_salary_aud").cast("double"))


@query("b08_occupation_view")
def q_b08(t: Tables) -> DataFrame:
    v = occ.occupation_view(marts.m_shortage(t), marts.m_vacancy(t), marts.m_profile(t), code_prefix=4)
    return v.withColumn("median_annual_salary_aud", F.col("median_annual_salary_aud").cast("double"))


@query("w02_latest_vacancy_per_code")
def q_w02(t: Tables) -> DataFrame:
    vac = marts.m_vacancy(t).where(F.col("measure") == "Seasonally Adjusted")
    return occ.latest_per_key(vac, ["anzsco_code", "state_code"], "vacancy_period", ["vacancy_count"])


@query("r04_occupation_profile_eav")
def q_r04(t: Tables) -> DataFrame:
    return marts.m_profile(t)


@query("r11_profile_to_columns")
def q_r11(t: Tables) -> DataFrame:
    return reshape.eav_to_columns(
        marts.m_profile(t), ["anzsco_code"], "dimension", "value_text",
        ["median_full_time_earnings_per_week", "employed"],
    )


@query("b07_occupation_mart")
def q_b07(t: Tables) -> DataFrame:
    return occ.occupation_mart(marts.m_ceilings(t), marts.m_osl(t), marts.m_visa_lists(t), "2025-06")


@query("j11_eligibility_exact_tokens")
def q_j11(t: Tables) -> DataFrame:
    return occ.eligibility_flags(marts.m_visa_lists(t), marts.SUBCLASSES, exact_tokens=True)


@query("u08_occupation_dimension")
def q_u08(t: Tables) -> DataFrame:
    return occ.occupation_dimension(marts.m_shortage(t), marts.m_profile(t), marts.m_vacancy(t))


@query("r10_ceiling_pivot")
def q_r10(t: Tables) -> DataFrame:
    national = F.upper(F.col("state")).isin(*occ.NATIONAL_STATES)
    return reshape.conditional_pivot_last_wins(
        marts.m_ceilings(t), "anzsco_code", "visa_subclass", marts.SUBCLASSES,
        {"ceiling": "ceiling_{v}", "invitations_issued": "invitations_{v}"}, "source_row", where=national,
    )


# ---------------------------------------------------------------------------
# Provider landscape and country aliases


@query("a10_providers_by_state")
def q_a10_prov(t: Tables) -> DataFrame:
    return prov.count_by(marts.m_provider(t), "state_code", "provider_count")


@query("a10_locations_by_state")
def q_a10_loc(t: Tables) -> DataFrame:
    return prov.count_by(marts.m_location(t), "state_code", "location_count")


@query("a11_provider_count")
def q_a11(t: Tables) -> DataFrame:
    return prov.table_count(marts.m_provider(t))


@query("j03_courses_by_state")
def q_j03(t: Tables) -> DataFrame:
    return prov.courses_by_state(marts.m_course(t), marts.m_provider(t)).orderBy(F.col("course_count").desc())


@query("t02_courses_by_provider_top")
def q_t02(t: Tables) -> DataFrame:
    return prov.courses_by_provider(marts.m_course(t), marts.m_provider(t), top_n=20)


@query("j15_orphan_courses")
def q_j15(t: Tables) -> DataFrame:
    o = joins.orphans(marts.m_course(t), marts.m_provider(t), "provider_id", "provider_id")
    return o.select("cricos_code", "provider_id")


@query("j15_orphan_bridge_rows")
def q_j15b(t: Tables) -> DataFrame:
    o = joins.orphans(marts.m_bridge(t), marts.m_course(t), "cricos_code", "cricos_code")
    return prov.table_count(o, "orphan_rows")


@query("j16_courses_unknown_provider")
def q_j16(t: Tables) -> DataFrame:
    o = joins.not_in_anti(marts.m_course(t), marts.m_provider(t), "provider_id", "provider_id")
    return o.select("cricos_code", "provider_id")


def _courses_with_gaps(t: Tables) -> DataFrame:
    """Courses, those whose code ends in 7 without a provider."""
    gap = F.col("cricos_code").endswith("7")
    return marts.m_course(t).select("cricos_code", F.when(~gap, F.col("provider_id")).alias("provider_id"))


@query("j15_courses_without_listed_provider")
def q_j15c(t: Tables) -> DataFrame:
    listed = marts.m_provider(t).where(F.col("state_code").isNotNull())
    return joins.orphans(_courses_with_gaps(t), listed, "provider_id", "provider_id").select("cricos_code", "provider_id")


@query("j16_not_in_with_and_without_null")
def q_j16b(t: Tables) -> DataFrame:
    provider = marts.m_provider(t)
    listed = provider.where(F.col("state_code").isNotNull()).select("provider_id")
    holed = provider.select(F.when(F.col("state_code").isNotNull(), F.col("provider_id")).alias("provider_id"))
    courses, out = _courses_with_gaps(t), None
    for name, parent in (("listed", listed), ("listed or null", holed), ("none", listed.limit(0))):
        part = joins.not_in_anti(courses, parent, "provider_id", "provider_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("parents"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("j17_course_locations")
def q_j17(t: Tables) -> DataFrame:
    return prov.course_locations(marts.m_course(t), marts.m_bridge(t), marts.m_location(t))


@query("b05_competition_density")
def q_b05(t: Tables) -> DataFrame:
    d = prov.competition_density(marts.m_provider(t), marts.m_course(t))
    return d.withColumn("courses_per_provider", F.round("courses_per_provider", 6))


@query("t08_competition_extremes")
def q_t08(t: Tables) -> DataFrame:
    e = prov.competition_extremes(prov.competition_density(marts.m_provider(t), marts.m_course(t)))
    return e.select(
        "highest_competition_state",
        F.round("highest_courses_per_provider", 6).alias("highest_courses_per_provider"),
        "lowest_competition_state",
        F.round("lowest_courses_per_provider", 6).alias("lowest_courses_per_provider"),
    )


@query("p21_location_ids")
def q_p21(t: Tables) -> DataFrame:
    return marts.m_location(t)


@query("j19_provider_state_names")
def q_j19(t: Tables) -> DataFrame:
    states = F.broadcast(state_seed_frame(t.spark))  # 9 fixed seed rows
    p = marts.m_provider(t).join(states, "state_code", "left")
    return p.groupBy("state_code", "state_name").agg(F.count(F.lit(1)).alias("provider_count"))


@query("j19_enrolment_by_region")
def q_j19b(t: Tables) -> DataFrame:
    dim = marts.m_alias(t).select(F.col("canonical_name").alias("nationality"), "region")
    snap = en.snapshot_at_latest(marts.m_enrol_recent(t), by=["nationality"])
    j = snap.join(dim, "nationality", "left")
    return j.groupBy("region").agg(F.sum("total_enrolments").cast("long").alias("total_enrolments"))


def _skilled_names(t: Tables) -> DataFrame:
    return marts.m_skilled_cob(t).select(F.lower("country_name").alias("source_name")).distinct()


@query("j13_canonical_country_names")
def q_j13(t: Tables) -> DataFrame:
    aliases = geo.alias_long(marts.m_alias(t))
    return geo.canonicalise(_skilled_names(t), "source_name", aliases, "skilled_mig")


@query("u07_unmapped_country_names")
def q_u07(t: Tables) -> DataFrame:
    aliases = geo.alias_long(marts.m_alias(t))
    frames = {
        "education": en.distinct_sorted(marts.m_enrol(t), "nationality"),
        "abs": marts.m_population(t).select("country_name").distinct(),
        "skilled_mig": _skilled_names(t),
    }
    return geo.unmapped_names(frames, aliases)


# ---------------------------------------------------------------------------
# Quality checks and reports


BASIC_KEYS = [en.YEAR, en.MONTH, "nationality", "sector", "state_code"]
DETAILED_FULL_KEYS = [en.YEAR, en.MONTH, *marts.DETAILED_KEYS]


@query("g09_grain_guard")
def q_g09(t: Tables) -> DataFrame:
    return qa.grain_guard(marts.m_enrol_detailed(t), BASIC_KEYS, DETAILED_FULL_KEYS)


@query("g10_redundant_total_column")
def q_g10(t: Tables) -> DataFrame:
    return qa.redundant_share(marts.m_enrol_detailed(t), "total", "ytd_enrolments")


@query("a16_duplicate_basic_keys_in_detailed")
def q_a16(t: Tables) -> DataFrame:
    return qa.duplicate_key_groups(marts.m_enrol_detailed(t), BASIC_KEYS)


@query("a24_nulls_per_column")
def q_a24(t: Tables) -> DataFrame:
    return qa.nulls_per_column(marts.m_shortage(t))


@query("g14_check_report")
def q_g14(t: Tables) -> DataFrame:
    enrol = marts.m_enrol(t)
    vac = marts.m_vacancy(t)
    return qa.report([
        qa.keyed_table_checks(enrol, "fact_student_enrolment", BASIC_KEYS, distinct=("sector", 5)),
        qa.keyed_table_checks(vac, "fact_job_vacancy", ["vacancy_period", "anzsco_code", "state_code", "measure"],
                              blanks={"anzsco_code": ""}, formats={"vacancy_period": r"^\d{4}-\d{2}$"}).where(
            F.col("check").isin("duplicate_keys", "format_vacancy_period")),
        qa.orphans_count(marts.m_bridge(t), marts.m_course(t), "bridge_course_location", "cricos_code",
                         "cricos_code"),
        qa.in_range(marts.m_cpi(t), "fact_cpi", "value", 1.0, 50.0),
        qa.at_least(marts.m_provider(t), "dim_provider", 5),
    ])


@query("w06_ytd_never_falls")
def q_w06(t: Tables) -> DataFrame:
    from tidemark.operators.windows import ytd_decreases

    return ytd_decreases(marts.m_enrol(t), en.YEAR, en.MONTH, ["nationality", "sector", "state_code"], en.YTD)


@query("w06_monthly_flow_falls")
def q_w06b(t: Tables) -> DataFrame:
    from tidemark.operators.windows import deaccumulate_ytd, ytd_decreases

    keys = ["nationality", "sector", "state_code"]
    flows = deaccumulate_ytd(marts.m_enrol(t), en.YEAR, en.MONTH, keys, en.YTD, "flow")
    return ytd_decreases(flows, en.YEAR, en.MONTH, keys, "flow").withColumnRenamed("prev_ytd", "previous_flow")


@query("w07_monthly_flow_from_ytd")
def q_w07(t: Tables) -> DataFrame:
    from tidemark.operators.windows import deaccumulate_ytd

    flows = deaccumulate_ytd(marts.m_enrol(t), en.YEAR, en.MONTH, ["nationality", "sector", "state_code"],
                             en.YTD, "monthly_enrolments")
    return flows.groupBy(en.YEAR, en.MONTH).agg(F.sum("monthly_enrolments").cast("long").alias("monthly_enrolments"))


@query("w08_trend_labels")
def q_w08(t: Tables) -> DataFrame:
    from tidemark.operators.windows import trend_label

    yearly = en.at_latest_month_of_year(marts.m_enrol(t), by=["nationality"], scope="global")
    return trend_label(yearly, ["nationality"], en.YEAR, "total_enrolments").select(
        "nationality", en.YEAR, "total_enrolments", "trend"
    )


# ---------------------------------------------------------------------------
# Sheet grid, reshape and scalar functions


@query("p02_header_detection")
def q_p02(t: Tables) -> DataFrame:
    g = marts.m_grid(t)
    a = shape.header_rows(g, hint="country", out="hint_row")
    b = shape.header_rows(g, out="nonnull_row")
    c = shape.header_rows(g, hint="country", min_nonnull=3, out="hint_nonnull_row")
    d = shape.header_rows(g, all_hints=["country", "key"], out="both_row")
    return a.join(b, ["path", "sheet"]).join(c, ["path", "sheet"]).join(d, ["path", "sheet"])


@query("r12_grid_tidy_forward_fill")
def q_r12(t: Tables) -> DataFrame:
    g = marts.m_grid(t)
    hdr = shape.header_rows(g, hint="country", min_nonnull=3)
    tidy = shape.grid_to_table(g, hdr, ["country", "nation_key", "region"])
    return forward_fill(tidy, ["path", "sheet"], "row_idx", ["region"])


@query("p24_student_visa_activity")
def q_p24(t: Tables) -> DataFrame:
    v = marts.m_visa_activity(t)
    return v.select(
        "applicant_type", "sector", X.fy_dash("financial_year").alias("financial_year"), "measure", "value"
    ).orderBy("financial_year", "applicant_type", "sector", "measure")


@query("a20_visa_lodged_by_year")
def q_a20(t: Tables) -> DataFrame:
    return macro.guarded_sum(marts.m_visa_activity(t), ["financial_year"], "value", "total_value", measure="lodged")


@query("p23_dynamic_grain_sum")
def q_p23(t: Tables) -> DataFrame:
    v = marts.m_visa_activity(t).where(F.col("measure") == "granted")
    return macro.guarded_sum(v.drop("measure"), ["sector", "applicant_type"], "value", "total_value")


@query("r09_series_pivot")
def q_r09(t: Tables) -> DataFrame:
    return marts.m_series_wide(t)


@query("r01_series_unpivot")
def q_r01(t: Tables) -> DataFrame:
    wide = marts.m_series_wide(t)
    years = reshape.year_columns(wide.columns)
    return reshape.unpivot_columns(wide, ["l_returnflag", "l_linestatus"], years, "year", "quantity")


@query("x01_x03_x11_text_coercions")
def q_x_coerce(t: Tables) -> DataFrame:
    p = t.read("part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    price_text = F.concat(F.lit("$"), F.format_number("p_retailprice", 2))
    size_text = F.concat(F.col("p_size").cast("string"), F.lit(" units"))
    label = F.concat(F.col("p_size").cast("string"), F.lit(" Temporary Work"))
    return p.select(
        "p_partkey",
        X.strip_money(price_text).alias("price"),
        X.strip_to_number(size_text).alias("size"),
        X.lenient_double("p_brand").alias("brand_number"),
        X.leading_digits(label).alias("leading_code"),
        X.zero_fill_long(F.when(F.col("p_size") > 25, F.col("p_size"))).alias("size_or_zero"),
    )


@query("x05_x14_date_and_period_text")
def q_x_dates(t: Tables) -> DataFrame:
    o = t.read("orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    mangled = F.concat(F.date_format("d", "yyyy_MM_dd"), F.lit("_00_00_00"))
    return o.select(
        F.col("d").alias("order_date"),
        X.parse_day_first_date(F.date_format("d", "d-MMM-yyyy")).alias("parsed_date"),
        X.month_number(F.date_format("d", "MMMM")).alias("month_from_name"),
        X.mangled_header_month(mangled).alias("header_month"),
        X.fy_dash(marts._fy_text("d", "_")).alias("financial_year"),
        X.period_label(F.year("d"), F.month("d")).alias("period"),
        X.month_label(F.year("d"), F.month("d")).alias("month_label"),
    )


@query("x27_event_props_json")
def q_x27(t: Tables) -> DataFrame:
    ev = t.read("events", "event_type", "props")
    k = F.from_json("props", "k INT")["k"]
    return ev.groupBy("event_type").agg(F.sum(k).cast("long").alias("sum_k"), F.count(k).alias("n_k"))


@query("r14_message_role_histogram")
def q_r14(t: Tables) -> DataFrame:
    c = t.read("conversations", "role")
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "role").limit(15)


LINK_PATTERN = r'<a href="([^"]*)"'
ALLOWED_LINK = r"^https://[^/]+\.example\.(com|org)/"


@query("b12_page_links")
def q_b12(t: Tables) -> DataFrame:
    p = t.read("pages", "page_id", "url", "html")
    base = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    links = p.select(
        "page_id", base.alias("base"), F.posexplode(F.regexp_extract_all("html", F.lit(LINK_PATTERN), 1)).alias(
            "link_pos", "href"
        )
    )
    absolute = X.absolute_url("href", F.col("base"))
    return links.select(
        "page_id", "link_pos", absolute.alias("link"), absolute.rlike(ALLOWED_LINK).alias("is_allowed")
    )


# ---------------------------------------------------------------------------
# Aggregate profiles, filters, sorts and copy text


@query("a12_visa_volume_by_country")
def q_a12(t: Tables) -> DataFrame:
    v = flt.not_null(marts.m_skilled_cob(t), "country_name")
    return v.groupBy(F.col("country_name").alias("nationality")).agg(F.sum("value").alias("visa_volume"))


@query("a14_distinct_counts_by_sector")
def q_a14(t: Tables) -> DataFrame:
    return marts.m_enrol(t).groupBy("sector").agg(
        F.countDistinct("nationality").alias("n_nationalities"),
        F.countDistinct("state_code").alias("n_states"),
        F.countDistinct(en.YEAR).alias("n_years"),
    )


@query("a15_course_null_profile")
def q_a15(t: Tables) -> DataFrame:
    return marts.m_course(t).agg(
        F.count(F.lit(1)).alias("n_courses"),
        F.count_if(F.col("provider_id").isNull()).alias("null_providers"),
        F.min("tuition_fee").alias("min_fee"),
        F.max("tuition_fee").alias("max_fee"),
        F.round(F.avg("tuition_fee"), 6).alias("avg_fee"),
    )


@query("a19_visa_grouping_sets")
def q_a19(t: Tables) -> DataFrame:
    v = marts.m_visa_activity(t).where(F.col("measure") == "lodged")
    cols = ["applicant_type", "sector", "financial_year"]
    sets = [["applicant_type"], ["sector"], ["financial_year"], ["applicant_type", "sector"],
            ["sector", "financial_year"], []]
    return v.groupingSets(sets, *cols).agg(
        F.sum("value").alias("total_value"), F.grouping_id().alias("grouping_level")
    )


@query("a23_series_coverage")
def q_a23(t: Tables) -> DataFrame:
    return marts.m_fx(t).groupBy("series_id").agg(
        F.min("rate_date").alias("first_date"),
        F.max("rate_date").alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("rate_date").alias("n_days"),
    )


@query("a25_rows_by_sector")
def q_a25(t: Tables) -> DataFrame:
    return marts.m_enrol(t).groupBy("sector").agg(F.count(F.lit(1)).alias("n_rows"))


@query("a26_grand_total_kpi")
def q_a26(t: Tables) -> DataFrame:
    return en.snapshot_at_latest(marts.m_enrol_recent(t), by=[])


@query("f06_numeric_profile_values")
def q_f06(t: Tables) -> DataFrame:
    p = marts.m_profile(t).where(flt.matches("value_text", flt.NUMERIC_TEXT))
    return p.groupBy("dimension").agg(F.count(F.lit(1)).alias("n_numeric"))


@query("f07_six_digit_codes")
def q_f07(t: Tables) -> DataFrame:
    codes = marts.m_shortage(t).select("anzsco_code").unionByName(marts.m_vacancy(t).select("anzsco_code"))
    six = codes.where(flt.matches("anzsco_code", flt.SIX_DIGIT_CODE))
    return six.agg(F.countDistinct("anzsco_code").alias("n_codes"))


@query("f10_population_rows_without_totals")
def q_f10(t: Tables) -> DataFrame:
    p = flt.exclude_totals(marts.m_population(t), ["country_name"])
    return p.groupBy("erp_period").agg(F.count(F.lit(1)).alias("n_rows"))


@query("f12_positive_net_migration")
def q_f12(t: Tables) -> DataFrame:
    n = flt.positive(marts.m_nom(t).where(F.col("direction") == "net"), "value")
    return n.groupBy("nom_period").agg(F.count(F.lit(1)).alias("n_rows"))


@query("f13_sheet_selection")
def q_f13(t: Tables) -> DataFrame:
    g = flt.sheets_excluding(marts.m_grid(t), ["east", "europe"])
    return g.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_rows"))


@query("t05_two_key_sort")
def q_t05(t: Tables) -> DataFrame:
    v = marts.m_visa_activity(t).where(F.col("measure") == "lodged")
    return v.select("sector", "financial_year", "applicant_type", "value").orderBy(
        F.col("sector").asc(), F.col("value").desc(), "financial_year", "applicant_type"
    )


@query("t06_top_fill_rate")
def q_t06(t: Tables) -> DataFrame:
    c = flt.national_only(marts.m_ceilings(t)).where(F.col("ceiling") >= 50)
    return c.select("anzsco_code", "visa_subclass", "state", "ceiling", "fill_rate_pct").orderBy(
        F.col("fill_rate_pct").desc(), "anzsco_code", "visa_subclass", "state"
    ).limit(10)


@query("t07_head_enrolments")
def q_t07(t: Tables) -> DataFrame:
    s = en.snapshot_at_latest(marts.m_enrol_recent(t), by=["nationality"])
    return s.orderBy(F.col("total_enrolments").desc(), "nationality").limit(5)


@query("u02_mart_table_counts")
def q_u02(t: Tables) -> DataFrame:
    parts = {"dim_provider": marts.m_provider(t), "dim_course": marts.m_course(t),
             "dim_provider_location": marts.m_location(t), "bridge_course_location": marts.m_bridge(t)}
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("table_name"), "rows")
              for k, df in parts.items()]
    return reshape.union_by_name(frames)


@query("x28_occupation_copy")
def q_x28(t: Tables) -> DataFrame:
    m = occ.occupation_mart(marts.m_ceilings(t), marts.m_osl(t), marts.m_visa_lists(t), "2025-06")
    return m.select("anzsco_code", occ.occupation_copy().alias("copy_text"))


@query("r03_crosstab_periods_to_long")
def q_r03(t: Tables) -> DataFrame:
    nom = marts.m_nom(t).where((F.col("direction") == "net") & (F.col("country_name") != "Total"))
    nom = nom.withColumn("hdr", F.regexp_replace("nom_period", "-", "_"))  # header as name-normalised
    # pivot headers: the financial years present (calendar-bounded), found from the date column alone
    fy = marts._fy_text("o_orderdate", "_")
    periods = sorted(r[0] for r in t.read("orders", "o_orderdate").select(fy.alias("h")).distinct().collect())
    wide = nom.groupBy("country_name").pivot("hdr", periods).agg(F.sum("value"))
    return reshape.crosstab_periods_to_long(wide, ["country_name"], "value", "nom_period")


@query("r06_crosstab_to_long")
def q_r06(t: Tables) -> DataFrame:
    snap = en.snapshot_at_latest(marts.m_enrol_recent(t), by=["nationality", "sector"])
    # pivot headers: the priority labels (a handful), from that one column of orders
    pri = t.read("orders", "o_orderpriority").distinct()
    sectors = sorted(r[0] for r in pri.collect())
    wide = snap.groupBy("nationality").pivot("sector", sectors).agg(F.first("total_enrolments"))
    return reshape.crosstab_to_long(wide, "nationality", "sector", "total_enrolments")


@query("b09_visa_list_extract")
def q_b09(t: Tables) -> DataFrame:
    p = t.read("part", "p_partkey", "p_name", "p_brand", "p_size")
    code = marts.occupation_code("p_partkey")
    frames = {
        "MLTSSL": p.where(F.col("p_size") <= 10).select(code.alias("ANZSCO Code"), F.col("p_name").alias("Occupation"),
                                                        F.lit("189, 190, 491").alias("Visa Subclasses")),
        "STSOL": p.where(F.col("p_size").between(11, 25)).select(code.alias("anzsco"), F.col("p_name").alias("Occupation"),
                                                                 F.lit("190, 491").alias("Visa Subclasses")),
        "ROL": p.where(F.col("p_size").between(26, 40)).select(code.alias("Code"), F.col("p_name").alias("Occupation"),
                                                               F.col("p_brand").alias("Assessing Authority")),
    }
    out = occ.extract_lists(frames)
    return out.select("anzsco_code", "occupation", "visa_subclass", "assessing_authority", "list_type")


# ---------------------------------------------------------------------------
# Streaming (run to completion with AvailableNow over the landed events table)


def _events_stream(t: Tables) -> DataFrame:
    return ingest.landing_stream(t.spark, t.root, SCHEMAS["events"], pathGlobFilter="events.parquet")


@query("st4_daily_event_averages")
def q_st4(t: Tables) -> DataFrame:
    name = f"st4_{uuid.uuid4().hex}"  # a fresh checkpoint per run: every run sees the whole table
    root = f"{checkpoint_dir(t.spark).rstrip('/')}/published/{name}"
    daily = ingest.daily_averages(_events_stream(t), "ts", "event_type", "value")
    out = ingest.run_to_table(daily, name, root, "daily_averages", ["window_start", "event_type"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                      F.round("avg_value", 6).alias("avg_value"), "n")


@query("st2_stream_upsert_latest_event")
def q_st2(t: Tables) -> DataFrame:
    run = uuid.uuid4().hex
    root = f"{checkpoint_dir(t.spark).rstrip('/')}/published/{run}"
    stream = _events_stream(t).select(
        "user_id", "event_type", "value", F.col("ts").alias("last_ts"), F.col("event_id").alias("__row_seq")
    )
    handler = ingest.upsert_each_batch(root, "latest_event", ["user_id", "event_type"], audit_source="events")
    ingest.run_available(stream, f"st2_{run}", handler, checkpoint=f"{root}/_checkpoint")
    from tidemark.sources.sinks import read_table

    return read_table(t.spark, root, "latest_event").select(
        "user_id", "event_type", "value", "last_ts"
    )


@query("s09_enrolment_sheets_roundtrip")
def q_s09(t: Tables) -> DataFrame:
    from tidemark.plans.loaders import parse_enrolment_grid

    return parse_enrolment_grid(marts.m_enrol_sheets(t), "basic")


# ---------------------------------------------------------------------------
# Load audit


@query("l01_audit_runs_folded")
def q_l01(t: Tables) -> DataFrame:
    r = audit.fold_runs(marts.m_audit(t))
    return r.select("run_id", "source", "table_name", "status", "started_at", "completed_at", "rows_inserted",
                    "error_message")


@query("a18_last_etl_updates")
def q_a18(t: Tables) -> DataFrame:
    return audit.last_completed(audit.fold_runs(marts.m_audit(t)))


@query("t03_recent_failures")
def q_t03(t: Tables) -> DataFrame:
    return audit.recent_failures(audit.fold_runs(marts.m_audit(t)), limit=10)


@query("l03_freshness_banner")
def q_l03(t: Tables) -> DataFrame:
    return audit.freshness(audit.fold_runs(marts.m_audit(t)))


@query("s10_pivot_cache_decode")
def q_s10(t: Tables) -> DataFrame:
    from tidemark.sources.xlsx import decode_pivot_records

    fields, records = marts.m_enrol_pivot_cache(t)
    long = decode_pivot_records(fields, records)
    wide = long.groupBy("record_idx").agg(
        *[F.max(F.when(F.col("field_name") == n, F.col("value"))).alias(n) for n in ("Nationality", "Sector", "YTD")]
    )
    return wide.groupBy(F.col("Nationality").alias("nationality"), F.col("Sector").alias("sector")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.col("YTD").cast("long")).alias("ytd_total")
    )


@query("a04_yearly_snapshot_nationality_global")
def q_a04_global(t: Tables) -> DataFrame:
    """Q3: the latest month of each year taken over all members, then NATION_7."""
    return en.at_latest_month_of_year(
        marts.m_enrol(t),
        where=F.col("nationality") == "NATION_7",
        scope="global",
        measures={"total_enrolments": en.YTD, "total_commencements": en.COMMENCE},
    )


@query("a05_sector_yearly_trend_selected")
def q_a05_selected(t: Tables) -> DataFrame:
    sectors = ("1-URGENT", "5-LOW")
    res = en.at_latest_month_of_year(marts.m_enrol(t), by=["sector"], where=F.col("sector").isin(*sectors),
                                     scope="global")
    return res.drop(en.MONTH)


@query("a13_skilled_migration_countries")
def q_a13_countries(t: Tables) -> DataFrame:
    return en.distinct_sorted(marts.m_skilled_cob(t), "country_name")


@query("p24_skilled_migration_by_country")
def q_p24_country(t: Tables) -> DataFrame:
    s = flt.where_equal(marts.m_skilled_cob(t), country_name="NATION_3")
    return s.select(
        X.fy_dash("financial_year").alias("financial_year"), "country_name", "anzsco_code", "occupation_name",
        "visa_subclass", "measure", "value",
    ).orderBy("financial_year")


@query("r13_message_cells_roundtrip")
def q_r13(t: Tables) -> DataFrame:
    from tidemark.sources.readers import hypercube_cells, with_envelope

    return hypercube_cells(with_envelope(marts.m_messages(t)))


# ---------------------------------------------------------------------------
# Scalars, quality checks and sinks over the landed tables


@query("x06_orders_by_month_text")
def q_x06(t: Tables) -> DataFrame:
    o = t.read("orders", "o_orderdate")
    return o.groupBy(X.date_text("o_orderdate", "yyyy-MM").alias("month"), X.date_text(F.to_date("o_orderdate")).alias("day")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("x12_x13_x22_part_texts")
def q_x12(t: Tables) -> DataFrame:
    p = t.read("part", "p_partkey", "p_name", "p_brand", "p_size")
    padded = F.when(F.col("p_size") > 3, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return p.select("p_partkey", X.title_part("p_brand", "#([0-9]{2})$").alias("two_digit_brand"), X.trim_keep_null(padded).alias("name"),
                    X.truncate_text("p_name", 5).alias("short_name"))


@query("x30_fill_rates")
def q_x30(t: Tables) -> DataFrame:
    c = marts.m_ceilings(t)
    rate = X.fill_rate("invitations_issued", F.col("ceiling") - 10)  # a single round leaves no ceiling: NULL
    return c.select("anzsco_code", "visa_subclass", "state", F.round(rate, 6).alias("fill_rate"))


@query("f17_allowed_links")
def q_f17(t: Tables) -> DataFrame:
    from tidemark.sources.readers import allowed_url

    p = t.read("pages", "page_id", "url", "html")
    hrefs = p.select("page_id", F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("base"),
                     F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'<a href="(/[A-Za-z0-9]+)"'), 1))).alias("href"))
    link = X.absolute_url("href", F.col("base"))
    host = F.regexp_extract("base", "^https?://(.+)$", 1)
    ok = allowed_url(link, host, "/d", "de")
    return hrefs.where(ok).select("page_id", link.alias("link"))


@query("a17_codes_listed_twice")
def q_a17(t: Tables) -> DataFrame:
    return qa.duplicate_rows_mask(marts.m_osl(t), ["anzsco_code", "state"]).select("anzsco_code", "state", "shortage_status", "source_row")


@query("g08_g18_counts_after_rerun")
def q_g08(t: Tables) -> DataFrame:
    o = t.read("orders", "o_orderpriority", "o_orderstatus")
    name = F.col("o_orderpriority").alias("table_name")
    before = o.where(F.col("o_orderstatus") != "P").groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    after = o.where(F.col("o_orderpriority") != "5-LOW").groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    return qa.count_delta(before, after, tolerance_pct=40.0)


@query("g13_columns_without_values")
def q_g13(t: Tables) -> DataFrame:
    osl = marts.m_osl(t).withColumn("assessor", F.when(F.col("source_row") < 0, F.col("occupation_name")))
    empty = marts.m_osl(t).limit(0)
    return qa.all_null_columns(osl, "osl").unionByName(qa.all_null_columns(empty, "none"))


@query("r05_profile_unpivot_all")
def q_r05(t: Tables) -> DataFrame:
    wide = marts.occupation_profile_wide(t)
    return reshape.unpivot_columns(wide, ["anzsco_code"], None, "field", "text")


def _order_batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders per (month, priority) in two releases; a low priority is not reported (NULL)."""
    o = t.read("orders", "o_orderdate", "o_orderpriority", "o_orderstatus")
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority")
    per = o.groupBy(X.date_text("o_orderdate", "yyyy-MM").alias("month"), priority)
    first = per.agg(F.count_if(F.col("o_orderstatus") == "F").alias("orders")).withColumn("note", F.lit("first"))
    return first.where(F.col("month") < "1997-01"), per.agg(F.count(F.lit(1)).alias("orders")).where(F.col("month") >= "1996-01")


def _upserts(t: Tables):
    """Two batches, the second one twice: results of the loads, and the root of the table."""
    from tidemark.operators.shape import add_lineage
    from tidemark.sources import sinks

    root = f"{checkpoint_dir(t.spark).rstrip('/')}/published/{uuid.uuid4().hex}"
    first, second = _order_batches(t)
    return [sinks.upsert(t.spark, add_lineage(b, "orders"), root, "orders_by_month", ["month", "priority"]) for b in (first, second, second)], root


@query("k01_upsert_with_null_keys")
def q_k01(t: Tables) -> DataFrame:
    from tidemark.sources import sinks

    _, root = _upserts(t)
    return sinks.read_table(t.spark, root, "orders_by_month").select("month", "priority", "orders", "note")


@query("k01_upsert_counts")
def q_k01_counts(t: Tables) -> DataFrame:
    results, _ = _upserts(t)
    return t.spark.createDataFrame([(i, r.inserted, r.updated, r.unchanged) for i, r in enumerate(results)],
                                   "load INT, inserted BIGINT, updated BIGINT, unchanged BIGINT")


@query("k02_k03_replace_row_then_append")
def q_k02(t: Tables) -> DataFrame:
    from tidemark.sources import sinks

    root = f"{checkpoint_dir(t.spark).rstrip('/')}/published/{uuid.uuid4().hex}"
    first, second = _order_batches(t)
    keys = ["month", "priority"]
    sinks.upsert(t.spark, first, root, "orders_by_month", keys)
    sinks.upsert(t.spark, second.where(F.col("month") < "1997-01"), root, "orders_by_month", keys, mode="replace_row")
    sinks.append_rows(t.spark, second.where(F.col("month") >= "1997-01").withColumn("note", F.lit("appended")).select(*keys, "orders", "note"),
                      root, "orders_by_month")
    return sinks.read_table(t.spark, root, "orders_by_month").select("month", "priority", "orders", "note")


# queries over files that the given tables are landed in, and over published tables
from tidemark.plans import housekeeping, landed, releases  # noqa: E402, F401

__all__ = ["QUERIES", "query"]
