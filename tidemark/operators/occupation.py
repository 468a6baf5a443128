"""Occupation marts: the shortage x vacancy x profile view and the invitation
mart (ceilings x shortage list x visa lists)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import annualise_weekly

# Fixed values of the view definition.
EARNINGS_DIMENSION = "median_full_time_earnings_per_week"
EMPLOYMENT_DIMENSION = "employed"
NUMERIC_TEXT = r"^[0-9]+(\.[0-9]+)?$"
NATIONAL_STATES = ("NATIONAL", "ALL", "", "NAN")
OSL_NATIONAL_STATES = ("", "National")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, keep: Sequence[str]) -> DataFrame:
    """For each key the row with the greatest ``order`` value.

    ``max_by`` inside a hash aggregate: combined map-side, so a hot key costs
    one partial row per task instead of a full sort of its group.
    """
    from tidemark.operators.windows import latest_per_group

    return latest_per_group(df.select(*keys, order, *keep), keys, [order]).select(*keys, order, *keep)


def occupation_view(
    shortage: DataFrame,
    vacancy: DataFrame,
    profile: DataFrame,
    code_prefix: int | None = None,
    vacancy_measure: str = "Seasonally Adjusted",
) -> DataFrame:
    """B08 (J04 + J05 + X16): each shortage row with its latest vacancy count at the
    chosen measure, annual salary from the weekly earnings profile (numeric text
    only) and the employment size.

    ``code_prefix=None`` joins codes exactly (the published definition, which
    finds nothing when the vacancy codes are coarser); ``code_prefix=n`` joins
    the first ``n`` characters of the shortage code to the vacancy code (J14).
    """
    vac = vacancy.where(F.col("measure") == F.lit(vacancy_measure)).select(
        F.coalesce(F.col("anzsco_code"), F.lit("")).alias("v_code"),
        F.col("state_code").alias("v_state"),
        "vacancy_period",
        "vacancy_count",
    )
    latest = latest_per_key(vac, ["v_code", "v_state"], "vacancy_period", ["vacancy_count"])
    code = F.col("anzsco_code") if code_prefix is None else F.substring("anzsco_code", 1, code_prefix)
    s = shortage.withColumn("__jcode", code)
    out = s.join(latest, (F.col("__jcode") == F.col("v_code")) & (F.col("state_code") == F.col("v_state")), "left")
    earn = profile.where(
        (F.col("dimension") == EARNINGS_DIMENSION) & F.col("value_text").rlike(NUMERIC_TEXT)
    ).select(F.col("anzsco_code").alias("e_code"), F.col("value_text").alias("e_text"))
    emp = profile.where(F.col("dimension") == EMPLOYMENT_DIMENSION).select(
        F.col("anzsco_code").alias("m_code"), F.col("value_text").alias("m_text")
    )
    out = out.join(earn, F.col("anzsco_code") == F.col("e_code"), "left")
    out = out.join(emp, F.col("anzsco_code") == F.col("m_code"), "left")
    return out.select(
        "anzsco_code",
        "occupation_name",
        "shortage_status",
        "osca_category",
        "assessment_year",
        "state_code",
        F.col("vacancy_count").alias("latest_vacancies"),
        F.col("vacancy_period").alias("vacancy_as_at"),
        annualise_weekly("e_text").alias("median_annual_salary_aud"),
        F.col("m_text").alias("employment_size"),
    )


def first_wins(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under an explicit order (deterministic
    replacement for drop_duplicates on an unordered frame)."""
    cols = [c for c in df.columns if c != key]
    packed = F.struct(*order, *[F.col(c).alias(f"__v_{c}") for c in cols])
    agg = df.groupBy(key).agg(F.min(packed).alias("__r"))
    return agg.select(key, *[F.col("__r")[f"__v_{c}"].alias(c) for c in cols])


def eligibility_flags(lists: DataFrame, subclasses: Sequence[str], exact_tokens: bool = False) -> DataFrame:
    """J11 + J12: per code, 1/0 flags ``eligible_<subclass>``.

    Literal containment (``'189' in '189, 190'``) is the published behaviour;
    ``exact_tokens=True`` splits the list text into tokens first.
    """
    text = F.coalesce(F.col("visa_subclass"), F.lit(""))
    aggs = []
    for s in subclasses:
        if exact_tokens:
            hit = F.array_contains(F.transform(F.split(text, ","), lambda x: F.trim(x)), F.lit(s))
        else:
            hit = text.contains(s)
        aggs.append(F.max(hit.cast("int")).alias(f"eligible_{s}"))
    return lists.groupBy("anzsco_code").agg(*aggs)


def occupation_mart(
    ceilings: DataFrame,
    osl: DataFrame,
    lists: DataFrame,
    data_month: str,
    subclasses: Sequence[str] = ("189", "190", "491"),
) -> DataFrame:
    """B07 (R10 + J10 + J11): one row per occupation code of the ceilings input; rows
    without a code are dropped.  Every input has ``source_row``, its row's position in
    the source: "first" and "last" go by it.

    Ceiling columns come from national rows only (F16), the last row per code
    and subclass winning; the name is the first row's; shortage fields from the
    first national shortage row; eligibility flags and list metadata from the
    visa lists.  Each input is aggregated once to one row per code (the name,
    the conditional pivot and the national filter share one aggregate), then
    the three per-code frames are joined on the code.
    """
    national = F.upper(F.trim(F.coalesce(F.col("state"), F.lit("")))).isin(*NATIONAL_STATES)
    measures = {
        "ceiling": "ceiling_{v}",
        "invitations_issued": "invitations_{v}",
        "fill_rate_pct": "fill_rate_{v}_pct",
        "trend": "trend_{v}",
    }
    aggs = [F.min_by("occupation_name", "source_row").alias("occupation_name")]
    for v in subclasses:
        hit = national & (F.col("visa_subclass") == F.lit(v))
        for src, pattern in measures.items():
            aggs.append(F.max_by(F.when(hit, F.col(src)), F.when(hit, F.col("source_row"))).alias(pattern.format(v=v)))
    fact = ceilings.where(F.col("anzsco_code").isNotNull() & (F.col("anzsco_code") != "")).groupBy("anzsco_code").agg(*aggs)
    osl_nat = osl.where(F.coalesce(F.col("state"), F.lit("")).isin(*OSL_NATIONAL_STATES))
    osl_first = first_wins(
        osl_nat.select("anzsco_code", "shortage_status", "shortage_level", "source_row"), "anzsco_code", [F.col("source_row")],
    ).drop("source_row")
    fact = fact.join(osl_first, "anzsco_code", "left").withColumn(
        "shortage_national", F.coalesce(F.col("shortage_status").contains("National").cast("int"), F.lit(0))
    )
    text = F.coalesce(F.col("visa_subclass"), F.lit(""))
    per_code = lists.groupBy("anzsco_code").agg(
        *[F.max(text.contains(s).cast("int")).alias(f"eligible_{s}") for s in subclasses],
        F.min(F.struct("source_row", "list_type", "assessing_body")).alias("__meta"),
    )
    fact = fact.join(per_code, "anzsco_code", "left")
    for s in subclasses:
        fact = fact.withColumn(f"eligible_{s}", F.coalesce(F.col(f"eligible_{s}"), F.lit(0)))
    return fact.select(
        "*", F.col("__meta.list_type").alias("list_type"), F.col("__meta.assessing_body").alias("assessing_body")
    ).drop("__meta").withColumn("data_month", F.lit(data_month))


def occupation_dimension(shortage: DataFrame, profile: DataFrame, vacancy: DataFrame) -> DataFrame:
    """U08 + P25: the occupation dimension as the union of distinct codes over the
    three sources; the name is the first non-null by source priority (shortage,
    then profile); hierarchy columns are code prefixes."""
    from tidemark.functions.scalars import code_level

    parts = [
        shortage.select("anzsco_code", F.col("anzsco_level").cast("int").alias("anzsco_level"),
                        "occupation_name", F.lit(1).alias("__prio")),
        profile.select("anzsco_code", F.lit(6).alias("anzsco_level"), "occupation_name",
                       F.lit(2).alias("__prio")).distinct(),
        vacancy.select("anzsco_code", F.col("anzsco_level").cast("int").alias("anzsco_level"),
                       F.lit(None).cast("string").alias("occupation_name"), F.lit(3).alias("__prio")).distinct(),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("anzsco_code").isNotNull())
    named = F.min(F.when(F.col("occupation_name").isNotNull(), F.struct("__prio", "occupation_name")))
    d = u.groupBy("anzsco_code", "anzsco_level").agg(named.alias("__n"))
    return d.select(
        "anzsco_code",
        "anzsco_level",
        F.col("__n.occupation_name").alias("occupation_name"),
        code_level("anzsco_code", 1).alias("major_group"),
        code_level("anzsco_code", 2).alias("sub_major_group"),
        code_level("anzsco_code", 3).alias("minor_group"),
        code_level("anzsco_code", 4).alias("unit_group"),
    )


def occupation_copy() -> Column:
    """Short marketing copy from the mart's flags and trend ('; '-joined,
    absent parts skipped)."""
    return F.concat_ws(
        "; ",
        F.when(F.col("shortage_national") == 1, F.lit("National shortage")),
        F.when(F.col("eligible_189") == 1, F.lit("Eligible for subclass 189")),
        F.when(F.col("eligible_190") == 1, F.lit("Eligible for subclass 190")),
        F.when(F.col("eligible_491") == 1, F.lit("Eligible for subclass 491")),
        F.concat(F.lit("Invitations trending "), F.col("trend_189")),
    )


def extract_lists(frames: dict[str, DataFrame], code_synonyms: Sequence[str] = ("anzsco", "anzsco_code", "code"),
                  subclass_synonyms: Sequence[str] = ("visa_subclasses", "visa_subclass")) -> DataFrame:
    """B09 (U01 + P07 + X01 + F07): occupation lists arriving as separate sheets
    with their own column spellings: names normalised, synonyms renamed to the
    target names, each tagged with its list type, unioned by name (missing
    columns NULL), and only six-digit occupation codes kept."""
    from tidemark.operators.shape import normalise_columns, rename_with_fallback

    parts = []
    for list_type, df in frames.items():
        d = rename_with_fallback(normalise_columns(df), {"anzsco_code": code_synonyms,
                                                        "visa_subclass": subclass_synonyms})
        parts.append(d.withColumn("list_type", F.lit(list_type)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    code = F.trim(F.col("anzsco_code").cast("string"))
    return out.withColumn("anzsco_code", code).where(F.coalesce(code.rlike(r"^\d{6}$"), F.lit(False)))
