"""Independent DuckDB SQL for every registered query.

The texts here are written against the landed tables directly (views named
after the parquet files) and do not reuse the Spark builders: marts are stated
as CTEs in plain SQL, often in a different but equivalent shape (for example the
YTD fact as an inequality join rather than a fan-out).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Mart CTEs.  Each is a complete `name AS (...)` item for a WITH list.

M_ENROL = """
monthly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         n_name AS nationality, o_orderpriority AS sector, c_mktsegment AS state_code,
         count(*) AS enr, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS com
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4, 5),
periods AS (SELECT DISTINCT y, m FROM monthly),
m_enrol AS (
  SELECT p.y AS enrol_year, p.m AS enrol_month, q.nationality, q.sector, q.state_code,
         CAST(sum(q.enr) AS BIGINT) AS ytd_enrolments,
         CAST(sum(q.com) AS BIGINT) AS ytd_commencements
  FROM periods p JOIN monthly q ON q.y = p.y AND q.m <= p.m
  GROUP BY 1, 2, 3, 4, 5)"""

LATEST = """
latest AS (
  SELECT max(enrol_year) AS ly,
         (SELECT max(enrol_month) FROM m_enrol
           WHERE enrol_year = (SELECT max(enrol_year) FROM m_enrol)) AS lm
  FROM m_enrol)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ---------------------------------------------------------------------------
# Enrolment snapshots

register("m_enrol", with_(M_ENROL) + "SELECT * FROM m_enrol")

register(
    "a06_latest_period",
    with_(M_ENROL, LATEST) + "SELECT ly AS enrol_year, lm AS enrol_month FROM latest",
)

register(
    "a04_yearly_snapshot_totals",
    with_(M_ENROL)
    + """
SELECT e.enrol_year, e.enrol_month,
       CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments,
       CAST(sum(e.ytd_commencements) AS BIGINT) AS total_commencements
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
GROUP BY e.enrol_year, e.enrol_month
ORDER BY e.enrol_year""",
)

register(
    "a04_yearly_snapshot_nationality_filtered",
    with_(M_ENROL)
    + """
SELECT e.enrol_year, e.enrol_month,
       CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments,
       CAST(sum(e.ytd_commencements) AS BIGINT) AS total_commencements
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol
      WHERE nationality = 'NATION_7' GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
WHERE e.nationality = 'NATION_7'
GROUP BY e.enrol_year, e.enrol_month""",
)

register(
    "a01_enrolment_by_country_at_latest",
    with_(M_ENROL, LATEST)
    + """
SELECT nationality, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol, latest WHERE enrol_year = ly AND enrol_month = lm
GROUP BY nationality ORDER BY total_enrolments DESC""",
)

register(
    "a01_enrolment_by_country_at",
    with_(M_ENROL)
    + """
SELECT nationality, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol WHERE enrol_year = 2000 AND enrol_month = 8
GROUP BY nationality""",
)

register(
    "a02_sector_breakdown_at",
    with_(M_ENROL)
    + """
SELECT sector, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol WHERE enrol_year = 1999 AND enrol_month = 6
GROUP BY sector""",
)

register(
    "a02_sector_breakdown_for_nationality",
    with_(M_ENROL)
    + """
SELECT sector, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol WHERE enrol_year = 1999 AND enrol_month = 6 AND nationality = 'NATION_3'
GROUP BY sector""",
)

register(
    "a03_country_sector_comparison",
    with_(M_ENROL)
    + """
SELECT nationality, sector, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol WHERE enrol_year = 2000 AND enrol_month = 12
  AND nationality IN ('NATION_1', 'NATION_4', 'NATION_9')
GROUP BY nationality, sector""",
)

register(
    "a05_sector_yearly_trend",
    with_(M_ENROL)
    + """
SELECT e.enrol_year, e.sector, CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
GROUP BY e.enrol_year, e.sector""",
)

register(
    "a05_country_yearly_trend",
    with_(M_ENROL)
    + """
SELECT e.nationality, e.enrol_year, CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
WHERE e.nationality IN ('NATION_2', 'NATION_11', 'NATION_20')
GROUP BY e.nationality, e.enrol_year""",
)

register(
    "j02_country_growth",
    with_(M_ENROL, LATEST)
    + """
SELECT cur.nationality, cur.total_enrolments AS current_total,
       CAST(COALESCE(prev.total_enrolments, 0) AS BIGINT) AS previous_total
FROM (SELECT nationality, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
      FROM m_enrol, latest WHERE enrol_year = ly AND enrol_month = lm GROUP BY nationality) cur
LEFT JOIN (SELECT nationality, sum(ytd_enrolments) AS total_enrolments
      FROM m_enrol, latest WHERE enrol_year = ly - 1 AND enrol_month = lm GROUP BY nationality) prev
  ON cur.nationality = prev.nationality""",
)

GROWTH = """
growth AS (
  SELECT cur.nationality, cur.t AS current_total, COALESCE(prev.t, 0) AS previous_total
  FROM (SELECT nationality, sum(ytd_enrolments) AS t FROM m_enrol, latest
        WHERE enrol_year = ly AND enrol_month = lm GROUP BY nationality) cur
  LEFT JOIN (SELECT nationality, sum(ytd_enrolments) AS t FROM m_enrol, latest
        WHERE enrol_year = ly - 1 AND enrol_month = lm GROUP BY nationality) prev
    ON cur.nationality = prev.nationality)"""

register(
    "w05_top_growth",
    with_(M_ENROL, LATEST, GROWTH)
    + """
SELECT nationality, CAST(current_total AS BIGINT) AS current_total,
       CAST(previous_total AS BIGINT) AS previous_total,
       round((current_total - previous_total) * 100.0 / previous_total, 6) AS growth_pct
FROM growth WHERE previous_total >= 40
ORDER BY growth_pct DESC NULLS LAST, nationality LIMIT 10""",
)

register(
    "w05_top_decline",
    with_(M_ENROL, LATEST, GROWTH)
    + """
SELECT nationality, CAST(current_total AS BIGINT) AS current_total,
       CAST(previous_total AS BIGINT) AS previous_total,
       round((current_total - previous_total) * 100.0 / previous_total, 6) AS growth_pct
FROM growth WHERE previous_total >= 40
ORDER BY growth_pct ASC NULLS LAST, nationality LIMIT 10""",
)

register(
    "b06_kpi_block",
    with_(M_ENROL, LATEST)
    + """
SELECT ly AS enrol_year, lm AS enrol_month,
       (SELECT CAST(sum(ytd_enrolments) AS BIGINT) FROM m_enrol WHERE enrol_year = ly AND enrol_month = lm)
         AS current_total,
       (SELECT CAST(sum(ytd_enrolments) AS BIGINT) FROM m_enrol WHERE enrol_year = ly - 1 AND enrol_month = lm)
         AS same_month_last_year,
       round(((SELECT sum(ytd_enrolments) FROM m_enrol WHERE enrol_year = ly AND enrol_month = lm)
              - (SELECT sum(ytd_enrolments) FROM m_enrol WHERE enrol_year = ly - 1 AND enrol_month = lm)) * 100.0
             / (SELECT sum(ytd_enrolments) FROM m_enrol WHERE enrol_year = ly - 1 AND enrol_month = lm), 6)
         AS yoy_pct
FROM latest""",
)

register(
    "a13_all_nationalities",
    with_(M_ENROL) + "SELECT DISTINCT nationality FROM m_enrol ORDER BY nationality",
)


# ---------------------------------------------------------------------------
# Macro series

M_FX = """
m_fx AS (
  SELECT CAST(ts AS DATE) AS rate_date, event_type AS series_id, value,
         CASE WHEN day(ts) % 2 = 0 THEN 'Daily' ELSE 'Monthly' END AS frequency
  FROM events)"""

M_LABOUR = """
m_labour AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS lf_period,
         'A84' || l_returnflag || l_linestatus AS series_id,
         (CASE l_returnflag WHEN 'A' THEN 'Employed total ;  Persons'
                            WHEN 'N' THEN 'Unemployment rate ;  Persons'
                            WHEN 'R' THEN 'Participation rate ;  Persons' END)
         || (CASE l_linestatus WHEN 'F' THEN ' ;  Trend' WHEN 'O' THEN ' ;  Seasonally Adjusted' END) AS measure,
         sum(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2, 3)"""

M_CPI = """
m_cpi AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) || '-Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS cpi_period,
         'CPI_' || l_returnflag AS series_id, avg(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2)"""

GEO_ORDERS = """
geo_orders AS (
  SELECT o.o_orderdate, o.o_orderstatus, c.c_mktsegment, n.n_name, r.r_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

M_POPULATION = """
m_population AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-06' AS erp_period, n_name AS country_name,
         c_mktsegment AS state_code, count(*) AS population
  FROM geo_orders GROUP BY 1, 2, 3
  UNION ALL
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-06', r_name, c_mktsegment, count(*)
  FROM geo_orders GROUP BY 1, 2, 3
  UNION ALL
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '-06', 'Total', c_mktsegment, count(*)
  FROM geo_orders GROUP BY 1, 2, 3)"""

M_NOM = """
nom_base AS (
  SELECT (year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END) AS fy0,
         c_mktsegment, n_name, o_orderstatus FROM geo_orders),
nom_wide AS (
  SELECT CAST(fy0 AS VARCHAR) || '-' || lpad(CAST((fy0 + 1) % 100 AS VARCHAR), 2, '0') AS nom_period,
         n_name AS country_name, c_mktsegment AS state_code,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS arrivals,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS departures
  FROM nom_base GROUP BY 1, 2, 3
  UNION ALL
  SELECT CAST(fy0 AS VARCHAR) || '-' || lpad(CAST((fy0 + 1) % 100 AS VARCHAR), 2, '0'),
         'Total', c_mktsegment,
         count(*) FILTER (WHERE o_orderstatus = 'O'), count(*) FILTER (WHERE o_orderstatus = 'F')
  FROM nom_base GROUP BY 1, 2, 3),
m_nom AS (
  SELECT nom_period, country_name, state_code, 'arrivals' AS direction, arrivals AS value FROM nom_wide
  UNION ALL SELECT nom_period, country_name, state_code, 'departures', departures FROM nom_wide
  UNION ALL SELECT nom_period, country_name, state_code, 'net', arrivals - departures FROM nom_wide)"""

ENROL_YEARLY = """
enrol_yearly AS (
  SELECT CAST(e.enrol_year AS VARCHAR) AS year, CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments
  FROM m_enrol e
  JOIN (SELECT enrol_year, max(enrol_month) AS lm FROM m_enrol GROUP BY 1) l
    ON e.enrol_year = l.enrol_year AND e.enrol_month = l.lm
  GROUP BY 1)"""

NOM_YEARLY = """
nom_yearly AS (
  SELECT left(nom_period, 4) AS year, CAST(sum(value) AS BIGINT) AS indicator_value
  FROM m_nom WHERE direction = 'net' AND country_name = 'Total' GROUP BY 1)"""

CPI_YEARLY = """
cpi_yearly AS (
  SELECT left(cpi_period, 4) AS year, avg(value) AS indicator_value
  FROM m_cpi WHERE series_id = 'CPI_N' GROUP BY 1)"""

register(
    "a07_yearly_exchange_rate",
    with_(M_FX)
    + """
SELECT CAST(year(rate_date) AS INTEGER) AS year, round(avg(value), 6) AS avg_rate
FROM m_fx WHERE series_id = 'purchase' GROUP BY 1 ORDER BY 1""",
)
register(
    "a07_yearly_exchange_rate_monthly_only",
    with_(M_FX)
    + """
SELECT CAST(year(rate_date) AS INTEGER) AS year, round(avg(value), 6) AS avg_rate
FROM m_fx WHERE series_id = 'click' AND frequency = 'Monthly' GROUP BY 1""",
)
register(
    "a08_yearly_cpi",
    with_(M_CPI)
    + "SELECT left(cpi_period, 4) AS year, round(avg(value), 6) AS avg_cpi FROM m_cpi "
    "WHERE series_id = 'CPI_N' GROUP BY 1 ORDER BY 1",
)
register(
    "a08_yearly_labour_force",
    with_(M_LABOUR)
    + "SELECT left(lf_period, 4) AS year, round(avg(value), 6) AS avg_value FROM m_labour "
    "WHERE measure = 'Unemployment rate ;  Persons ;  Seasonally Adjusted' GROUP BY 1",
)
register(
    "f05_labour_force_measures",
    with_(M_LABOUR)
    + """
SELECT DISTINCT measure FROM m_labour
WHERE measure LIKE 'Employed total%' OR measure LIKE 'Unemployed total%'
   OR measure LIKE 'Unemployment rate%' OR measure LIKE '%Participation rate%'
ORDER BY measure""",
)
register(
    "a09_yearly_population_total",
    with_(GEO_ORDERS, M_POPULATION)
    + "SELECT left(erp_period, 4) AS year, CAST(sum(population) AS BIGINT) AS total_population "
    "FROM m_population WHERE country_name = 'Total' GROUP BY 1",
)
register(
    "a09_yearly_population_member",
    with_(GEO_ORDERS, M_POPULATION)
    + "SELECT left(erp_period, 4) AS year, CAST(sum(population) AS BIGINT) AS total_population "
    "FROM m_population WHERE country_name = 'NATION_5' GROUP BY 1",
)
register(
    "a09_yearly_overseas_migration",
    with_(GEO_ORDERS, M_NOM)
    + "SELECT left(nom_period, 4) AS year, CAST(sum(value) AS BIGINT) AS total_value "
    "FROM m_nom WHERE direction = 'net' AND country_name = 'Total' GROUP BY 1",
)
register(
    "m_population",
    with_(GEO_ORDERS, M_POPULATION)
    + "SELECT erp_period, country_name, state_code, CAST(population AS BIGINT) AS population FROM m_population",
)
register(
    "j08_enrolment_vs_migration",
    with_(M_ENROL, ENROL_YEARLY, GEO_ORDERS, M_NOM, NOM_YEARLY)
    + "SELECT year, total_enrolments, indicator_value FROM enrol_yearly FULL OUTER JOIN nom_yearly USING (year)",
)
register(
    "u03_coverage_gaps",
    with_(M_ENROL, ENROL_YEARLY, GEO_ORDERS, M_NOM, NOM_YEARLY)
    + """
SELECT year, 'left' AS only_in FROM (SELECT year FROM enrol_yearly EXCEPT SELECT year FROM nom_yearly)
UNION ALL
SELECT year, 'right' FROM (SELECT year FROM nom_yearly EXCEPT SELECT year FROM enrol_yearly)""",
)
register(
    "j09_enrolment_vs_cpi",
    with_(M_ENROL, M_CPI, CPI_YEARLY)
    + """
SELECT e.year, e.total_enrolments, round(c.indicator_value, 6) AS indicator_value
FROM (SELECT CAST(enrol_year AS VARCHAR) AS year, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments
      FROM m_enrol WHERE enrol_month = 12 GROUP BY 1) e
JOIN cpi_yearly c ON e.year = c.year""",
)
register(
    "a21_enrolment_migration_correlation",
    with_(M_ENROL, ENROL_YEARLY, GEO_ORDERS, M_NOM, NOM_YEARLY)
    + """
SELECT count(*) AS n_pairs,
       CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
            THEN round(covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)), 6) END AS correlation
FROM (SELECT CAST(total_enrolments AS DOUBLE) AS x, CAST(indicator_value AS DOUBLE) AS y
      FROM enrol_yearly JOIN nom_yearly USING (year))""",
)
register(
    "b10_market_drivers",
    with_(M_ENROL, ENROL_YEARLY, M_CPI, CPI_YEARLY)
    + """
SELECT year, total_enrolments, round(indicator_value, 6) AS indicator_value
FROM enrol_yearly FULL OUTER JOIN cpi_yearly USING (year) ORDER BY year""",
)


# ---------------------------------------------------------------------------
# Scoring and rules

M_SKILLED_COB = """
m_skilled_cob AS (
  SELECT CAST(fy0 AS VARCHAR) || '_' || lpad(CAST((fy0 + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
         country_name, anzsco_code, 'Occupation ' || anzsco_code AS occupation_name, visa_subclass,
         'Grants' AS measure, CAST(count(*) AS DOUBLE) AS value
  FROM (SELECT year(l_shipdate) - CASE WHEN month(l_shipdate) < 7 THEN 1 ELSE 0 END AS fy0,
               CASE WHEN s_acctbal >= 0 THEN n_name END AS country_name,
               substr(printf('%06d', l_partkey), 1, 4) AS anzsco_code,
               CASE l_returnflag WHEN 'A' THEN '189' WHEN 'N' THEN '190' WHEN 'R' THEN '491' END AS visa_subclass
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey) s
  GROUP BY fy0, country_name, anzsco_code, visa_subclass)"""

SCORE_INPUTS = """
cur AS (SELECT nationality, sum(ytd_enrolments) AS v FROM m_enrol, latest
        WHERE enrol_year = ly AND enrol_month = lm GROUP BY 1),
prv AS (SELECT nationality, sum(ytd_enrolments) AS v FROM m_enrol, latest
        WHERE enrol_year = ly - 1 AND enrol_month = lm GROUP BY 1),
visa AS (SELECT country_name AS nationality, sum(value) AS visa_volume FROM m_skilled_cob
         WHERE country_name IS NOT NULL GROUP BY 1),
inputs AS (
  SELECT cur.nationality, CAST(cur.v AS BIGINT) AS current_volume,
         CASE WHEN prv.v <> 0 THEN (CAST(cur.v AS DOUBLE) - CAST(prv.v AS DOUBLE)) / CAST(prv.v AS DOUBLE) * 100.0
         END AS growth_pct,
         CAST(visa.visa_volume AS DOUBLE) AS visa_volume
  FROM cur LEFT JOIN prv ON cur.nationality = prv.nationality
           LEFT JOIN visa ON cur.nationality = visa.nationality)"""


def pandas_pct_rank(col: str) -> str:
    """Average-tie percentile rank over non-null values, times 100."""
    return (
        f"CASE WHEN {col} IS NOT NULL THEN (rank() OVER (ORDER BY {col} ASC NULLS LAST) "
        f"+ (count(*) OVER (PARTITION BY {col}) - 1) / 2.0) / count({col}) OVER () * 100.0 END"
    )


SCORES = f"""
ranked AS (
  SELECT *, {pandas_pct_rank('growth_pct')} AS gs, {pandas_pct_rank('current_volume')} AS ms,
         {pandas_pct_rank('visa_volume')} AS vs
  FROM inputs),
scored AS (
  SELECT *,
         0.0 + CASE WHEN gs IS NOT NULL THEN 0.4 ELSE 0.0 END + CASE WHEN ms IS NOT NULL THEN 0.35 ELSE 0.0 END
             + CASE WHEN vs IS NOT NULL THEN 0.25 ELSE 0.0 END AS tw,
         0.0 + coalesce(gs * 0.4, 0.0) + coalesce(ms * 0.35, 0.0) + coalesce(vs * 0.25, 0.0) AS wsum,
         (CASE WHEN gs IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN ms IS NOT NULL THEN 1 ELSE 0 END
          + CASE WHEN vs IS NOT NULL THEN 1 ELSE 0 END) AS np
  FROM ranked)"""

register(
    "b01_opportunity_score_inputs",
    with_(M_ENROL, LATEST, M_SKILLED_COB, SCORE_INPUTS)
    + "SELECT nationality, current_volume, round(growth_pct, 6) AS growth_pct, visa_volume FROM inputs",
)

register(
    "b02_opportunity_scores",
    with_(M_ENROL, LATEST, M_SKILLED_COB, SCORE_INPUTS, SCORES)
    + """
SELECT nationality, round(gs, 6) AS growth_score, round(ms, 6) AS market_size_score, round(vs, 6) AS visa_score,
       CASE WHEN tw > 0 THEN round_even(wsum / tw, 1) END AS opportunity_score,
       round(np / 3.0 * 100.0, 1) AS data_confidence_pct,
       concat_ws(';',
         CASE WHEN gs IS NOT NULL THEN 'growth=' || printf('%.3f', round(0.4 / tw, 3)) END,
         CASE WHEN ms IS NOT NULL THEN 'market_size=' || printf('%.3f', round(0.35 / tw, 3)) END,
         CASE WHEN vs IS NOT NULL THEN 'visa_pathway=' || printf('%.3f', round(0.25 / tw, 3)) END) AS weights_used
FROM scored""",
)

register(
    "w01_percentile_rank_growth",
    with_(M_ENROL, LATEST, GROWTH)
    + f"""
SELECT nationality, CAST(previous_total AS BIGINT) AS previous_total,
       round({pandas_pct_rank('previous_total')}, 6) AS prev_rank
FROM growth""",
)

register(
    "a22_median_current_volume",
    with_(M_ENROL, LATEST, M_SKILLED_COB, SCORE_INPUTS)
    + "SELECT round(median(current_volume), 6) AS median_volume FROM inputs",
)

REC = """
CASE WHEN growth_pct IS NULL OR current_volume IS NULL OR med IS NULL THEN
       'Insufficient historical data for a rule-based recommendation '
       || '(requires at least two comparable years of enrolment data).'
     WHEN growth_pct >= 10.0 AND current_volume >= med THEN
       'Strong growth (+' || printf('%.1f', growth_pct) || '% YoY) in an already large market -- '
       || 'prioritize marketing investment and course capacity.'
     WHEN growth_pct >= 10.0 AND current_volume < med THEN
       'Strong growth (+' || printf('%.1f', growth_pct) || '% YoY) in an emerging market -- '
       || 'consider early investment ahead of scale.'
     WHEN growth_pct <= -10.0 THEN
       'Declining market (' || printf('%.1f', growth_pct) || '% YoY) -- monitor closely and '
       || 'investigate cause before increasing investment.'
     ELSE 'Stable market (' || printf('%+.1f', growth_pct) || '% YoY) -- maintain current marketing effort.'
END"""

register(
    "b03_marketing_recommendation",
    with_(M_ENROL, LATEST, M_SKILLED_COB, SCORE_INPUTS)
    + f"""
SELECT nationality, round(growth_pct, 6) AS growth_pct, current_volume, round(med, 6) AS median_volume,
       {REC} AS recommendation
FROM inputs, (SELECT median(current_volume) AS med FROM inputs) m""",
)

register(
    "b04_sector_yoy",
    with_(M_ENROL, LATEST)
    + """
SELECT sector, CAST(current_total AS BIGINT) AS current_total, CAST(previous_total AS BIGINT) AS previous_total,
       round(CASE WHEN previous_total <> 0 THEN (CAST(current_total AS DOUBLE) - CAST(previous_total AS DOUBLE))
                  / CAST(previous_total AS DOUBLE) * 100.0 END, 6) AS yoy_pct
FROM (SELECT coalesce(c.sector, p.sector) AS sector, coalesce(c.t, 0) AS current_total,
             coalesce(p.t, 0) AS previous_total
      FROM (SELECT sector, sum(ytd_enrolments) AS t FROM m_enrol, latest
            WHERE enrol_year = ly AND enrol_month = lm GROUP BY 1) c
      FULL OUTER JOIN (SELECT sector, sum(ytd_enrolments) AS t FROM m_enrol, latest
            WHERE enrol_year = ly - 1 AND enrol_month = lm GROUP BY 1) p ON c.sector = p.sector) x""",
)

register(
    "x20_formatted_kpis",
    with_(M_ENROL, LATEST)
    + """
SELECT CAST(ly AS VARCHAR) || '-' || lpad(CAST(lm AS VARCHAR), 2, '0') AS period,
       format('{:,}', cur) AS current_text, format('{:,}', prv) AS prior_text,
       CASE WHEN pct > 0 THEN '+' ELSE '' END || format('{:,.1f}', pct) || '%' AS yoy_text,
       round(CASE WHEN prv <> 0 THEN CAST(cur AS DOUBLE) / CAST(prv AS DOUBLE) END, 6) AS ratio
FROM (SELECT ly, lm, cur, prv, round((CAST(cur AS DOUBLE) - CAST(prv AS DOUBLE)) / CAST(prv AS DOUBLE) * 100.0, 6) AS pct
      FROM (SELECT ly, lm,
              (SELECT sum(ytd_enrolments) FROM m_enrol WHERE enrol_year = ly AND enrol_month = lm) AS cur,
              (SELECT sum(ytd_enrolments) FROM m_enrol WHERE enrol_year = ly - 1 AND enrol_month = lm) AS prv
            FROM latest) a) b""",
)


# ---------------------------------------------------------------------------
# Occupation marts

M_SHORTAGE = """
m_shortage AS (
  SELECT printf('%06d', p_partkey) AS anzsco_code, 6 AS anzsco_level, p_name AS occupation_name,
         CASE WHEN p_size <= 15 THEN 'Shortage' WHEN p_size <= 35 THEN 'No Shortage'
              ELSE 'Regional Shortage' END AS shortage_status,
         p_type AS osca_category, CASE WHEN p_size % 10 <> 0 THEN '2025' END AS assessment_year,
         'AUS' AS state_code
  FROM part)"""

M_VACANCY = """
m_vacancy AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS vacancy_period, substr(printf('%06d', l_partkey), 1, 4) AS anzsco_code,
         4 AS anzsco_level, 'AUS' AS state_code,
         CASE WHEN l_linestatus = 'O' THEN 'Seasonally Adjusted' ELSE 'Trend' END AS measure,
         count(*) AS vacancy_count
  FROM lineitem GROUP BY ALL)"""

M_PROFILE = """
prof_wide AS (
  SELECT printf('%06d', p_partkey) AS anzsco_code, p_name AS occupation_name,
         CASE WHEN p_size > 45 THEN 'np' ELSE printf('%.2f', p_retailprice) END AS e,
         CAST(p_size * 100 AS VARCHAR) AS m, p_brand AS s
  FROM part),
m_profile AS (
  SELECT anzsco_code, occupation_name, 'Earnings' AS profile_measure,
         'median_full_time_earnings_per_week' AS dimension, TRY_CAST(trim(e) AS DOUBLE) AS value_num,
         e AS value_text, '2025' AS profile_year FROM prof_wide
  UNION ALL
  SELECT anzsco_code, occupation_name, 'Employment', 'employed', TRY_CAST(trim(m) AS DOUBLE), m, '2025'
  FROM prof_wide
  UNION ALL
  SELECT anzsco_code, occupation_name, 'Education', 'skill_level', TRY_CAST(trim(s) AS DOUBLE), s, '2025'
  FROM prof_wide)"""

M_CEILINGS = """
m_ceilings AS (
  SELECT anzsco_code, 'Occupation ' || anzsco_code AS occupation_name, visa_subclass, state, ceiling,
         invitations_issued, round(invitations_issued / ceiling * 100, 4) AS fill_rate_pct,
         CASE WHEN invitations_issued * 20 > ceiling THEN 'UP' ELSE 'DOWN' END AS trend, source_row
  FROM (SELECT printf('%06d', l_partkey) AS anzsco_code,
               CASE l_linenumber % 3 WHEN 0 THEN '189' WHEN 1 THEN '190' ELSE '491' END AS visa_subclass,
               CASE WHEN l_returnflag = 'R' THEN 'VIC' WHEN l_linestatus = 'O' THEN 'NATIONAL'
                    ELSE 'ALL' END AS state,
               count(*) * 10 AS ceiling, count(*) FILTER (WHERE l_discount < 0.05) AS invitations_issued,
               min(l_orderkey) AS source_row
        FROM lineitem GROUP BY 1, 2, 3) g)"""

M_OSL = """
m_osl AS (
  SELECT printf('%06d', p_partkey) AS anzsco_code, p_name AS occupation_name,
         CASE WHEN nth = 0 THEN first_status WHEN first_status = 'National Shortage' THEN 'Shortage'
              ELSE 'National Shortage' END AS shortage_status,
         p_type AS shortage_level, CASE WHEN p_type = 'PROMO' THEN 'NSW' ELSE 'National' END AS state,
         2 * p_partkey + CASE WHEN p_partkey % 8 = 0 THEN 1 - nth ELSE nth END AS source_row
  FROM (SELECT *, CASE WHEN p_size <= 15 THEN 'National Shortage' WHEN p_size <= 35 THEN 'No Shortage'
                       ELSE 'Regional Shortage' END AS first_status FROM part) p
  JOIN (VALUES (0), (1)) AS n(nth) ON nth = 0 OR p_partkey % 4 = 0)"""

M_VISA_LISTS = """
m_visa_lists AS (
  SELECT printf('%06d', p_partkey) AS anzsco_code, p_name AS occupation_name, list_type, p_brand AS assessing_body,
         CASE list_type WHEN 'MLTSSL' THEN '189, 190, 491' WHEN 'STSOL' THEN '190, 491' ELSE '491' END AS visa_subclass,
         2 * p_partkey - nth AS source_row
  FROM (SELECT *, CASE WHEN nth = 1 THEN 'ROL' WHEN p_size <= 10 THEN 'MLTSSL' WHEN p_size <= 25 THEN 'STSOL'
                       ELSE 'ROL' END AS list_type
        FROM part JOIN (VALUES (0), (1)) AS n(nth) ON nth = 0 OR p_partkey % 5 = 0 WHERE p_size <= 40) p)"""


def _view_sql(prefix: str) -> str:
    join_code = "os.anzsco_code" if prefix == "" else f"left(os.anzsco_code, {prefix})"
    return f"""
SELECT os.anzsco_code, os.occupation_name, os.shortage_status, os.osca_category, os.assessment_year,
       os.state_code, vac.vacancy_count AS latest_vacancies, vac.vacancy_period AS vacancy_as_at,
       CAST(TRY_CAST(pe.value_text AS DECIMAL(14,2)) * 52 AS DOUBLE) AS median_annual_salary_aud,
       pm.value_text AS employment_size
FROM m_shortage os
LEFT JOIN m_vacancy vac
  ON coalesce(vac.anzsco_code, '') = {join_code} AND vac.state_code = os.state_code
 AND vac.measure = 'Seasonally Adjusted'
 AND vac.vacancy_period = (SELECT max(v2.vacancy_period) FROM m_vacancy v2
                           WHERE coalesce(v2.anzsco_code, '') = {join_code}
                             AND v2.state_code = os.state_code AND v2.measure = 'Seasonally Adjusted')
LEFT JOIN m_profile pe ON pe.anzsco_code = os.anzsco_code
 AND pe.dimension = 'median_full_time_earnings_per_week'
 AND regexp_matches(pe.value_text, '^[0-9]+(\\.[0-9]+)?$')
LEFT JOIN m_profile pm ON pm.anzsco_code = os.anzsco_code AND pm.dimension = 'employed'"""


register("b08_occupation_view_exact", with_(M_SHORTAGE, M_VACANCY, M_PROFILE) + _view_sql(""))
register("b08_occupation_view", with_(M_SHORTAGE, M_VACANCY, M_PROFILE) + _view_sql("4"))

register(
    "w02_latest_vacancy_per_code",
    with_(M_VACANCY)
    + """
SELECT anzsco_code, state_code, vacancy_period, vacancy_count FROM m_vacancy v
WHERE measure = 'Seasonally Adjusted'
  AND vacancy_period = (SELECT max(vacancy_period) FROM m_vacancy w
                        WHERE w.anzsco_code = v.anzsco_code AND w.state_code = v.state_code
                          AND w.measure = 'Seasonally Adjusted')""",
)

register("r04_occupation_profile_eav", with_(M_PROFILE) + "SELECT * FROM m_profile")

register(
    "r11_profile_to_columns",
    with_(M_PROFILE)
    + """
SELECT anzsco_code,
       max(CASE WHEN dimension = 'median_full_time_earnings_per_week' THEN value_text END)
         AS median_full_time_earnings_per_week,
       max(CASE WHEN dimension = 'employed' THEN value_text END) AS employed
FROM m_profile GROUP BY anzsco_code""",
)


def _pivot_cols(measures: dict[str, str]) -> str:
    cols = []
    for v in ("189", "190", "491"):
        for src, pat in measures.items():
            cols.append(f"arg_max({src}, source_row) FILTER (WHERE visa_subclass = '{v}') AS {pat.format(v=v)}")
    return ",\n       ".join(cols)


NAT_CEILINGS = """
nat AS (SELECT * FROM m_ceilings WHERE upper(trim(coalesce(state, ''))) IN ('NATIONAL', 'ALL', '', 'NAN'))"""

register(
    "r10_ceiling_pivot",
    with_(M_CEILINGS, NAT_CEILINGS)
    + "SELECT anzsco_code,\n       "
    + _pivot_cols({"ceiling": "ceiling_{v}", "invitations_issued": "invitations_{v}"})
    + "\nFROM nat GROUP BY anzsco_code",
)

register(
    "b07_occupation_mart",
    with_(M_CEILINGS, NAT_CEILINGS, M_SHORTAGE, M_OSL, M_VISA_LISTS)
    + """,
names AS (SELECT anzsco_code, arg_min(occupation_name, source_row) AS occupation_name
          FROM m_ceilings GROUP BY anzsco_code),
wide AS (SELECT anzsco_code,
       """
    + _pivot_cols(
        {
            "ceiling": "ceiling_{v}",
            "invitations_issued": "invitations_{v}",
            "fill_rate_pct": "fill_rate_{v}_pct",
            "trend": "trend_{v}",
        }
    )
    + """
         FROM nat GROUP BY anzsco_code),
osl1 AS (SELECT anzsco_code, shortage_status, shortage_level FROM (
           SELECT *, row_number() OVER (PARTITION BY anzsco_code ORDER BY source_row) AS rn
           FROM m_osl WHERE coalesce(state, '') IN ('', 'National')) x WHERE rn = 1),
flags AS (SELECT anzsco_code,
                 max(CAST(contains(coalesce(visa_subclass, ''), '189') AS INTEGER)) AS e189,
                 max(CAST(contains(coalesce(visa_subclass, ''), '190') AS INTEGER)) AS e190,
                 max(CAST(contains(coalesce(visa_subclass, ''), '491') AS INTEGER)) AS e491
          FROM m_visa_lists GROUP BY anzsco_code),
meta AS (SELECT anzsco_code, list_type, assessing_body FROM (
           SELECT *, row_number() OVER (PARTITION BY anzsco_code ORDER BY source_row) AS rn
           FROM m_visa_lists) y WHERE rn = 1)
SELECT n.anzsco_code, n.occupation_name, w.* EXCLUDE (anzsco_code),
       o.shortage_status, o.shortage_level,
       coalesce(CAST(contains(o.shortage_status, 'National') AS INTEGER), 0) AS shortage_national,
       coalesce(f.e189, 0) AS eligible_189, coalesce(f.e190, 0) AS eligible_190, coalesce(f.e491, 0) AS eligible_491,
       m.list_type, m.assessing_body, '2025-06' AS data_month
FROM names n LEFT JOIN wide w ON n.anzsco_code = w.anzsco_code
LEFT JOIN osl1 o ON n.anzsco_code = o.anzsco_code
LEFT JOIN flags f ON n.anzsco_code = f.anzsco_code
LEFT JOIN meta m ON n.anzsco_code = m.anzsco_code""",
)

register(
    "j11_eligibility_exact_tokens",
    with_(M_VISA_LISTS)
    + """
SELECT anzsco_code,
  max(CAST(list_contains(string_split(replace(coalesce(visa_subclass, ''), ' ', ''), ','), '189')
      AS INTEGER)) AS eligible_189,
  max(CAST(list_contains(string_split(replace(coalesce(visa_subclass, ''), ' ', ''), ','), '190')
      AS INTEGER)) AS eligible_190,
  max(CAST(list_contains(string_split(replace(coalesce(visa_subclass, ''), ' ', ''), ','), '491')
      AS INTEGER)) AS eligible_491
FROM m_visa_lists GROUP BY anzsco_code""",
)

register(
    "u08_occupation_dimension",
    with_(M_SHORTAGE, M_VACANCY, M_PROFILE)
    + """
SELECT anzsco_code, anzsco_level,
       arg_min(occupation_name, prio) FILTER (WHERE occupation_name IS NOT NULL) AS occupation_name,
       substr(anzsco_code, 1, 1) AS major_group, substr(anzsco_code, 1, 2) AS sub_major_group,
       substr(anzsco_code, 1, 3) AS minor_group, substr(anzsco_code, 1, 4) AS unit_group
FROM (SELECT anzsco_code, anzsco_level, occupation_name, 1 AS prio FROM m_shortage
      UNION ALL SELECT DISTINCT anzsco_code, 6, occupation_name, 2 FROM m_profile
      UNION ALL SELECT DISTINCT anzsco_code, anzsco_level, NULL, 3 FROM m_vacancy) u
WHERE anzsco_code IS NOT NULL
GROUP BY anzsco_code, anzsco_level""",
)


# ---------------------------------------------------------------------------
# Provider landscape and aliases

M_PROVIDER = """
m_provider AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS provider_id, s_name AS provider_name,
         CASE WHEN s_acctbal >= 0 THEN CASE n_regionkey WHEN 0 THEN 'NSW' WHEN 1 THEN 'VIC' WHEN 2 THEN 'QLD'
                                                        WHEN 3 THEN 'SA' WHEN 4 THEN 'WA' END END AS state_code,
         CASE WHEN s_acctbal > 5000 THEN 'University' ELSE 'Private' END AS provider_type
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

M_COURSE = """
m_course AS (
  SELECT printf('%06d', p_partkey) || 'K' AS cricos_code, p_name AS course_name,
         CAST(f.supp AS VARCHAR) AS provider_id, p_type AS course_level, p_size AS duration_weeks,
         p_retailprice AS tuition_fee
  FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS supp FROM lineitem GROUP BY 1) f
    ON p_partkey = f.l_partkey)"""

LOC_ID = "substr(md5(upper(trim(coalesce({p}, ''))) || '|' || lower(trim(coalesce({n}, '')))), 1, 16)"

M_LOCATION = f"""
campus AS (
  SELECT l_partkey, CAST(l_suppkey AS VARCHAR) AS provider_id,
         'Campus ' || CAST(year(l_shipdate) AS VARCHAR) AS location_name
  FROM lineitem),
m_location AS (
  SELECT {LOC_ID.format(p='l.provider_id', n='l.location_name')} AS location_id, l.provider_id, l.location_name,
         p.state_code
  FROM (SELECT DISTINCT provider_id, location_name FROM campus) l
  LEFT JOIN m_provider p ON l.provider_id = p.provider_id),
m_bridge AS (
  SELECT DISTINCT printf('%06d', l_partkey) || 'K' AS cricos_code,
         {LOC_ID.format(p='provider_id', n='location_name')} AS location_id, provider_id
  FROM campus)"""

M_ALIAS = """
m_alias AS (
  SELECT n_name AS canonical_name, 'N' || CAST(n_nationkey AS VARCHAR) AS iso_alpha2,
         'NA' || CAST(n_nationkey AS VARCHAR) AS iso_alpha3, n_name AS name_education,
         upper(replace(n_name, '_', ' ')) AS name_home_affairs,
         upper(substr(replace(n_name, '_', ' '), 1, 1)) || lower(substr(replace(n_name, '_', ' '), 2)) AS name_abs,
         CASE WHEN r_name <> 'MIDDLE EAST' THEN lower(n_name) END AS name_skilled_mig, r_name AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
alias_long AS (
  SELECT DISTINCT * FROM (
    SELECT 'education' AS source, name_education AS alias, canonical_name FROM m_alias
    UNION ALL SELECT 'home_affairs', name_home_affairs, canonical_name FROM m_alias
    UNION ALL SELECT 'abs', name_abs, canonical_name FROM m_alias
    UNION ALL SELECT 'skilled_mig', name_skilled_mig, canonical_name FROM m_alias) x
  WHERE alias IS NOT NULL)"""

COURSES_BY_STATE = """
cbs AS (SELECT p.state_code, count(*) AS course_count FROM m_course c
        JOIN m_provider p ON c.provider_id = p.provider_id WHERE p.state_code IS NOT NULL GROUP BY 1),
pbs AS (SELECT state_code, count(*) AS provider_count FROM m_provider WHERE state_code IS NOT NULL GROUP BY 1),
dens AS (SELECT coalesce(pbs.state_code, cbs.state_code) AS state_code,
                coalesce(provider_count, 0) AS provider_count, coalesce(course_count, 0) AS course_count,
                CASE WHEN coalesce(provider_count, 0) <> 0
                     THEN CAST(coalesce(course_count, 0) AS DOUBLE) / CAST(provider_count AS DOUBLE) END
                  AS courses_per_provider
         FROM pbs FULL OUTER JOIN cbs ON pbs.state_code = cbs.state_code)"""

register(
    "a10_providers_by_state",
    with_(M_PROVIDER)
    + "SELECT state_code, count(*) AS provider_count FROM m_provider WHERE state_code IS NOT NULL "
    "GROUP BY 1 ORDER BY 2 DESC",
)
register(
    "a10_locations_by_state",
    with_(M_PROVIDER, M_LOCATION)
    + "SELECT state_code, count(*) AS location_count FROM m_location WHERE state_code IS NOT NULL "
    "GROUP BY 1 ORDER BY 2 DESC",
)
register("a11_provider_count", with_(M_PROVIDER) + "SELECT count(*) AS n FROM m_provider")
register("j03_courses_by_state", with_(M_PROVIDER, M_COURSE, COURSES_BY_STATE) + "SELECT * FROM cbs")
register(
    "t02_courses_by_provider_top",
    with_(M_PROVIDER, M_COURSE)
    + """
SELECT p.provider_name, p.state_code, count(*) AS course_count
FROM m_course c JOIN m_provider p ON c.provider_id = p.provider_id
GROUP BY p.provider_name, p.state_code
ORDER BY course_count DESC, provider_name, state_code NULLS LAST LIMIT 20""",
)
register(
    "j15_orphan_courses",
    with_(M_PROVIDER, M_COURSE)
    + """
SELECT c.cricos_code, c.provider_id FROM m_course c LEFT JOIN m_provider p ON c.provider_id = p.provider_id
WHERE p.provider_id IS NULL""",
)
register(
    "j15_orphan_bridge_rows",
    with_(M_PROVIDER, M_COURSE, M_LOCATION)
    + """
SELECT count(*) AS orphan_rows FROM m_bridge b LEFT JOIN m_course c ON b.cricos_code = c.cricos_code
WHERE c.cricos_code IS NULL""",
)
register(
    "j16_courses_unknown_provider",
    with_(M_PROVIDER, M_COURSE)
    + "SELECT cricos_code, provider_id FROM m_course WHERE provider_id NOT IN (SELECT provider_id FROM m_provider)",
)
register(
    "j17_course_locations",
    with_(M_PROVIDER, M_COURSE, M_LOCATION)
    + """
SELECT l.location_id, c.cricos_code, c.course_name, l.location_name, l.state_code AS location_state
FROM m_course c JOIN m_bridge b ON c.cricos_code = b.cricos_code JOIN m_location l ON b.location_id = l.location_id""",
)
register(
    "b05_competition_density",
    with_(M_PROVIDER, M_COURSE, COURSES_BY_STATE)
    + "SELECT state_code, provider_count, course_count, round(courses_per_provider, 6) AS courses_per_provider "
    "FROM dens",
)
register(
    "t08_competition_extremes",
    with_(M_PROVIDER, M_COURSE, COURSES_BY_STATE)
    + """
SELECT (SELECT state_code FROM dens WHERE courses_per_provider IS NOT NULL
        ORDER BY courses_per_provider DESC, state_code DESC LIMIT 1) AS highest_competition_state,
       (SELECT round(max(courses_per_provider), 6) FROM dens) AS highest_courses_per_provider,
       (SELECT state_code FROM dens WHERE courses_per_provider IS NOT NULL
        ORDER BY courses_per_provider ASC, state_code ASC LIMIT 1) AS lowest_competition_state,
       (SELECT round(min(courses_per_provider), 6) FROM dens) AS lowest_courses_per_provider""",
)
register("p21_location_ids", with_(M_PROVIDER, M_LOCATION) + "SELECT * FROM m_location")
register(
    "j19_provider_state_names",
    with_(M_PROVIDER)
    + """,
dim_state AS (SELECT * FROM (VALUES ('NSW', 'New South Wales'), ('VIC', 'Victoria'), ('QLD', 'Queensland'),
  ('SA', 'South Australia'), ('WA', 'Western Australia'), ('TAS', 'Tasmania'),
  ('ACT', 'Australian Capital Territory'), ('NT', 'Northern Territory'), ('AUS', 'Australia (National)'))
  t(state_code, state_name))
SELECT p.state_code, s.state_name, count(*) AS provider_count
FROM m_provider p LEFT JOIN dim_state s ON p.state_code = s.state_code GROUP BY 1, 2""",
)
register(
    "j19_enrolment_by_region",
    with_(M_ENROL, LATEST, M_ALIAS)
    + """
SELECT a.region, CAST(sum(s.t) AS BIGINT) AS total_enrolments
FROM (SELECT nationality, sum(ytd_enrolments) AS t FROM m_enrol, latest
      WHERE enrol_year = ly AND enrol_month = lm GROUP BY 1) s
LEFT JOIN m_alias a ON s.nationality = a.canonical_name GROUP BY 1""",
)
register(
    "j13_canonical_country_names",
    with_(M_SKILLED_COB, M_ALIAS)
    + """
SELECT n.source_name, a.canonical_name
FROM (SELECT DISTINCT lower(country_name) AS source_name FROM m_skilled_cob) n
LEFT JOIN alias_long a ON a.source = 'skilled_mig' AND n.source_name = a.alias""",
)
register(
    "u07_unmapped_country_names",
    with_(M_ENROL, GEO_ORDERS, M_POPULATION, M_SKILLED_COB, M_ALIAS)
    + """
SELECT DISTINCT source, name FROM (
  SELECT 'education' AS source, nationality AS name FROM m_enrol
  UNION ALL SELECT 'abs', country_name FROM m_population
  UNION ALL SELECT 'skilled_mig', lower(country_name) FROM m_skilled_cob) u
WHERE name IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM alias_long a WHERE a.source = u.source AND a.alias = u.name)""",
)


# ---------------------------------------------------------------------------
# Quality (A16, A24, G01-G14) and windows

M_ENROL_DETAILED = """
dmonthly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         n_name AS nationality, o_orderpriority AS sector, c_mktsegment AS state_code,
         p_type AS field_of_education, l_returnflag AS level_of_study,
         count(*) AS enr, count(*) FILTER (WHERE l_linestatus = 'F') AS com
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
dperiods AS (SELECT DISTINCT y, m FROM dmonthly),
m_enrol_detailed AS (
  SELECT p.y AS enrol_year, p.m AS enrol_month, q.nationality, q.sector, q.state_code, q.field_of_education,
         q.level_of_study, CAST(sum(q.enr) AS BIGINT) AS ytd_enrolments,
         CAST(sum(q.com) AS BIGINT) AS ytd_commencements, CAST(sum(q.enr) AS BIGINT) AS total
  FROM dperiods p JOIN dmonthly q ON q.y = p.y AND q.m <= p.m
  GROUP BY 1, 2, 3, 4, 5, 6, 7)"""

BASIC = "enrol_year, enrol_month, nationality, sector, state_code"
DETAILED = BASIC + ", field_of_education, level_of_study"

register(
    "g09_grain_guard",
    with_(M_ENROL_DETAILED)
    + f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS colliding_rows,
       round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n) * 100, 6) AS colliding_pct,
       (SELECT count(*) = 0 FROM (SELECT {DETAILED} FROM m_enrol_detailed GROUP BY ALL HAVING count(*) > 1) d)
         AS wide_key_unique
FROM (SELECT {BASIC}, count(*) AS n FROM m_enrol_detailed GROUP BY ALL) g""",
)
register(
    "g10_redundant_total_column",
    with_(M_ENROL_DETAILED)
    + """
SELECT count(*) FILTER (WHERE total IS NOT DISTINCT FROM ytd_enrolments) AS same, count(*) AS rows,
       round(count(*) FILTER (WHERE total IS NOT DISTINCT FROM ytd_enrolments) / count(*) * 100, 6) AS same_pct
FROM m_enrol_detailed""",
)
register(
    "a16_duplicate_basic_keys_in_detailed",
    with_(M_ENROL_DETAILED)
    + f"SELECT {BASIC}, count(*) AS n FROM m_enrol_detailed GROUP BY ALL HAVING count(*) > 1",
)
register(
    "a24_nulls_per_column",
    with_(M_SHORTAGE)
    + """
SELECT column_name, nulls FROM (
  SELECT 'anzsco_code' AS column_name, count(*) FILTER (WHERE anzsco_code IS NULL) AS nulls FROM m_shortage
  UNION ALL SELECT 'anzsco_level', count(*) FILTER (WHERE anzsco_level IS NULL) FROM m_shortage
  UNION ALL SELECT 'occupation_name', count(*) FILTER (WHERE occupation_name IS NULL) FROM m_shortage
  UNION ALL SELECT 'shortage_status', count(*) FILTER (WHERE shortage_status IS NULL) FROM m_shortage
  UNION ALL SELECT 'osca_category', count(*) FILTER (WHERE osca_category IS NULL) FROM m_shortage
  UNION ALL SELECT 'assessment_year', count(*) FILTER (WHERE assessment_year IS NULL) FROM m_shortage
  UNION ALL SELECT 'state_code', count(*) FILTER (WHERE state_code IS NULL) FROM m_shortage) x""",
)
register(
    "g14_check_report",
    with_(M_ENROL, M_VACANCY, M_CPI, M_PROVIDER, M_COURSE, M_LOCATION)
    + f"""
SELECT 'non_empty' AS "check", 'fact_student_enrolment' AS table_name, count(*) AS observed,
       count(*) > 0 AS passed FROM m_enrol
UNION ALL
SELECT 'null_keys', 'fact_student_enrolment', n, n = 0 FROM (
  SELECT count(*) FILTER (WHERE enrol_year IS NULL OR enrol_month IS NULL OR nationality IS NULL
                          OR sector IS NULL OR state_code IS NULL) AS n FROM m_enrol) a
UNION ALL
SELECT 'duplicate_keys', 'fact_student_enrolment', count(*), count(*) = 0
FROM (SELECT {BASIC} FROM m_enrol GROUP BY ALL HAVING count(*) > 1) d
UNION ALL
SELECT 'distinct_sector', 'fact_student_enrolment', count(DISTINCT sector), count(DISTINCT sector) = 5 FROM m_enrol
UNION ALL
SELECT 'format_vacancy_period', 'fact_job_vacancy', n, n = 0 FROM (
  SELECT count(*) FILTER (WHERE vacancy_period IS NULL OR trim(vacancy_period) = ''
                          OR NOT regexp_matches(vacancy_period, '^\\d{{4}}-\\d{{2}}$')) AS n FROM m_vacancy) b
UNION ALL
SELECT 'duplicate_keys', 'fact_job_vacancy', count(*), count(*) = 0
FROM (SELECT vacancy_period, coalesce(anzsco_code, ''), state_code, measure FROM m_vacancy
      GROUP BY ALL HAVING count(*) > 1) v
UNION ALL
SELECT 'orphans', 'bridge_course_location', count(*), count(*) = 0
FROM m_bridge b WHERE NOT EXISTS (SELECT 1 FROM m_course c WHERE c.cricos_code = b.cricos_code)
UNION ALL
SELECT 'range_value', 'fact_cpi', n, n = 0 FROM (
  SELECT count(*) FILTER (WHERE value < 1.0 OR value > 50.0) AS n FROM m_cpi) c
UNION ALL
SELECT 'at_least_5', 'dim_provider', count(*), count(*) >= 5 FROM m_provider""",
)

register(
    "w06_ytd_never_falls",
    with_(M_ENROL)
    + """
SELECT enrol_year, enrol_month, nationality, sector, state_code, ytd_enrolments, prev_ytd FROM (
  SELECT *, lag(ytd_enrolments) OVER (PARTITION BY enrol_year, nationality, sector, state_code
                                      ORDER BY enrol_month) AS prev_ytd FROM m_enrol) x
WHERE prev_ytd IS NOT NULL AND ytd_enrolments < prev_ytd""",
)
register(
    "w07_monthly_flow_from_ytd",
    with_(M_ENROL)
    + """
SELECT enrol_year, enrol_month, CAST(sum(ytd_enrolments - coalesce(prev, 0)) AS BIGINT) AS monthly_enrolments
FROM (SELECT *, lag(ytd_enrolments) OVER (PARTITION BY enrol_year, nationality, sector, state_code
                                          ORDER BY enrol_month) AS prev FROM m_enrol) x
GROUP BY 1, 2""",
)
register(
    "w08_trend_labels",
    with_(M_ENROL)
    + """,
yearly AS (
  SELECT e.nationality, e.enrol_year, CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments
  FROM m_enrol e JOIN (SELECT enrol_year, max(enrol_month) AS lm FROM m_enrol GROUP BY 1) l
    ON e.enrol_year = l.enrol_year AND e.enrol_month = l.lm
  GROUP BY 1, 2)
SELECT nationality, enrol_year, total_enrolments,
       CASE WHEN prev IS NULL THEN NULL WHEN total_enrolments > prev THEN 'UP'
            WHEN total_enrolments < prev THEN 'DOWN' ELSE 'STABLE' END AS trend
FROM (SELECT *, lag(total_enrolments) OVER (PARTITION BY nationality ORDER BY enrol_year) AS prev FROM yearly) y""",
)


# ---------------------------------------------------------------------------
# Grid, reshape and scalar functions

M_GRID = """
gdata AS (
  SELECT 'nations.xlsx' AS path, r_name AS sheet, r_regionkey * 2 + rn AS row_idx,
         n_name AS c0, CAST(n_nationkey AS VARCHAR) AS c1, CASE WHEN rn = 1 THEN r_name END AS c2
  FROM (SELECT n.*, r.*, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS rn
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) x),
ghead AS (SELECT 'nations.xlsx' AS path, r_name AS sheet, r_regionkey * 2 AS row_idx,
                 'Country' AS c0, 'Nation key' AS c1, 'Region' AS c2 FROM region),
gtitle AS (SELECT 'nations.xlsx' AS path, sheet, k AS row_idx,
                  CASE WHEN k = 0 THEN 'Table 1. Country list for ' || sheet END AS c0,
                  CAST(NULL AS VARCHAR) AS c1, CAST(NULL AS VARCHAR) AS c2
           FROM (SELECT r_name AS sheet, unnest(range(0, r_regionkey * 2)) AS k FROM region) y),
m_grid AS (SELECT * FROM gdata UNION ALL SELECT * FROM ghead UNION ALL SELECT * FROM gtitle),
gflags AS (
  SELECT path, sheet, row_idx,
         (coalesce(regexp_matches(lower(c0), 'country'), false) OR coalesce(regexp_matches(lower(c1), 'country'), false)
          OR coalesce(regexp_matches(lower(c2), 'country'), false)) AS has_country,
         (coalesce(regexp_matches(lower(c0), 'key'), false) OR coalesce(regexp_matches(lower(c1), 'key'), false)
          OR coalesce(regexp_matches(lower(c2), 'key'), false)) AS has_key,
         (CASE WHEN c0 IS NOT NULL AND trim(c0) <> '' THEN 1 ELSE 0 END
          + CASE WHEN c1 IS NOT NULL AND trim(c1) <> '' THEN 1 ELSE 0 END
          + CASE WHEN c2 IS NOT NULL AND trim(c2) <> '' THEN 1 ELSE 0 END) AS filled
  FROM m_grid WHERE row_idx < 20)"""

register(
    "p02_header_detection",
    with_(M_GRID)
    + """
SELECT path, sheet,
       CAST(coalesce(min(row_idx) FILTER (WHERE has_country), 0) AS INTEGER) AS hint_row,
       CAST(coalesce(min(row_idx) FILTER (WHERE filled > 2), 0) AS INTEGER) AS nonnull_row,
       CAST(coalesce(min(row_idx) FILTER (WHERE has_country AND filled >= 3), 0) AS INTEGER) AS hint_nonnull_row,
       CAST(coalesce(min(row_idx) FILTER (WHERE has_country AND has_key), 0) AS INTEGER) AS both_row
FROM gflags GROUP BY path, sheet""",
)

register(
    "r12_grid_tidy_forward_fill",
    with_(M_GRID)
    + """,
hdr AS (SELECT path, sheet, coalesce(min(row_idx) FILTER (WHERE has_country AND filled >= 3), 0) AS h
        FROM gflags GROUP BY path, sheet)
SELECT g.path, g.sheet, CAST(g.row_idx AS INTEGER) AS row_idx, g.c0 AS country, g.c1 AS nation_key,
       last_value(g.c2 IGNORE NULLS) OVER (PARTITION BY g.path, g.sheet ORDER BY g.row_idx
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS region
FROM m_grid g JOIN hdr ON g.path = hdr.path AND g.sheet = hdr.sheet WHERE g.row_idx > hdr.h""",
)

M_VISA_ACTIVITY = """
visa_g AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'Primary' ELSE 'Secondary' END AS applicant_type,
         CASE l_returnflag WHEN 'A' THEN 'Higher Education' WHEN 'N' THEN 'VET' WHEN 'R' THEN 'ELICOS' END AS sector,
         CAST(fy0 AS VARCHAR) || '_' || lpad(CAST((fy0 + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
         count(*) AS lodged, count(*) FILTER (WHERE l_discount < 0.05) AS granted
  FROM (SELECT *, year(l_shipdate) - CASE WHEN month(l_shipdate) < 7 THEN 1 ELSE 0 END AS fy0 FROM lineitem) l
  GROUP BY 1, 2, 3),
m_visa_activity AS (
  SELECT applicant_type, sector, financial_year, 'lodged' AS measure, CAST(lodged AS DOUBLE) AS value FROM visa_g
  UNION ALL SELECT applicant_type, sector, financial_year, 'granted', CAST(granted AS DOUBLE) FROM visa_g
  UNION ALL SELECT applicant_type, sector, financial_year, 'grant_rate_pct', round(granted / lodged * 100, 2)
  FROM visa_g)"""

register(
    "p24_student_visa_activity",
    with_(M_VISA_ACTIVITY)
    + """
SELECT applicant_type, sector, replace(financial_year, '_', '-') AS financial_year, measure, value
FROM m_visa_activity ORDER BY financial_year, applicant_type, sector, measure""",
)
register(
    "a20_visa_lodged_by_year",
    with_(M_VISA_ACTIVITY)
    + "SELECT financial_year, sum(value) AS total_value FROM m_visa_activity WHERE measure = 'lodged' GROUP BY 1",
)
register(
    "p23_dynamic_grain_sum",
    with_(M_VISA_ACTIVITY)
    + "SELECT sector, applicant_type, sum(value) AS total_value FROM m_visa_activity WHERE measure = 'granted' "
    "GROUP BY 1, 2",
)

SERIES_YEARS = tuple(str(y) for y in range(1995, 2002))
_series_cols = ", ".join(
    f"coalesce(sum(l_quantity) FILTER (WHERE year(l_shipdate) = {y}), 0) AS \"{y}\"" for y in SERIES_YEARS
)
M_SERIES_WIDE = f"""
series_wide AS (
  SELECT l_returnflag, l_linestatus, {_series_cols}
  FROM lineitem GROUP BY 1, 2)"""

register(
    "r09_series_pivot",
    with_(M_SERIES_WIDE)
    + "SELECT *, " + " + ".join(f'"{y}"' for y in SERIES_YEARS) + " AS grand_total FROM series_wide",
)
register(
    "r01_series_unpivot",
    with_(M_SERIES_WIDE)
    + " UNION ALL ".join(
        f"SELECT l_returnflag, l_linestatus, '{y}' AS year, \"{y}\" AS quantity FROM series_wide" for y in SERIES_YEARS
    ),
)

register(
    "x01_x03_x11_text_coercions",
    """
SELECT p_partkey, p_retailprice AS price, CAST(p_size AS DOUBLE) AS size, CAST(NULL AS DOUBLE) AS brand_number,
       CAST(p_size AS VARCHAR) AS leading_code,
       CAST(CASE WHEN p_size > 25 THEN p_size ELSE 0 END AS BIGINT) AS size_or_zero
FROM part""",
)
register(
    "x05_x14_date_and_period_text",
    """
SELECT d AS order_date, d AS parsed_date, CAST(month(d) AS INTEGER) AS month_from_name,
       strftime(d, '%Y-%m') AS header_month,
       CAST(fy0 AS VARCHAR) || '-' || lpad(CAST((fy0 + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
       strftime(d, '%Y-%m') AS period, strftime(d, '%B %Y') AS month_label
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
             year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS fy0 FROM orders) o""",
)
register(
    "x27_event_props_json",
    """
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
       count(CAST(json_extract(props, '$.k') AS INTEGER)) AS n_k
FROM events GROUP BY event_type""",
)
register(
    "r14_message_role_histogram",
    "SELECT role, count(*) AS n FROM conversations GROUP BY role ORDER BY n DESC, role LIMIT 15",
)
register(
    "b12_page_links",
    r"""
SELECT page_id, link_pos,
       CASE WHEN starts_with(href, '/') THEN base || href ELSE href END AS link,
       regexp_matches(CASE WHEN starts_with(href, '/') THEN base || href ELSE href END,
                      '^https://[^/]+\.example\.(com|org)/') AS is_allowed
FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base,
             unnest(l) AS href, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS link_pos
      FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages) a) b""",
)


# ---------------------------------------------------------------------------
# Aggregate profiles, filters, sorts, copy text, cross-tabs
# (A12, A14, A15, A19, A23, A25, A26, F06, F07, F10, F12, F13, T05-T07, U02, X28, R03, R06)

register(
    "a12_visa_volume_by_country",
    with_(M_SKILLED_COB)
    + "SELECT country_name AS nationality, sum(value) AS visa_volume FROM m_skilled_cob "
    "WHERE country_name IS NOT NULL GROUP BY 1",
)
register(
    "a14_distinct_counts_by_sector",
    with_(M_ENROL)
    + "SELECT sector, count(DISTINCT nationality) AS n_nationalities, count(DISTINCT state_code) AS n_states, "
    "count(DISTINCT enrol_year) AS n_years FROM m_enrol GROUP BY sector",
)
register(
    "a15_course_null_profile",
    with_(M_COURSE)
    + "SELECT count(*) AS n_courses, count(*) FILTER (WHERE provider_id IS NULL) AS null_providers, "
    "min(tuition_fee) AS min_fee, max(tuition_fee) AS max_fee, round(avg(tuition_fee), 6) AS avg_fee FROM m_course",
)
register(
    "a19_visa_grouping_sets",
    with_(M_VISA_ACTIVITY)
    + """
SELECT applicant_type, sector, financial_year, sum(value) AS total_value,
       CAST(GROUPING(applicant_type, sector, financial_year) AS BIGINT) AS grouping_level
FROM m_visa_activity WHERE measure = 'lodged'
GROUP BY GROUPING SETS ((applicant_type), (sector), (financial_year), (applicant_type, sector),
                        (sector, financial_year), ())""",
)
register(
    "a23_series_coverage",
    with_(M_FX)
    + "SELECT series_id, min(rate_date) AS first_date, max(rate_date) AS last_date, count(*) AS n_rows, "
    "count(DISTINCT rate_date) AS n_days FROM m_fx GROUP BY series_id",
)
register(
    "a25_rows_by_sector",
    with_(M_ENROL) + "SELECT sector, count(*) AS n_rows FROM m_enrol GROUP BY sector",
)
register(
    "a26_grand_total_kpi",
    with_(M_ENROL, LATEST)
    + "SELECT CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments FROM m_enrol, latest "
    "WHERE enrol_year = ly AND enrol_month = lm",
)
register(
    "f06_numeric_profile_values",
    with_(M_PROFILE)
    + "SELECT dimension, count(*) AS n_numeric FROM m_profile "
    "WHERE regexp_matches(value_text, '^[0-9]+(\\.[0-9]+)?$') GROUP BY dimension",
)
register(
    "f07_six_digit_codes",
    with_(M_SHORTAGE, M_VACANCY)
    + "SELECT count(DISTINCT anzsco_code) AS n_codes FROM (SELECT anzsco_code FROM m_shortage "
    "UNION ALL SELECT anzsco_code FROM m_vacancy) u WHERE regexp_matches(anzsco_code, '^\\d{6}$')",
)
register(
    "f10_population_rows_without_totals",
    with_(GEO_ORDERS, M_POPULATION)
    + "SELECT erp_period, count(*) AS n_rows FROM m_population "
    "WHERE country_name IS NULL OR NOT contains(country_name, 'Total') GROUP BY erp_period",
)
register(
    "f12_positive_net_migration",
    with_(GEO_ORDERS, M_NOM)
    + "SELECT nom_period, count(*) AS n_rows FROM m_nom WHERE direction = 'net' AND value > 0 GROUP BY nom_period",
)
register(
    "f13_sheet_selection",
    with_(M_GRID)
    + "SELECT sheet, count(*) AS n_rows FROM m_grid WHERE NOT regexp_matches(lower(sheet), 'east|europe') "
    "GROUP BY sheet",
)
register(
    "t05_two_key_sort",
    with_(M_VISA_ACTIVITY)
    + "SELECT sector, financial_year, applicant_type, value FROM m_visa_activity WHERE measure = 'lodged' "
    "ORDER BY sector, value DESC, financial_year, applicant_type",
)
register(
    "t06_top_fill_rate",
    with_(M_CEILINGS)
    + """
SELECT anzsco_code, visa_subclass, state, ceiling, fill_rate_pct FROM m_ceilings
WHERE (state IS NULL OR upper(trim(state)) IN ('NATIONAL', 'ALL', '', 'NAN')) AND ceiling >= 50
ORDER BY fill_rate_pct DESC, anzsco_code, visa_subclass, state LIMIT 10""",
)
register(
    "t07_head_enrolments",
    with_(M_ENROL, LATEST)
    + """
SELECT nationality, CAST(sum(ytd_enrolments) AS BIGINT) AS total_enrolments FROM m_enrol, latest
WHERE enrol_year = ly AND enrol_month = lm GROUP BY nationality ORDER BY total_enrolments DESC, nationality LIMIT 5""",
)
register(
    "u02_mart_table_counts",
    with_(M_PROVIDER, M_COURSE, M_LOCATION)
    + """
SELECT 'dim_provider' AS table_name, count(*) AS rows FROM m_provider
UNION ALL SELECT 'dim_course', count(*) FROM m_course
UNION ALL SELECT 'dim_provider_location', count(*) FROM m_location
UNION ALL SELECT 'bridge_course_location', count(*) FROM m_bridge""",
)
register(
    "x28_occupation_copy",
    with_(M_CEILINGS, NAT_CEILINGS, M_SHORTAGE, M_OSL, M_VISA_LISTS)
    + """,
t189 AS (SELECT anzsco_code, arg_max(trend, source_row) FILTER (WHERE visa_subclass = '189') AS trend_189
         FROM nat GROUP BY anzsco_code),
osl1 AS (SELECT anzsco_code, arg_min(shortage_status, source_row) AS shortage_status FROM m_osl
         WHERE coalesce(state, '') IN ('', 'National') GROUP BY anzsco_code),
flags AS (SELECT anzsco_code,
                 max(CAST(contains(coalesce(visa_subclass, ''), '189') AS INTEGER)) AS e189,
                 max(CAST(contains(coalesce(visa_subclass, ''), '190') AS INTEGER)) AS e190,
                 max(CAST(contains(coalesce(visa_subclass, ''), '491') AS INTEGER)) AS e491
          FROM m_visa_lists GROUP BY anzsco_code)
SELECT c.anzsco_code,
       concat_ws('; ',
         CASE WHEN coalesce(CAST(contains(o.shortage_status, 'National') AS INTEGER), 0) = 1
              THEN 'National shortage' END,
         CASE WHEN coalesce(f.e189, 0) = 1 THEN 'Eligible for subclass 189' END,
         CASE WHEN coalesce(f.e190, 0) = 1 THEN 'Eligible for subclass 190' END,
         CASE WHEN coalesce(f.e491, 0) = 1 THEN 'Eligible for subclass 491' END,
         'Invitations trending ' || t.trend_189) AS copy_text
FROM (SELECT DISTINCT anzsco_code FROM m_ceilings) c
LEFT JOIN t189 t ON c.anzsco_code = t.anzsco_code
LEFT JOIN osl1 o ON c.anzsco_code = o.anzsco_code
LEFT JOIN flags f ON c.anzsco_code = f.anzsco_code""",
)
register(
    "r03_crosstab_periods_to_long",
    with_(GEO_ORDERS, M_NOM)
    + "SELECT country_name, nom_period, CAST(sum(value) AS BIGINT) AS value FROM m_nom "
    "WHERE direction = 'net' AND country_name <> 'Total' GROUP BY 1, 2",
)
register(
    "r06_crosstab_to_long",
    with_(M_ENROL, LATEST)
    + "SELECT nationality, sector, CAST(sum(ytd_enrolments) AS DOUBLE) AS total_enrolments FROM m_enrol, latest "
    "WHERE enrol_year = ly AND enrol_month = lm GROUP BY 1, 2",
)

register(
    "b09_visa_list_extract",
    """
SELECT printf('%06d', p_partkey) AS anzsco_code, p_name AS occupation,
       CASE WHEN p_size <= 10 THEN '189, 190, 491' WHEN p_size <= 25 THEN '190, 491' END AS visa_subclass,
       CASE WHEN p_size > 25 THEN p_brand END AS assessing_authority,
       CASE WHEN p_size <= 10 THEN 'MLTSSL' WHEN p_size <= 25 THEN 'STSOL' ELSE 'ROL' END AS list_type
FROM part WHERE p_size <= 40""",
)

register(
    "st4_daily_event_averages",
    "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, round(avg(value), 6) AS avg_value, "
    "count(*) AS n FROM events GROUP BY 1, 2",
)
register(
    "st2_stream_upsert_latest_event",
    "SELECT user_id, event_type, arg_max(value, event_id) AS value, arg_max(ts, event_id) AS last_ts "
    "FROM events GROUP BY user_id, event_type",
)

register(
    "s09_enrolment_sheets_roundtrip",
    with_(M_ENROL)
    + """
SELECT enrol_year, enrol_month, nationality, state_code, sector, 'Non Government' AS provider_type,
       'No' AS new_to_australia, 'No' AS ends_this_year, ytd_enrolments, ytd_commencements,
       CAST(NULL AS BIGINT) AS total
FROM m_enrol""",
)


# ---------------------------------------------------------------------------
# Load audit (L01, L03, A18, T03): runs folded directly from the events

RUNS = """
runs AS (
  SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, event_type AS source, 'fact_' || event_type AS table_name,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
         ts AS started_at,
         CASE WHEN event_type <> 'error' THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS completed_at,
         CAST(floor(value) AS BIGINT) AS rows_inserted,
         CASE WHEN event_type = 'error' THEN 'load failed: ' || props END AS error_message
  FROM events)"""

register("l01_audit_runs_folded", with_(RUNS) + "SELECT * FROM runs")
register(
    "a18_last_etl_updates",
    with_(RUNS)
    + "SELECT source, table_name, max(completed_at) AS last_completed FROM runs WHERE status = 'completed' "
    "GROUP BY source, table_name ORDER BY source, table_name",
)
register(
    "t03_recent_failures",
    with_(RUNS)
    + "SELECT run_id, source, table_name, started_at, error_message FROM runs WHERE status = 'failed' "
    "ORDER BY started_at DESC, run_id LIMIT 10",
)
register(
    "l03_freshness_banner",
    with_(RUNS)
    + "SELECT max(completed_at) AS latest_completed, count(DISTINCT (source, table_name)) AS tables_tracked "
    "FROM runs WHERE status = 'completed'",
)

register(
    "s10_pivot_cache_decode",
    with_(M_ENROL)
    + "SELECT nationality, sector, count(*) AS n_records, CAST(sum(ytd_enrolments) AS BIGINT) AS ytd_total "
    "FROM m_enrol GROUP BY nationality, sector",
)

register(
    "a04_yearly_snapshot_nationality_global",
    with_(M_ENROL)
    + """
SELECT e.enrol_year, e.enrol_month,
       CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments,
       CAST(sum(e.ytd_commencements) AS BIGINT) AS total_commencements
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
WHERE e.nationality = 'NATION_7'
GROUP BY e.enrol_year, e.enrol_month""",
)
register(
    "a05_sector_yearly_trend_selected",
    with_(M_ENROL)
    + """
SELECT e.enrol_year, e.sector, CAST(sum(e.ytd_enrolments) AS BIGINT) AS total_enrolments
FROM m_enrol e
JOIN (SELECT enrol_year, max(enrol_month) AS latest_month FROM m_enrol GROUP BY enrol_year) l
  ON e.enrol_year = l.enrol_year AND e.enrol_month = l.latest_month
WHERE e.sector IN ('1-URGENT', '5-LOW')
GROUP BY e.enrol_year, e.sector""",
)
register(
    "a13_skilled_migration_countries",
    with_(M_SKILLED_COB)
    + "SELECT DISTINCT country_name FROM m_skilled_cob WHERE country_name IS NOT NULL ORDER BY country_name",
)
register(
    "p24_skilled_migration_by_country",
    with_(M_SKILLED_COB)
    + """
SELECT replace(financial_year, '_', '-') AS financial_year, country_name, anzsco_code, occupation_name,
       visa_subclass, measure, value
FROM m_skilled_cob WHERE country_name = 'NATION_3' ORDER BY financial_year""",
)

register(
    "r13_message_cells_roundtrip",
    "SELECT conv_id * 1000 + turn AS id, CAST(turn AS VARCHAR) AS ts, 0 AS page_idx, 0 AS row_idx, 0 AS col_idx, text, "
    "CAST(turn AS DOUBLE) AS number FROM conversations WHERE role <> 'system'",
)

GAPPED = """
gapped AS (SELECT cricos_code, CASE WHEN cricos_code NOT LIKE '%7' THEN provider_id END AS provider_id FROM m_course),
listed AS (SELECT provider_id FROM m_provider WHERE state_code IS NOT NULL),
holed AS (SELECT CASE WHEN state_code IS NOT NULL THEN provider_id END AS provider_id FROM m_provider)"""

register(
    "j15_courses_without_listed_provider",
    with_(M_PROVIDER, M_COURSE, GAPPED)
    + """
SELECT g.cricos_code, g.provider_id FROM gapped g LEFT JOIN listed l ON g.provider_id = l.provider_id WHERE l.provider_id IS NULL""",
)
register(
    "j16_not_in_with_and_without_null",
    with_(M_PROVIDER, M_COURSE, GAPPED)
    + """
SELECT 'listed' AS parents, count(*) AS n FROM gapped WHERE provider_id NOT IN (SELECT provider_id FROM listed)
UNION ALL SELECT 'listed or null', count(*) FROM gapped WHERE provider_id NOT IN (SELECT provider_id FROM holed)
UNION ALL SELECT 'none', count(*) FROM gapped""",
)
register(
    "w06_monthly_flow_falls",
    with_(M_ENROL)
    + """,
flows AS (SELECT enrol_year, enrol_month, nationality, sector, state_code,
                 ytd_enrolments - coalesce(lag(ytd_enrolments) OVER w, 0) AS flow
          FROM m_enrol WINDOW w AS (PARTITION BY enrol_year, nationality, sector, state_code ORDER BY enrol_month))
SELECT * FROM (SELECT *, lag(flow) OVER (PARTITION BY enrol_year, nationality, sector, state_code ORDER BY enrol_month)
                         AS previous_flow FROM flows) f
WHERE previous_flow IS NOT NULL AND flow < previous_flow""",
)

register(
    "x06_orders_by_month_text",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1, 2",
)
register(
    "x12_x13_x22_part_texts",
    "SELECT p_partkey, nullif(regexp_extract(p_brand, '#([0-9][0-9])$', 1), '') AS two_digit_brand, "
    "CASE WHEN p_size > 3 THEN trim(p_name) END AS name, left(p_name, 5) AS short_name FROM part",
)
register(
    "x30_fill_rates",
    with_(M_CEILINGS)
    + "SELECT anzsco_code, visa_subclass, state, "
    "CASE WHEN ceiling <> 10 THEN round(invitations_issued * 100.0 / (ceiling - 10), 6) END AS fill_rate FROM m_ceilings",
)
register(
    "f17_allowed_links",
    r"""
SELECT page_id, base || href AS link
FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base,
             unnest(list_distinct(regexp_extract_all(html, '<a href="(/[A-Za-z0-9]+)"', 1))) AS href FROM pages) h
WHERE base LIKE 'https://%' AND lower(href) = '/de' AND href LIKE '/d%'""",
)
register(
    "a17_codes_listed_twice",
    with_(M_OSL)
    + "SELECT anzsco_code, state, shortage_status, source_row FROM m_osl "
    "QUALIFY count(*) OVER (PARTITION BY anzsco_code, state) > 1",
)
register(
    "g08_g18_counts_after_rerun",
    """
SELECT coalesce(b.p, a.p) AS table_name, b.n AS rows_before, a.n AS rows_after, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta,
       abs(coalesce(a.n, 0) - coalesce(b.n, 0)) <= coalesce(b.n, 0) * 0.4 AS passed
FROM (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) b
FULL JOIN (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1) a ON a.p = b.p""",
)
register(
    "g13_columns_without_values",
    "SELECT 'osl' AS table_name, 'assessor' AS column_name, "
    "count(*) + count(*) FILTER (WHERE p_partkey % 4 = 0) AS rows FROM part",
)
register(
    "r05_profile_unpivot_all",
    """
WITH w AS (
  SELECT printf('%06d', p_partkey) AS anzsco_code, p_name, CASE WHEN p_size > 45 THEN 'np' ELSE printf('%.2f', p_retailprice) END AS e,
         CAST(p_size * 100 AS VARCHAR) AS m, p_brand FROM part)
SELECT anzsco_code, 'occupation_name' AS field, p_name AS text FROM w
UNION ALL SELECT anzsco_code, 'median_full_time_earnings_per_week', e FROM w
UNION ALL SELECT anzsco_code, 'employed', m FROM w
UNION ALL SELECT anzsco_code, 'skill_level', p_brand FROM w""",
)

ORDER_BATCHES = """
per AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
               count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders GROUP BY 1, 2),
first AS (SELECT month, priority, f AS orders, 'first' AS note FROM per WHERE month < '1997-01'),
second AS (SELECT month, priority, n AS orders FROM per WHERE month >= '1996-01')"""

register(
    "k01_upsert_with_null_keys",
    with_(ORDER_BATCHES)
    + """
SELECT coalesce(s.month, f.month) AS month, CASE WHEN s.month IS NOT NULL THEN s.priority ELSE f.priority END AS priority,
       coalesce(s.orders, f.orders) AS orders, f.note
FROM first f FULL JOIN second s ON f.month = s.month AND f.priority IS NOT DISTINCT FROM s.priority""",
)
register(
    "k01_upsert_counts",
    with_(ORDER_BATCHES)
    + """,
j AS (SELECT f.month AS fm, s.month AS sm, f.orders AS fo, s.orders AS so
      FROM first f FULL JOIN second s ON f.month = s.month AND f.priority IS NOT DISTINCT FROM s.priority)
SELECT 0 AS load, count(fm) AS inserted, 0 AS updated, 0 AS unchanged FROM j
UNION ALL SELECT 1, count(*) FILTER (WHERE fm IS NULL), count(*) FILTER (WHERE fm IS NOT NULL AND sm IS NOT NULL AND fo <> so),
                 count(*) FILTER (WHERE fm IS NOT NULL AND sm IS NOT NULL AND fo = so) FROM j
UNION ALL SELECT 2, 0, 0, count(sm) FROM j""",
)
register(
    "k02_k03_replace_row_then_append",
    with_(ORDER_BATCHES)
    + """
SELECT month, priority, orders, note FROM first WHERE month < '1996-01'
UNION ALL SELECT month, priority, orders, CASE WHEN month >= '1997-01' THEN 'appended' END FROM second""",
)


from tidemark.plans import oracle_landed  # noqa: E402, F401
