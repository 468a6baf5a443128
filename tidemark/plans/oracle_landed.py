"""DuckDB SQL of the queries over landed files and published tables: the same questions put to the given tables."""

from __future__ import annotations

from tidemark.plans.oracle_sql import M_ENROL, M_ENROL_DETAILED, register, with_

register(
    "w01_price_rank_within_flag",
    """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
       round((rank() OVER f - 1 + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) + 1) / 2.0)
             / count(*) OVER (PARTITION BY l_returnflag) * 100.0, 6) AS price_pct
FROM lineitem WINDOW f AS (PARTITION BY l_returnflag ORDER BY l_extendedprice)""",
)
register(
    "a22_median_price_by_flag",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(median(l_extendedprice), 6) AS median_price, "
    "round(quantile_cont(l_extendedprice, 0.9), 6) AS p90_price FROM lineitem GROUP BY 1, 2",
)
register(
    "k01_upsert_by_period",
    """
WITH r AS (
  SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderpriority, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS filled
  FROM orders GROUP BY ALL)
SELECT CAST(y AS VARCHAR) AS year, count(*) AS rows, CAST(sum(CASE WHEN y = 1998 THEN filled ELSE orders END) AS BIGINT) AS orders,
       y IN (1998, 2000) AS written_again
FROM r GROUP BY y""",
)
register(
    "st3_repeats_within_horizon",
    """
WITH r AS (
  SELECT event_id, ts FROM events UNION ALL SELECT event_id, ts + INTERVAL 30 MINUTE FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, ts + INTERVAL 12 DAY FROM events WHERE event_id % 5 = 0),
g AS (SELECT event_id, ts, lag(ts) OVER (PARTITION BY event_id ORDER BY ts) AS before FROM r)
SELECT event_id, count(*) FILTER (before IS NULL OR ts - before > INTERVAL 1 DAY) AS passed FROM g GROUP BY event_id""",
)
register(
    "st5_audit_row_per_batch",
    """
WITH last AS (
  SELECT event_id % 3 AS b, user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY ALL),
seen AS (
  SELECT b, value, lag(b) OVER w AS before, lag(value) OVER w AS old FROM last WINDOW w AS (PARTITION BY user_id, event_type ORDER BY b))
SELECT 'latest-batch-' || b AS run_id, 'completed' AS status, count(*) FILTER (before IS NULL) AS rows_inserted,
       count(*) FILTER (before IS NOT NULL AND value IS DISTINCT FROM old) AS rows_updated,
       count(*) FILTER (before IS NOT NULL AND value IS NOT DISTINCT FROM old) AS rows_unchanged
FROM seen GROUP BY b""",
)
register(
    "s03_csv_of_two_encodings",
    "SELECT c_custkey, 'Société n° ' || c_name AS c_name, c_nationkey, CASE WHEN c_nationkey % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding FROM customer",
)
register(
    "s01_r02_series_files",
    """
WITH m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_orderpriority AS p, count(*) AS n, max(o_totalprice) AS v FROM orders GROUP BY ALL)
SELECT date, 'OR' || p[1] || 'N' AS series_id, CAST(n AS DOUBLE) AS value, 'Orders, ' || p AS title, 'Number' AS units, 'Monthly' AS frequency FROM m
UNION ALL SELECT date, 'OR' || p[1] || 'V', v, 'Largest total, ' || p, 'USD', 'Monthly' FROM m""",
)
register(
    "s05_p12_labelled_csv_periods",
    "SELECT strftime(l_shipdate, '%Y-%m') AS period, l_returnflag AS measure, l_linestatus AS region, sum(l_quantity) AS value FROM lineitem "
    "WHERE year(l_shipdate) BETWEEN 1996 AND 1998 AND month(l_shipdate) <> 2 GROUP BY 1, 2, 3",
)
register("s02_s04_csv_with_marks", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")

RELEASES = """
WITH l AS (
  SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, 'basic' AS kind, o_orderstatus AS k, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT year(o_orderdate), month(o_orderdate), 'detailed', o_orderpriority, count(*) FROM orders GROUP BY ALL),
f AS (
  SELECT y, m, kind, kind || '_' || y || '_' || lpad(CAST(m AS VARCHAR), 2, '0') || '.csv' AS filename,
         string_agg(k || ',' || n || chr(10), '' ORDER BY k) AS body FROM l GROUP BY ALL)"""

register(
    "g16_release_manifests",
    RELEASES
    + """
SELECT strftime(make_date(b.y, b.m, 1), '%B %Y') AS release_label, CAST(b.y AS INTEGER) AS release_year, CAST(b.m AS INTEGER) AS release_month, 'downloaded' AS status,
       b.filename AS basic_name, CAST(strlen(b.body) AS BIGINT) AS basic_bytes, sha256(b.body) AS basic_sha256, sha256(d.body) AS detailed_sha256,
       'https://releases.example.org/download/' || d.filename AS detailed_url
FROM f AS b JOIN f AS d ON b.y = d.y AND b.m = d.m AND b.kind = 'basic' AND d.kind = 'detailed'""",
)
register(
    "g15_manifest_against_files",
    RELEASES
    + """
SELECT filename, CASE WHEN kind = 'basic' AND m = 1 THEN 'size_mismatch,hash_mismatch' WHEN kind = 'basic' AND m = 2 THEN 'hash_mismatch'
       WHEN kind = 'detailed' AND m = 3 THEN 'missing_file' WHEN kind = 'basic' AND m = 4 THEN 'period_mismatch'
       WHEN kind = 'basic' AND m = 5 THEN 'missing_file' ELSE '' END AS problems FROM f
UNION ALL SELECT replace(filename, 'basic', 'base'), 'not_in_manifest' FROM f WHERE kind = 'basic' AND m = 5""",
)
register(
    "g08_loader_run_twice",
    """
WITH r AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderpriority FROM orders),
c AS (
  SELECT 'monthly_orders' AS table_name, count(*) AS before, count(*) AS after FROM r
  UNION ALL SELECT 'nations', count(*), count(*) FROM nation UNION ALL SELECT 'january_log', count(*), 2 * count(*) FROM r WHERE m = 1)
SELECT table_name, before AS rows_before, after AS rows_after, after - before AS delta, after - before <= before * 0.05 AS passed FROM c""",
)


# ---------------------------------------------------------------------------
# Source runners: what each release's sheets must give, stated over the given tables


def loaded(*parts: tuple[str, str, str, str]) -> str:
    """(table, key columns, value columns, query) of each table as (table_name, key, value, changed_again)."""
    def text(columns: str) -> str:
        return " || '|' || ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '')" for c in columns.split(","))

    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, {text(key)} AS key, {text(value)} AS value, 0::BIGINT AS changed_again FROM ({sql})" for table, key, value, sql in parts)


PEOPLE = """
WITH people AS (
  SELECT o_orderkey, o_orderstatus AS st, o_totalprice AS price, o_orderpriority AS pr, o_orderdate AS d, c_nationkey AS nk, n_name AS nation, c_mktsegment AS seg, o_custkey,
         year(o_orderdate) AS y, month(o_orderdate) AS m, year(o_orderdate) - (month(o_orderdate) < 7)::INTEGER AS fy,
         (year(o_orderdate) - (month(o_orderdate) < 7)::INTEGER) || '-' || lpad(CAST((year(o_orderdate) - (month(o_orderdate) < 7)::INTEGER + 1) % 100 AS VARCHAR), 2, '0') AS fin
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""
IN_YEARS = "fy BETWEEN 1995 AND 2001"
PCODE = "'P' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0')"
LOCATION = "substr(md5(" + PCODE + " || '|campus ' || s_nationkey), 1, 16)"

register(
    "l05_provider_register",
    loaded(
        ("dim_provider", "id", "name, kind, state, web",
         f"SELECT {PCODE} AS id, s_name || CASE WHEN s_suppkey % 10 = 0 THEN ' (new)' ELSE '' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'Government' ELSE 'Private' END AS kind, "
         "CASE WHEN s_suppkey % 10 <> 0 THEN 'S' || s_nationkey END AS state, CASE WHEN s_suppkey % 10 <> 0 THEN 'www.example.org' END AS web FROM supplier"),
        ("dim_course", "code", "name, field, weeks, fees",
         "SELECT 'C' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS code, p_name AS name, p_type AS field, CASE WHEN p_size <= 45 THEN CAST(p_size AS DOUBLE) END AS weeks, "
         "round(p_retailprice, 2) AS fees FROM part"),
        ("dim_provider_location", "id", "provider, name, suburb, postcode",
         f"SELECT {LOCATION} AS id, {PCODE} AS provider, 'Campus ' || s_nationkey AS name, 'Town' AS suburb, s_suppkey % 9000 AS postcode FROM supplier"),
        ("bridge_course_location", "code, id", "provider",
         f"SELECT DISTINCT 'C' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS code, {LOCATION} AS id, {PCODE} AS provider FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey % 5 = 0"),
    ),
)

RATING = "CASE WHEN p_size <= 40 THEN CASE WHEN p_size % 2 = 0 THEN 'Shortage' ELSE 'No shortage' END END"
register(
    "l05_labour_market",
    PEOPLE
    + loaded(
        ("fact_job_vacancy", "period, code, state, measure", "level, n",
         "WITH v AS (SELECT strftime(d, '%Y-%m') AS period, '2' || lpad(CAST(nk AS VARCHAR), 3, '0') AS code, CASE WHEN seg = 'BUILDING' THEN 'AUS' ELSE seg END AS state, "
         "CAST(count(*) AS DOUBLE) AS trend, max(price) AS original FROM people WHERE y IN (1997, 1998) GROUP BY 1, 2, 3) "
         "SELECT period, code, state, 'Trend' AS measure, 4 AS level, trend AS n FROM v UNION ALL SELECT period, code, state, 'Original', 4, original FROM v"),
        ("fact_occupation_shortage", "code, level, state, year", "name, status",
         f"SELECT * FROM (SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, 6 AS level, CASE WHEN p_size % 3 = 0 THEN 'NSW' ELSE 'AUS' END AS state, '2024' AS year, p_name AS name, {RATING} AS status FROM part "
         f"UNION ALL SELECT lpad(CAST(p_partkey AS VARCHAR), 4, '0'), 4, 'AUS', '2024', p_name, {RATING} FROM part WHERE p_partkey <= 1000) WHERE status IS NOT NULL"),
        ("ref_occupation_profile", "code, measure, dimension", "txt, num",
         "WITH p AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_retailprice, p_size, p_brand FROM part) "
         "SELECT code, 'Overview' AS measure, 'weekly_pay' AS dimension, CAST(p_retailprice AS VARCHAR) AS txt, p_retailprice AS num FROM p "
         "UNION ALL SELECT code, 'Overview', 'size', CAST(p_size AS VARCHAR), CAST(p_size AS DOUBLE) FROM p WHERE p_size > 25 "
         "UNION ALL SELECT code, 'Overview', 'brand', p_brand, NULL FROM p"),
    ),
)
register(
    "l05_visa_workbooks",
    PEOPLE
    + loaded(
        ("fact_student_visa_activity", "kind, pr, fin, measure", "v",
         f"WITH s AS (SELECT 'Applicant ' || st AS kind, pr, fin, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (price > 150000) AS DOUBLE) AS g FROM people WHERE {IN_YEARS} GROUP BY 1, 2, 3) "
         "SELECT kind, pr, fin, 'lodged' AS measure, n AS v FROM s UNION ALL SELECT kind, pr, fin, 'granted', g FROM s UNION ALL SELECT kind, pr, fin, 'grant_rate_pct', round(g / n * 100, 1) FROM s"),
        ("fact_temp_skilled_visa", "sub, nation, period, state, measure", "v",
         f"SELECT pr[1] || '82' AS sub, nation, fin AS period, 'AUS' AS state, 'granted' AS measure, CAST(count(*) AS DOUBLE) AS v FROM people WHERE {IN_YEARS} GROUP BY ALL "
         "UNION ALL SELECT pr[1] || '82', nation, CAST(y AS VARCHAR), seg, 'holders', CAST(count(*) * 1000 AS DOUBLE) FROM people WHERE y IN (1999, 2000) GROUP BY ALL"),
        ("fact_temp_graduate_visa", "seg, nation, fin, measure", "v",
         f"SELECT seg, nation, fin, 'lodged' AS measure, CAST(count(*) AS DOUBLE) AS v FROM people WHERE {IN_YEARS} GROUP BY ALL "
         f"UNION ALL SELECT seg, nation, fin, 'granted', CAST(count(*) FILTER (price > 150000) AS DOUBLE) FROM people WHERE {IN_YEARS} GROUP BY ALL"),
        ("fact_permanent_migration", "seg, nation, outcome", "v", "SELECT seg, nation, lower(st) AS outcome, CAST(count(*) AS DOUBLE) AS v FROM people GROUP BY ALL"),
    ),
)
register(
    "l05_macro_statistics",
    PEOPLE
    + loaded(
        ("fact_labour_force", "period, id", "title, sex, adjustment, unit, v",
         "WITH s AS (SELECT strftime(d, '%Y-%m') AS period, pr, m, CAST(count(*) AS DOUBLE) AS n FROM people GROUP BY ALL) "
         "SELECT period, 'A' || pr[1] AS id, 'Employed ' || pr || ' ;  Persons ;' AS title, 'Persons' AS sex, CASE WHEN pr[1] IN ('1', '3') THEN 'Trend' WHEN pr[1] IN ('2', '4') THEN 'Original' END AS adjustment, "
         "'000' AS unit, n AS v FROM s UNION ALL SELECT period, 'B' || pr[1], 'Rate ' || pr || ' ;  Males ;  Seasonally Adjusted', 'Males', 'Seasonally Adjusted', 'Percent', n * 2 FROM s WHERE m <> 3"),
        ("fact_cpi", "period, id", "title, v", "SELECT strftime(d, '%Y-%m') AS period, 'C' || pr[1] AS id, 'Index Numbers' AS title, CAST(count(*) + 100 AS DOUBLE) AS v FROM people GROUP BY ALL"),
        ("fact_overseas_migration", "fin, nation, state, direction", "v",
         f"SELECT fin, nation, 'AUS' AS state, CASE WHEN st = 'O' THEN 'arrivals' ELSE 'departures' END AS direction, CAST(count(*) AS DOUBLE) AS v FROM people WHERE {IN_YEARS} GROUP BY ALL"),
        ("fact_population_by_cob", "y, nation, state", "v",
         "SELECT y, nation, CASE WHEN nk % 2 = 0 THEN 'NSW' ELSE 'AUS' END AS state, CAST(sum(o_custkey) AS BIGINT) AS v FROM people WHERE y BETWEEN 1995 AND 2001 GROUP BY ALL"),
    ),
)
register(
    "l05_skilled_migration",
    PEOPLE
    + loaded(
        ("fact_skilled_migration", "fin, sub, seg, state, measure", "v",
         f"WITH s AS (SELECT fin, '18' || pr[1] AS sub, seg, 'AUS' AS state, count(*) AS n FROM people WHERE {IN_YEARS} GROUP BY ALL) "
         "SELECT fin, sub, seg, state, 'Granted' AS measure, CAST(n AS DOUBLE) AS v FROM s UNION ALL SELECT fin, sub, seg, state, 'Lodged', CAST(n * 1001 AS DOUBLE) FROM s"),
        ("ref_skilled_migration_by_cob_occupation", "fin, country, code, sub, measure", "occupation, v",
         "SELECT fin, CASE WHEN nk > 0 THEN nation ELSE '' END AS country, '22222' || pr[1] AS code, '19' || pr[1] AS sub, 'granted' AS measure, 'Occupation ' || pr[1] AS occupation, "
         "CAST(count(*) + CASE WHEN pr[1] = '3' THEN 5 ELSE 0 END AS DOUBLE) AS v FROM people GROUP BY fin, nk, nation, pr"),
    ),
)
register(
    "l05_interest_exports",
    PEOPLE
    + loaded(
        ("stg_skillselect_eoi", "month, visa, status, source_view, dim1, dim2", "name1, name2, n",
         "SELECT lpad(CAST(m AS VARCHAR), 2, '0') || '/2000' AS month, '189' AS visa, 'Submitted' AS status, 'State_Points' AS source_view, nation AS dim1, pr AS dim2, 'Nominated State' AS name1, 'Points' AS name2, "
         "CAST(count(*) * 999 AS DOUBLE) AS n FROM people WHERE y = 2000 GROUP BY m, nation, pr "
         "UNION ALL SELECT 'export', '190', 'Invited', seg, st, pr, 'Status', 'Priority', CAST(count(*) AS DOUBLE) FROM people WHERE y = 1999 AND st <> 'P' GROUP BY seg, st, pr"),
    ),
)

# ---------------------------------------------------------------------------
# Files to choose from, names and roles, exports, refused loads, release pages

register(
    "s12_message_log_files",
    "SELECT CASE WHEN role = 'system' THEN 'sent' ELSE 'recv' END AS dir, count(*) AS messages, count(conv_id * 1000 + turn) AS with_id, CAST(sum(turn) AS BIGINT) AS ts_sum FROM conversations GROUP BY 1",
)
register(
    "s13_s14_newest_of_the_first_source",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS priority, count(*) AS n FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1, 2",
)
register(
    "s15_s16_reference_file_and_seeds",
    """
SELECT CASE WHEN n_nationkey = 0 THEN 'NSW' ELSE 'N' || n_nationkey END AS state_code, n_name || ', the' AS state_name, 0 AS is_territory FROM nation
UNION ALL SELECT * FROM (VALUES ('VIC', 'Victoria', 0), ('QLD', 'Queensland', 0), ('SA', 'South Australia', 0), ('WA', 'Western Australia', 0), ('TAS', 'Tasmania', 0),
  ('ACT', 'Australian Capital Territory', 1), ('NT', 'Northern Territory', 1), ('AUS', 'Australia (National)', 0))""",
)
register(
    "k05_k07_k08_exports",
    """
WITH r AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT day, flag, n, true AS within_cap, count(*) OVER () AS overwritten_rows FROM r""",
)
register(
    "k06_k09_g12_loads_that_change_nothing",
    """
WITH r AS (SELECT DISTINCT year(o_orderdate), o_orderpriority FROM orders),
live AS (SELECT (SELECT count(*) FROM r) + (SELECT count(*) FROM nation) AS n)
SELECT a AS attempt, a = 'dry run' AS accepted, CASE WHEN a = 'dry run' THEN 2 * (SELECT count(*) FROM r) END AS rows, n AS rows_live
FROM live, (VALUES ('dry run'), ('short load'), ('repeated keys'), ('half a release')) AS t(a)""",
)
register(
    "u04_missing_tables_and_columns",
    "SELECT kind, name, (SELECT count(*) FROM orders) AS orders_loaded FROM (VALUES ('table', 'by_segment'), ('column', 'state_code')) AS t(kind, name)",
)
register(
    "g17_load_gate_of_a_dry_run",
    "WITH s AS (SELECT event_type, 5 * count(*) >= (SELECT count(*) FROM events) AS ok FROM events GROUP BY 1) "
    "SELECT count(*) FILTER (NOT ok) = 0 AS passed, coalesce(string_agg(event_type, ',' ORDER BY event_type) FILTER (NOT ok), '') AS blocking FROM s",
)
register(
    "r16_two_grains_apart",
    with_(M_ENROL, M_ENROL_DETAILED)
    + """
SELECT 'fact_student_enrolment' AS table_name, count(*) AS rows, CAST(sum(ytd_enrolments) AS BIGINT) AS ytd FROM m_enrol
UNION ALL SELECT 'fact_student_enrolment_detailed', count(*), CAST(sum(ytd_enrolments) AS BIGINT) FROM m_enrol_detailed""",
)
register("p06_where_data_begins", "SELECT CAST(year(o_orderdate) AS VARCHAR) AS sheet, CAST(year(o_orderdate) % 10 + min(month(o_orderdate)) - 1 AS INTEGER) AS data_start FROM orders GROUP BY year(o_orderdate)")
register(
    "p08_p09_p14_p15_columns_of_a_frame",
    "SELECT l_returnflag AS flag, l_linestatus, sum(l_quantity) AS quantity, CAST(2.5 AS DOUBLE) AS price FROM lineitem GROUP BY 1, 2",
)
register(
    "p10_p11_p19_roles_of_columns",
    """
WITH r(table_name, column_name, role, is_measure) AS (VALUES
  ('lineitem', 'l_orderkey', 'key', false), ('lineitem', 'l_partkey', 'key', false), ('lineitem', 'l_suppkey', 'key', false), ('lineitem', 'l_extendedprice', 'price', false),
  ('lineitem', 'l_returnflag', 'flag', false), ('lineitem', 'l_shipdate', 'date', false), ('orders', 'o_orderkey', 'key', false), ('orders', 'o_custkey', 'key', false),
  ('orders', 'o_orderstatus', 'flag', false), ('orders', 'o_totalprice', 'price', true), ('orders', 'o_orderdate', 'date', false),
  ('customer', 'c_custkey', 'key', true), ('customer', 'c_nationkey', 'key', false), ('customer', 'c_acctbal', 'price', false)),
n AS (SELECT 'lineitem' AS table_name, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer)
SELECT table_name, column_name, role, is_measure, false AS is_long, n FROM r JOIN n USING (table_name)""",
)
register(
    "p17_p18_context_of_file_names",
    """
WITH f AS (SELECT CAST(month(o_orderdate) AS VARCHAR) AS m, CAST(year(o_orderdate) AS VARCHAR) AS y, o_orderpriority[1] AS k FROM orders),
c AS (
  SELECT m || '-' || y || '-190_Invited_English_State_Groups.csv' AS file, lpad(m, 2, '0') || '/' || y AS as_at_month, '190' AS visa_type, 'Invited' AS eoi_status,
         'English_State_Groups' AS source_view, 'English Test Score' AS dimension_1_name, 'State_Groups' AS dimension_2_name FROM f WHERE k = '1'
  UNION ALL SELECT lpad(m, 2, '0') || '_' || y || '_491_Submitted.csv', lpad(m, 2, '0') || '/' || y, '491', 'Submitted', lpad(m, 2, '0') || '_' || y || '_491_Submitted',
         lpad(m, 2, '0'), y || '_491_Submitted' FROM f WHERE k = '2'
  UNION ALL SELECT 'export_' || y || '_All_Lodged_ProfYear.csv', y, 'All', 'Lodged', 'ProfYear', 'Professional Year', 'Unknown' FROM f WHERE k = '3'
  UNION ALL SELECT 'Occupations_' || y || '.v2.csv', NULL, NULL, NULL, 'Occupations_' || y || '.v2', 'Occupations', y || '.v2' FROM f WHERE k = '4'
  UNION ALL SELECT y || '_189.csv', y, '189', NULL, y || '_189', y, '189' FROM f WHERE k = '5')
SELECT *, count(*) AS n FROM c GROUP BY ALL""",
)
register(
    "x24_b11_newest_complete_release",
    """
WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL),
c AS (SELECT y, m FROM m QUALIFY n >= avg(n) OVER (PARTITION BY y))
SELECT CAST(y AS INTEGER) AS page_id, CAST(max(m) AS INTEGER) AS month, 'https://releases.example.org/download/' || max(m) || '/all/xlsx' AS url, y = (SELECT max(y) FROM c) AS newest_of_all
FROM c GROUP BY y""",
)
register(
    "s08_sheets_by_entity",
    """
WITH w AS (SELECT ['Institutions', 'Course Locations', 'Courses', 'Locations', 'Notes', 'PROVIDER list', 'course-location (2)'][p_size % 7 + 1] AS sheet FROM part)
SELECT sheet, CASE sheet WHEN 'Institutions' THEN 'provider' WHEN 'Course Locations' THEN 'course_location' WHEN 'Courses' THEN 'course' WHEN 'Locations' THEN 'location'
       WHEN 'PROVIDER list' THEN 'provider' WHEN 'course-location (2)' THEN 'course' END AS entity, count(*) AS n FROM w GROUP BY ALL""",
)
