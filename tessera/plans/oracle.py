"""Oracle SQL (DuckDB dialect) for every SQL-checkable registered query.

The cube is rebuilt independently in SQL from the driver's views
(lineitem, orders, customer, nation) as a chain of CTEs; each query appends
its own SELECT. Conventions match the Spark side: dates as ISO strings,
counts BIGINT, computed doubles rounded to 6 places.
"""

from __future__ import annotations

import math
import re

from tessera import contract as K


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return ", ".join(_q(x) for x in items)


_BANDS_VALUES = ", ".join(
    [f"({_q(K.BAND_ALL)}, NULL, NULL, NULL)"]
    + [f"({_q(lbl)}, {lo}, {hi}, {i})" for i, (lbl, lo, hi) in enumerate(K.EXCLUSIVE_BANDS)]
    + [f"({_q(lbl)}, {lo}, {hi}, NULL)" for lbl, lo, hi in K.OVERLAP_BANDS]
)

MEAS = K.MEASURES  # a, total, b, overlap, c, union_cnt
_SMALL = {m: f"(geo <> {_q(K.GEO_ALL)} AND {m} BETWEEN {K.SUPPRESS_LO} AND {K.SUPPRESS_HI})" for m in MEAS}

CUBE_CTES = f"""
bands(band, lo, hi, ordinal) AS (VALUES {_BANDS_VALUES}),
li AS (
  SELECT n.n_name AS geo_name,
         (n.n_name = {_q(K.NESTED_PARENT)} AND c.c_mktsegment = {_q(K.NESTED_SEGMENT)}) AS nested,
         l.l_linestatus AS ls,
         CAST(l.l_quantity AS INTEGER) AS q,
         CAST(l.l_shipdate AS DATE) AS d,
         CAST(l.l_returnflag = {_q(K.RETURNFLAG_A)} AS INTEGER) AS fa,
         CAST(l.l_discount >= {K.DISCOUNT_B_MIN} AS INTEGER) AS fb,
         CAST(l.l_tax >= {K.TAX_C_MIN} AS INTEGER) AS fc
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bounds AS (
  SELECT CAST(date_trunc('month', min(d)) AS DATE) AS min_m,
         CAST(date_trunc('month', max(d)) AS DATE) AS max_m,
         max(d) AS max_d
  FROM li
),
fine AS MATERIALIZED (
  SELECT geo_name, nested, ls, q, CAST(date_trunc('month', d) AS DATE) AS m,
         sum(fa) AS a, count(*) AS total, sum(fb) AS b, sum(fa * fb) AS overlap, sum(fc) AS c,
         sum(greatest(fa, fb, fc)) AS union_cnt
  FROM li GROUP BY ALL
),
e_geo AS (
  SELECT *, geo_name AS geo FROM fine
  UNION ALL SELECT *, {_q(K.GEO_ALL)} FROM fine
  UNION ALL SELECT *, {_q(K.GEO_NESTED)} FROM fine WHERE nested
),
e_sex AS (
  SELECT *, {_q(K.SEX_ALL)} AS sex FROM e_geo
  UNION ALL SELECT *, ls FROM e_geo
),
e_band AS (
  SELECT e.geo, e.sex, e.m, b.band, {", ".join(f"sum(e.{m}) AS {m}" for m in MEAS)} FROM e_sex e JOIN bands b
    ON b.band = {_q(K.BAND_ALL)} OR (e.q BETWEEN b.lo AND b.hi)
  GROUP BY ALL
),
e_period AS (
  SELECT *, {_q(K.GRAIN_MONTH)} AS grain, m AS pkey FROM e_band
  UNION ALL SELECT *, {_q(K.GRAIN_YEAR)}, CAST(date_trunc('year', m) AS DATE) FROM e_band
  UNION ALL SELECT *, {_q(K.GRAIN_TOTAL)}, CAST(NULL AS DATE) FROM e_band
),
cells AS (
  SELECT grain, pkey, geo, sex, band, {", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS)}
  FROM e_period GROUP BY grain, pkey, geo, sex, band
),
periods AS (
  SELECT {_q(K.GRAIN_MONTH)} AS grain, CAST(m AS DATE) AS pkey
    FROM bounds, generate_series(CAST(min_m AS TIMESTAMP), CAST(max_m AS TIMESTAMP), INTERVAL 1 MONTH) t(m)
  UNION ALL
  SELECT {_q(K.GRAIN_YEAR)}, make_date(CAST(y AS INTEGER), 1, 1)
    FROM bounds, generate_series(year(min_m), year(max_m)) t(y)
  UNION ALL SELECT {_q(K.GRAIN_TOTAL)}, CAST(NULL AS DATE)
),
geos AS (
  SELECT n_name AS geo FROM nation
  UNION ALL SELECT {_q(K.GEO_ALL)} UNION ALL SELECT {_q(K.GEO_NESTED)}
),
sexes(sex) AS (VALUES {", ".join(f"({_q(s)})" for s in K.SEXES)}),
grid AS (
  SELECT p.grain, p.pkey, g.geo, s.sex, b.band FROM periods p, geos g, sexes s, bands b
),
dense AS (
  SELECT g.grain, g.pkey, g.geo, g.sex, g.band,
         {", ".join(f"coalesce(c.{m}, 0) AS {m}" for m in MEAS)}
  FROM grid g LEFT JOIN cells c
    ON g.grain = c.grain AND g.pkey IS NOT DISTINCT FROM c.pkey AND g.geo = c.geo
   AND g.sex = c.sex AND g.band = c.band
),
cube AS MATERIALIZED (
  SELECT CAST(bounds.max_d + {K.AS_OF_LAG_DAYS} AS DATE) AS data_as_of,
         coalesce(pkey, bounds.min_m) AS start_date,
         least(CASE grain WHEN {_q(K.GRAIN_MONTH)} THEN last_day(pkey)
                          WHEN {_q(K.GRAIN_YEAR)} THEN make_date(year(pkey), 12, 31)
                          ELSE bounds.max_d END, bounds.max_d) AS end_date,
         grain,
         CASE WHEN grain <> {_q(K.GRAIN_TOTAL)} THEN CAST(year(pkey) AS INTEGER) END AS year,
         CASE WHEN grain = {_q(K.GRAIN_MONTH)} THEN CAST(month(pkey) AS INTEGER) END AS month,
         geo, sex, band,
         {", ".join(f"CASE WHEN {_SMALL[m]} THEN NULL ELSE {m} END AS {m}" for m in MEAS)},
         CASE WHEN {" OR ".join(_SMALL[m] for m in MEAS)} THEN {_q(K.FOOTNOTE)} END AS footnote
  FROM dense, bounds
),
clean AS MATERIALIZED (
  SELECT data_as_of, start_date, end_date, grain, year, month, geo, sex, band,
         {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEAS)},
         footnote,
         {", ".join(f"({m} IS NULL AND footnote IS NOT NULL) AS {m}_suppressed" for m in MEAS)},
         ({" OR ".join(f"({m} IS NULL AND footnote IS NOT NULL)" for m in MEAS)}) AS has_suppression,
         CASE WHEN grain = {_q(K.GRAIN_MONTH)} THEN coalesce(end_date < last_day(start_date), false)
              WHEN grain = {_q(K.GRAIN_YEAR)} THEN coalesce(end_date < make_date(year, 12, 31), false)
              ELSE false END AS is_partial_period,
         CASE WHEN total > 0 THEN CAST(a AS DOUBLE) / total END AS a_share_of_total
  FROM cube
),
dom AS (SELECT * FROM clean WHERE geo NOT IN ({_list(K.GEO_EXCLUDED)})),
nat_month AS (
  SELECT * FROM clean WHERE grain = {_q(K.GRAIN_MONTH)} AND geo = {_q(K.GEO_ALL)}
    AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} AND NOT is_partial_period
),
geo_tot AS (
  SELECT * FROM dom WHERE grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}
),
nat_bands AS (
  SELECT c.*, b.ordinal FROM clean c JOIN bands b USING (band)
  WHERE c.grain = {_q(K.GRAIN_TOTAL)} AND c.geo = {_q(K.GEO_ALL)} AND c.sex = {_q(K.SEX_ALL)}
    AND b.ordinal IS NOT NULL
),
series AS (
  SELECT geo, start_date, month, a, total, b,
         coalesce(a, {K.MIDPOINT}) AS a_f, coalesce(total, {K.MIDPOINT}) AS total_f, coalesce(b, {K.MIDPOINT}) AS b_f
  FROM dom WHERE grain = {_q(K.GRAIN_MONTH)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}
    AND NOT is_partial_period
),
lagged AS (
  SELECT geo, start_date, month, a,
         lag(a_f, 1) OVER w AS lag1_a, lag(a_f, 2) OVER w AS lag2_a, lag(a_f, 3) OVER w AS lag3_a,
         CASE WHEN count(a_f) OVER w3 = 3 THEN avg(a_f) OVER w3 END AS rolling3_a,
         lag(total_f, 1) OVER w AS lag1_total, lag(b_f, 1) OVER w AS lag1_b,
         sin({2 * math.pi!r} * month / 12.0) AS month_sin,
         cos({2 * math.pi!r} * month / 12.0) AS month_cos,
         CAST((year(start_date) - {K.BASE_YEAR}) * 12 + month(start_date) - 1 AS INTEGER) AS time_index
  FROM series
  WINDOW w AS (PARTITION BY geo ORDER BY start_date),
         w3 AS (PARTITION BY geo ORDER BY start_date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
),
panel AS (
  SELECT * FROM lagged
  WHERE lag1_a IS NOT NULL AND lag2_a IS NOT NULL AND lag3_a IS NOT NULL AND rolling3_a IS NOT NULL
    AND lag1_total IS NOT NULL AND lag1_b IS NOT NULL AND a IS NOT NULL
),
test_rows AS (
  SELECT *, CASE WHEN rolling3_a IS NOT NULL THEN greatest(rolling3_a, 0.0) END AS prediction
  FROM panel WHERE start_date BETWEEN DATE '{K.TEST_START}' AND DATE '{K.TEST_END}'
),
lagged_total AS (
  SELECT geo, start_date, month, total,
         lag(total_f, 1) OVER w AS lag1_total, lag(total_f, 2) OVER w AS lag2_total, lag(total_f, 3) OVER w AS lag3_total,
         CASE WHEN count(total_f) OVER w3 = 3 THEN avg(total_f) OVER w3 END AS rolling3_total,
         lag(b_f, 1) OVER w AS lag1_b,
         sin({2 * math.pi!r} * month / 12.0) AS month_sin,
         cos({2 * math.pi!r} * month / 12.0) AS month_cos,
         CAST((year(start_date) - {K.BASE_YEAR}) * 12 + month(start_date) - 1 AS INTEGER) AS time_index
  FROM series
  WINDOW w AS (PARTITION BY geo ORDER BY start_date),
         w3 AS (PARTITION BY geo ORDER BY start_date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
),
panel_total AS (
  SELECT * FROM lagged_total
  WHERE lag1_total IS NOT NULL AND lag2_total IS NOT NULL AND lag3_total IS NOT NULL AND rolling3_total IS NOT NULL
    AND lag1_b IS NOT NULL AND total IS NOT NULL
),
test_rows_total AS (
  SELECT *, CASE WHEN rolling3_total IS NOT NULL THEN greatest(rolling3_total, 0.0) END AS prediction
  FROM panel_total WHERE start_date BETWEEN DATE '{K.TEST_START}' AND DATE '{K.TEST_END}'
),
profile_wide AS (
  SELECT geo,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN a END) AS a,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN total END) AS total,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN b END) AS b,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN overlap END) AS overlap,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN c END) AS c,
    CASE WHEN count(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band IN ({_list(K.SENIOR_BANDS)}) THEN a END) >= {len(K.SENIOR_BANDS)}
         THEN sum(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band IN ({_list(K.SENIOR_BANDS)}) THEN a END) END AS senior_a,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_PARTS[0])} AND band = {_q(K.BAND_ALL)} THEN a END) AS a_p0,
    max(CASE WHEN grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_PARTS[1])} AND band = {_q(K.BAND_ALL)} THEN a END) AS a_p1,
    {", ".join(f"max(CASE WHEN grain = {_q(K.GRAIN_YEAR)} AND year = {y} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)} THEN a END) AS a_y{i}" for i, y in enumerate(K.PROFILE_YEARS))}
  FROM dom WHERE grain IN ({_q(K.GRAIN_TOTAL)}, {_q(K.GRAIN_YEAR)})
  GROUP BY geo
),
profile AS (
  SELECT geo,
    100.0 * a / nullif(total, 0) AS a_pct_total,
    100.0 * b / nullif(total, 0) AS b_pct_total,
    100.0 * overlap / nullif(a, 0) AS overlap_pct_a,
    100.0 * c / nullif(total, 0) AS c_pct_total,
    100.0 * senior_a / nullif(a, 0) AS senior_a_pct,
    100.0 * a_p0 / nullif(a_p0 + a_p1, 0) AS f_a_pct,
    100.0 * a_y1 / nullif(coalesce(a_y0, 0) + coalesce(a_y1, 0) + coalesce(a_y2, 0), 0) AS year_mid_pct
  FROM profile_wide
),
profile_grp AS (
  SELECT p.*, n.n_regionkey AS grp FROM profile p JOIN nation n ON p.geo = n.n_name
)
"""

FEATURES = ["a_pct_total", "b_pct_total", "overlap_pct_a", "c_pct_total", "senior_a_pct", "f_a_pct", "year_mid_pct"]


def _r(expr: str, n: int = 6) -> str:
    return f"round({expr}, {n})"


def _iso(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS VARCHAR) AS {alias or c}"


def _metrics(y: str, p: str) -> str:
    e = f"({y} - greatest({p}, 0.0))"
    return (f"CAST(count({y}) AS BIGINT) AS n, avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse, "
            f"1 - sum({e} * {e}) / nullif(var_pop({y}) * count({y}), 0) AS r2, "
            f"100.0 * sum(abs({e})) / nullif(sum({y}), 0) AS wape_pct")


_KEYS = "grain, year, month, geo, sex, band"

SQL_BODIES: dict[str, str] = {
    "scan_text_cube": f"""
SELECT strftime(data_as_of, '%m/%d/%Y') AS "Data As Of", strftime(start_date, '%m/%d/%Y') AS "Start Date",
       strftime(end_date, '%m/%d/%Y') AS "End Date", grain AS "Group",
       CAST(year AS VARCHAR) AS "Year", CAST(month AS VARCHAR) AS "Month", geo AS "Geo", sex AS "Sex", band AS "Band",
       {", ".join(f"CASE WHEN {m} IS NULL THEN NULL ELSE format('{{:,}}', {m}) END AS " + '"' + h + '"'
                  for m, h in zip(MEAS, ["A Count", "Total Count", "B Count", "A and B Count", "C Count", "A, B, or C Count"]))},
       footnote AS "Footnote"
FROM cube""",
    "source_profile": "SELECT CAST(count(*) AS BIGINT) AS raw_rows, CAST(16 AS BIGINT) AS raw_columns FROM cube",
    "clean_types": f"""
SELECT {_iso("data_as_of")}, {_iso("start_date")}, {_iso("end_date")}, grain, year, month, geo, sex, band,
       {", ".join(MEAS)}, footnote, {", ".join(m + "_suppressed" for m in MEAS)},
       has_suppression, is_partial_period, a_share_of_total
FROM clean""",
    "suppression_flags": f"SELECT {_KEYS}, {', '.join(m + '_suppressed' for m in MEAS)}, has_suppression FROM clean",
    "partial_period": f"""
SELECT {_KEYS}, {_iso("start_date")}, {_iso("end_date")}, CAST(last_day(start_date) AS VARCHAR) AS month_end,
       CAST(CASE WHEN year IS NOT NULL THEN make_date(year, 12, 31) END AS VARCHAR) AS year_end, is_partial_period
FROM clean""",
    "safe_share": f"SELECT {_KEYS}, a, total, a_share_of_total FROM clean",
    "grain_slice": f"""
SELECT geo, year, {_iso("start_date")}, {_iso("end_date")}, {", ".join(MEAS)}, is_partial_period
FROM dom WHERE grain = {_q(K.GRAIN_YEAR)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}
  AND year IN (1996, 1997, 1998)""",
    "national_monthly": f"SELECT {_iso('start_date')}, a, total, {_r('100.0 * a / total')} AS a_pct_total FROM nat_month",
    "national_totals": f"""
SELECT a, total, round(a_share_of_total * 100, 2) AS a_share_pct FROM clean
WHERE grain = {_q(K.GRAIN_TOTAL)} AND geo = {_q(K.GEO_ALL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}""",
    "geo_domain": "SELECT DISTINCT geo FROM dom",
    "domain_semi_join": f""",
domain AS MATERIALIZED (SELECT n_name AS geo FROM nation)
SELECT clean.geo, {_iso('start_date')}, a, total FROM clean JOIN domain ON clean.geo = domain.geo
WHERE grain = {_q(K.GRAIN_MONTH)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}""",
    "quality_summary": f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(min(data_as_of) AS VARCHAR) AS data_as_of,
       CAST(min(start_date) AS VARCHAR) AS start_min, CAST(max(end_date) AS VARCHAR) AS end_max,
       CAST(count(DISTINCT geo) AS BIGINT) AS n_geos, CAST(count(DISTINCT sex) AS BIGINT) AS n_sexes,
       CAST(count(DISTINCT band) AS BIGINT) AS n_bands, CAST(count(footnote) AS BIGINT) AS footnoted_rows,
       CAST(count(*) FILTER (WHERE footnote IS NULL) AS BIGINT) AS fully_observed_rows,
       CAST(count(*) FILTER (WHERE is_partial_period) AS BIGINT) AS partial_period_rows,
       CAST(count(*) FILTER (WHERE grain = {_q(K.GRAIN_MONTH)}) AS BIGINT) AS month_rows,
       CAST(count(*) FILTER (WHERE grain = {_q(K.GRAIN_YEAR)}) AS BIGINT) AS year_rows,
       CAST(count(*) FILTER (WHERE grain = {_q(K.GRAIN_TOTAL)}) AS BIGINT) AS total_rows
FROM clean""",
    "value_counts": """
SELECT 'grain' AS field, grain AS value, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY grain
UNION ALL
SELECT 'footnote', footnote, CAST(count(*) AS BIGINT) FROM clean GROUP BY footnote""",
    "duplicate_audit": f"""
SELECT (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM cube GROUP BY ALL_COLS)) AS exact_duplicates,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM cube GROUP BY {_KEYS})) AS key_duplicates""".replace(
        "GROUP BY ALL_COLS", "GROUP BY data_as_of, start_date, end_date, " + _KEYS + ", " + ", ".join(MEAS) + ", footnote"),
    "missingness": " UNION ALL ".join(
        f"SELECT {_q(m)} AS field, CAST(count(*) FILTER (WHERE {m} IS NULL) AS BIGINT) AS missing_count, "
        f"{_r(f'100.0 * count(*) FILTER (WHERE {m} IS NULL) / count(*)')} AS missing_percent FROM clean"
        for m in MEAS),
    "rule_audit": f"""
SELECT CAST({" + ".join(f"count(*) FILTER (WHERE {m} < 0)" for m in MEAS)} AS BIGINT) AS negative_counts,
       CAST(count(*) FILTER (WHERE a > total) AS BIGINT) AS a_gt_total,
       CAST(count(*) FILTER (WHERE b > total) AS BIGINT) AS b_gt_total,
       CAST(count(*) FILTER (WHERE c > total) AS BIGINT) AS c_gt_total,
       CAST(count(*) FILTER (WHERE overlap > a) AS BIGINT) AS overlap_gt_a,
       CAST(count(*) FILTER (WHERE overlap > b) AS BIGINT) AS overlap_gt_b,
       CAST(count(*) FILTER (WHERE union_cnt < (SELECT max(v) FROM (VALUES (a), (b), (c)) t(v))) AS BIGINT) AS union_lt_components,
       CAST(count(*) FILTER (WHERE start_date > end_date) + count(*) FILTER (WHERE end_date > data_as_of) AS BIGINT) AS invalid_dates
FROM clean""",
    "band_reconcile": f"""
SELECT grain, {_iso('start_date')}, geo, sex,
       sum(CASE WHEN band IN ({_list(K.EXCLUSIVE_BAND_LABELS)}) THEN total END) AS bands_sum,
       max(CASE WHEN band = {_q(K.BAND_ALL)} THEN total END) AS all_value,
       max(CASE WHEN band = {_q(K.BAND_ALL)} THEN total END)
         - sum(CASE WHEN band IN ({_list(K.EXCLUSIVE_BAND_LABELS)}) THEN total END) AS diff
FROM clean WHERE geo = {_q(K.GEO_ALL)} AND (band IN ({_list(K.EXCLUSIVE_BAND_LABELS)}) OR band = {_q(K.BAND_ALL)})
GROUP BY grain, start_date, geo, sex""",
    "iqr_bounds": f"""
SELECT {_r('q1')} AS q1, {_r('q3')} AS q3, {_r('q3 - q1')} AS iqr, {_r('q3 + 1.5 * (q3 - q1)')} AS fence
FROM (SELECT quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.75) AS q3 FROM geo_tot)""",
    "iqr_flags": """
SELECT geo, a, round(fence, 6) AS fence, a > fence AS iqr_flag
FROM geo_tot, (SELECT q3 + 1.5 * (q3 - q1) AS fence
               FROM (SELECT quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.75) AS q3 FROM geo_tot))""",
    "senior_share": f"""
SELECT senior_a, bands_a, {_r('100.0 * senior_a / bands_a')} AS senior_share_pct
FROM (SELECT sum(CASE WHEN band IN ({_list(K.SENIOR_BANDS)}) THEN a END) AS senior_a, sum(a) AS bands_a FROM nat_bands)""",
    "age_profile": f"""
SELECT band, ordinal, a, total, {_r('100.0 * a / sum(a) OVER ()')} AS share_a, {_r('100.0 * a / total')} AS a_pct_total
FROM nat_bands""",
    "min_count_sum": f"""
SELECT geo, CASE WHEN count(a) >= {len(K.SENIOR_BANDS)} THEN sum(a) END AS senior_a, CAST(count(a) AS BIGINT) AS n_obs
FROM dom WHERE grain = {_q(K.GRAIN_TOTAL)} AND sex = {_q(K.SEX_ALL)} AND band IN ({_list(K.SENIOR_BANDS)})
GROUP BY geo""",
    "extremes": f"""
SELECT (SELECT CAST(start_date AS VARCHAR) FROM nat_month WHERE a IS NOT NULL ORDER BY a DESC, start_date LIMIT 1) AS peak_month,
       (SELECT max(a) FROM nat_month) AS peak_a,
       (SELECT CAST(start_date AS VARCHAR) FROM nat_month WHERE a IS NOT NULL ORDER BY a ASC, start_date LIMIT 1) AS low_month,
       (SELECT min(a) FROM nat_month) AS low_a,
       (SELECT band FROM nat_bands WHERE a IS NOT NULL ORDER BY a DESC, ordinal LIMIT 1) AS max_band,
       (SELECT band FROM nat_bands WHERE a IS NOT NULL AND total <> 0 ORDER BY 100.0 * a / total DESC, ordinal LIMIT 1) AS max_pct_band,
       (SELECT geo FROM geo_tot WHERE a IS NOT NULL AND total <> 0 ORDER BY 100.0 * a / total DESC, geo LIMIT 1) AS max_share_geo,
       (SELECT geo FROM geo_tot WHERE a IS NOT NULL AND total <> 0 ORDER BY 100.0 * a / total ASC, geo LIMIT 1) AS min_share_geo""",
    "geo_share": f"SELECT geo, a, total, {_r('100.0 * a / total')} AS a_pct_total FROM geo_tot",
    "geo_share_stats": f"""
SELECT {_r('max(s)')} AS max_share, {_r('min(s)')} AS min_share, {_r('median(s)')} AS median_share,
       {_r('max(s) - min(s)')} AS range_points,
       arg_max(geo, s) AS max_geo, arg_min(geo, s) AS min_geo
FROM (SELECT geo, 100.0 * a / total AS s FROM geo_tot)""",
    "sex_age_pivot": f"""
SELECT geo, {", ".join(f"max(CASE WHEN sex = {_q(s)} THEN a END) AS a_{s}" for s in K.SEXES)},
       {_r(f"100.0 * max(CASE WHEN sex = {_q(K.SEX_PARTS[0])} THEN a END) / (max(CASE WHEN sex = {_q(K.SEX_PARTS[0])} THEN a END) + max(CASE WHEN sex = {_q(K.SEX_PARTS[1])} THEN a END))")} AS p0_share
FROM dom WHERE grain = {_q(K.GRAIN_TOTAL)} AND band = {_q(K.BAND_ALL)} GROUP BY geo""",
    "sex_age_ratio": f"""
SELECT b.band, b.ordinal, p.a_{K.SEX_PARTS[0]}, p.a_{K.SEX_PARTS[1]},
       {_r(f"p.a_{K.SEX_PARTS[1]} / nullif(p.a_{K.SEX_PARTS[0]}, 0)")} AS p1_to_p0
FROM bands b LEFT JOIN (
  SELECT band, {", ".join(f"max(CASE WHEN sex = {_q(s)} THEN a END) AS a_{s}" for s in K.SEX_PARTS)}
  FROM clean WHERE grain = {_q(K.GRAIN_TOTAL)} AND geo = {_q(K.GEO_ALL)} GROUP BY band) p USING (band)
WHERE b.ordinal IS NOT NULL""",
    "sex_age_long": f"""
SELECT band, sex, a FROM clean
WHERE grain = {_q(K.GRAIN_TOTAL)} AND geo = {_q(K.GEO_ALL)} AND sex IN ({_list(K.SEX_PARTS)})
  AND band IN ({_list(K.EXCLUSIVE_BAND_LABELS)})""",
    "spearman_matrix": f"""
SELECT x, y, {_r('corr(rx, ry)')} AS rho FROM (
  SELECT x, y,
         rank() OVER (PARTITION BY x, y ORDER BY xv) + (count(*) OVER (PARTITION BY x, y, xv) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY x, y ORDER BY yv) + (count(*) OVER (PARTITION BY x, y, yv) - 1) / 2.0 AS ry
  FROM (SELECT l1.name AS x, l2.name AS y, l1.v AS xv, l2.v AS yv
        FROM (UNPIVOT (SELECT start_date, {", ".join(MEAS)} FROM nat_month) ON {", ".join(MEAS)} INTO NAME name VALUE v) l1
        JOIN (UNPIVOT (SELECT start_date, {", ".join(MEAS)} FROM nat_month) ON {", ".join(MEAS)} INTO NAME name VALUE v) l2
          USING (start_date)
        WHERE l1.v IS NOT NULL AND l2.v IS NOT NULL))
GROUP BY x, y""",
    "histogram18": """
SELECT bins.bin, round(lo + bins.bin * (hi - lo) / 18, 6) AS bin_lo, round(lo + (bins.bin + 1) * (hi - lo) / 18, 6) AS bin_hi,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM (SELECT min(a) AS lo, max(a) AS hi FROM geo_tot) s
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(18)) bins
LEFT JOIN (
  SELECT CASE WHEN hi > lo THEN least(CAST(floor((a - lo) * 18 / (hi - lo)) AS INTEGER), 17) ELSE 0 END AS bin, count(*) AS n
  FROM geo_tot, (SELECT min(a) AS lo, max(a) AS hi FROM geo_tot) s2
  WHERE a IS NOT NULL GROUP BY 1) cnt ON cnt.bin = bins.bin""",
    "decline_from_peak": """
SELECT CAST(pk.start_date AS VARCHAR) AS peak_month, pk.a AS peak_a, CAST(ls.start_date AS VARCHAR) AS last_month, ls.a AS last_a,
       round(100.0 * (pk.a - ls.a) / pk.a, 6) AS decline_pct
FROM (SELECT start_date, a FROM nat_month WHERE a IS NOT NULL ORDER BY a DESC, start_date LIMIT 1) pk,
     (SELECT start_date, a FROM nat_month ORDER BY start_date DESC LIMIT 1) ls""",
    "top_share": f"SELECT geo, {_r('100.0 * a / total')} AS a_pct_total FROM geo_tot ORDER BY 100.0 * a / total DESC, geo LIMIT 15",
    "geo_profile": f"SELECT geo, {', '.join(_r(f) + ' AS ' + f for f in FEATURES)} FROM profile",
    "standardize": f"""
SELECT geo, {", ".join(f"{_r(f'(p.{f} - s.m_{f}) / s.s_{f}')} AS {f}" for f in FEATURES)}
FROM profile p, (SELECT {", ".join(f"avg({f}) AS m_{f}, CASE WHEN coalesce(stddev_pop({f}), 0) = 0 THEN 1 ELSE stddev_pop({f}) END AS s_{f}" for f in FEATURES)} FROM profile) s""",
    "group_profile": f"SELECT grp, CAST(count(*) AS BIGINT) AS size, {', '.join(_r(f'avg({f})') + ' AS ' + f for f in FEATURES)} FROM profile_grp GROUP BY grp",
    "group_profile_z": f"""
SELECT g.grp, {", ".join(f"{_r(f'(g.{f} - o.{f}) / nullif(o.s_{f}, 0)')} AS {f}" for f in FEATURES)}
FROM (SELECT grp, {", ".join(f"avg({f}) AS {f}" for f in FEATURES)} FROM profile_grp GROUP BY grp) g,
     (SELECT {", ".join(f"avg({f}) AS {f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)} FROM profile_grp) o""",
    "group_members": "SELECT grp, string_agg(geo, ', ' ORDER BY geo) AS members_text FROM profile_grp GROUP BY grp",
    "relabel_groups": """
SELECT p.geo, p.grp AS old_group, CAST(r.new_group AS INTEGER) AS new_group FROM profile_grp p JOIN (
  SELECT grp, row_number() OVER (ORDER BY m ASC NULLS LAST, grp) - 1 AS new_group
  FROM (SELECT grp, avg(a_pct_total) AS m FROM profile_grp GROUP BY grp)) r USING (grp)""",
    "lag_panel": f"""
SELECT geo, {_iso('start_date')}, a, lag1_a, lag2_a, lag3_a, rolling3_a, lag1_total, lag1_b,
       round(month_sin, 9) AS month_sin, round(month_cos, 9) AS month_cos, time_index FROM panel""",
    "log_target": f"SELECT geo, {_iso('start_date')}, a, round(ln(1 + a), 9) AS log_target FROM panel",
    "residual_target": f"SELECT geo, {_iso('start_date')}, a, lag1_a, round(ln(1 + a) - ln(1 + lag1_a), 9) AS residual_target FROM panel",
    "residual_reconstruct": f"""
SELECT geo, {_iso('start_date')}, lag1_a, rolling3_a,
       round(greatest(exp(ln(1 + lag1_a) + (ln(1 + rolling3_a) - ln(1 + lag1_a))) - 1, 0.0), 6) AS reconstructed FROM panel""",
    "season_features": f"""
SELECT geo, {_iso('start_date')}, CAST(year(start_date) AS INTEGER) AS year, CAST(month(start_date) AS INTEGER) AS month,
       round(sin({2 * math.pi!r} * month / 12.0), 9) AS month_sin, round(cos({2 * math.pi!r} * month / 12.0), 9) AS month_cos,
       CAST((year(start_date) - {K.BASE_YEAR}) * 12 + month(start_date) - 1 AS INTEGER) AS time_index
FROM series""",
    "month_labels": f"""
SELECT {_iso('start_date')}, strftime(start_date, '%B %Y') AS long_label, strftime(start_date, '%b %Y') AS short_label
FROM clean WHERE grain = {_q(K.GRAIN_MONTH)} AND geo = {_q(K.GEO_ALL)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}""",
    "forecast_errors": f"""
SELECT geo, {_iso('start_date')}, a, lag1_a, round(prediction, 6) AS prediction,
       round(abs(a - prediction), 6) AS absolute_error, round(prediction - a, 6) AS error FROM test_rows""",
    "expanding_folds": " UNION ALL ".join(
        f"SELECT {_q(lbl)} AS fold, CAST(count(*) FILTER (WHERE start_date < DATE '{s}') AS BIGINT) AS train_rows, "
        f"CAST(count(*) FILTER (WHERE start_date BETWEEN DATE '{s}' AND DATE '{e}') AS BIGINT) AS validation_rows FROM panel"
        for lbl, s, e in K.FOLDS),
    "time_splits": " UNION ALL ".join(
        f"SELECT {_q(name)} AS split, CAST(count(*) AS BIGINT) AS rows, CAST(min(start_date) AS VARCHAR) AS first_month, "
        f"CAST(max(start_date) AS VARCHAR) AS last_month FROM panel WHERE {cond}"
        for name, cond in [
            ("fit", f"start_date < DATE '{K.FIT_END}'"),
            ("validation", f"start_date BETWEEN DATE '{K.VALID_START}' AND DATE '{K.VALID_END}'"),
            ("test", f"start_date BETWEEN DATE '{K.TEST_START}' AND DATE '{K.TEST_END}'"),
            ("train", f"start_date < DATE '{K.TRAIN_END}'"),
        ]),
    "forecast_monthly": f"""
SELECT {_iso('start_date')}, CAST(count(*) AS BIGINT) AS rows, sum(a) AS actual, round(sum(prediction), 6) AS predicted,
       sum(lag1_a) AS baseline FROM test_rows GROUP BY start_date""",
    "worst_errors": """
SELECT geo || ' ' || strftime(start_date, '%b %Y') AS label, round(a, 1) AS actual, round(prediction, 1) AS pred,
       round(abs(a - prediction), 1) AS abs_error
FROM test_rows ORDER BY abs(a - prediction) DESC, geo || '|' || CAST(start_date AS VARCHAR) LIMIT 10""",
    "baseline_metrics": f"""
SELECT n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(wape_pct, 6) AS wape_pct
FROM (SELECT {_metrics('a', 'lag1_a')} FROM test_rows)""",
    "baseline_vs_mean": f"""
SELECT round(m.mae, 6) AS mean3_mae, round(b.mae, 6) AS persistence_mae, round(100.0 * (b.mae - m.mae) / nullif(b.mae, 0), 6) AS mae_improvement_pct
FROM (SELECT {_metrics('a', 'rolling3_a')} FROM test_rows) m, (SELECT {_metrics('a', 'lag1_a')} FROM test_rows) b""",
    "model_comparison": f"""
SELECT mm.model, mm.n, round(mm.mae, 6) AS mae, round(mm.rmse, 6) AS rmse, round(mm.r2, 6) AS r2,
       round(mm.wape_pct, 6) AS wape_pct, round(100.0 * (b.mae - mm.mae) / nullif(b.mae, 0), 6) AS mae_improvement_pct
FROM (
  SELECT 'persistence' AS model, {_metrics('a', 'lag1_a')} FROM test_rows
  UNION ALL SELECT 'mean3', {_metrics('a', 'rolling3_a')} FROM test_rows
  UNION ALL SELECT 'overall_mean', {_metrics('a', 'tm')} FROM test_rows,
    (SELECT avg(a) AS tm FROM panel WHERE start_date < DATE '{K.TRAIN_END}')
) mm, (SELECT {_metrics('a', 'lag1_a')} FROM test_rows) b""",
    "acceptance": f"""
SELECT m.mae < b.mae AS mae_better, m.rmse < b.rmse AS rmse_better, m.wape_pct < b.wape_pct AS wape_better,
       (m.mae < b.mae AND m.rmse < b.rmse AND m.wape_pct < b.wape_pct) AS accepted
FROM (SELECT {_metrics('a', 'rolling3_a')} FROM test_rows) m, (SELECT {_metrics('a', 'lag1_a')} FROM test_rows) b""",
    "one_hot": f"""
SELECT g.geo, CAST(t.slot AS INTEGER) AS slot, CAST((SELECT count(DISTINCT geo) FROM panel WHERE start_date < DATE '{K.TRAIN_END}') AS INTEGER) AS n_slots
FROM (SELECT DISTINCT geo FROM panel) g
LEFT JOIN (SELECT geo, row_number() OVER (ORDER BY geo) - 1 AS slot
           FROM (SELECT DISTINCT geo FROM panel WHERE start_date < DATE '{K.TRAIN_END}')) t USING (geo)""",
}

# the wide missingness over every clean column
_CLEAN_COLS = (["data_as_of", "start_date", "end_date", "grain", "year", "month", "geo", "sex", "band"] + MEAS
               + ["footnote"] + [m + "_suppressed" for m in MEAS]
               + ["has_suppression", "is_partial_period", "a_share_of_total"])
SQL_BODIES["missingness_all"] = " UNION ALL ".join(
    f"SELECT {_q(c)} AS field, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, "
    f"{_r(f'100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS missing_percent FROM clean"
    for c in _CLEAN_COLS)


def _slice_cond(grain, geos, sexes, bands):
    geo = f"geo IN ({_list(geos)})" if geos else f"geo NOT IN ({_list(K.GEO_EXCLUDED)})"
    return f"grain = {_q(grain)} AND {geo} AND sex IN ({_list(sexes)}) AND band IN ({_list(bands)})"


SQL_BODIES["slice_contract"] = " UNION ALL ".join(
    f"SELECT {_q(n)} AS slice, CAST(count(*) AS BIGINT) AS rows FROM clean WHERE {_slice_cond(g, ge, se, b)}"
    for n, g, ge, se, b in K.SLICES)

_RULES = ["negative_counts", "a_gt_total", "b_gt_total", "c_gt_total", "overlap_gt_a", "overlap_gt_b",
          "union_lt_components", "invalid_dates"]
SQL_BODIES["quality_outcomes"] = (
    "SELECT test, CAST(result AS BIGINT) AS result, result = 0 AS passed FROM ("
    + SQL_BODIES["rule_audit"].strip() + ") UNPIVOT (result FOR test IN (" + ", ".join(_RULES) + "))")

SQL_BODIES["suppression_bounds"] = f"""
SELECT geo,
       sum(coalesce(a, CASE WHEN a_suppressed THEN {float(K.SUPPRESS_LO)} END)) AS lower,
       sum(coalesce(a, CASE WHEN a_suppressed THEN {K.MIDPOINT} END)) AS mid,
       sum(coalesce(a, CASE WHEN a_suppressed THEN {float(K.SUPPRESS_HI)} END)) AS upper,
       CAST(sum(CAST(a_suppressed AS INTEGER)) AS BIGINT) AS suppressed_cells
FROM dom WHERE grain = {_q(K.GRAIN_MONTH)} AND sex = {_q(K.SEX_ALL)} AND band = {_q(K.BAND_ALL)}
GROUP BY geo"""

SQL_BODIES["wape_monitor"] = """
SELECT CAST(start_date AS VARCHAR) AS start_date, round(w, 6) AS wape_2m, round(bw, 6) AS base_wape_2m,
       w > bw + 5 AS suspend
FROM (
  SELECT start_date,
         100.0 * sum(err) OVER w2 / nullif(sum(actual) OVER w2, 0) AS w,
         100.0 * sum(base_err) OVER w2 / nullif(sum(actual) OVER w2, 0) AS bw
  FROM (SELECT start_date, sum(abs(a - prediction)) AS err, sum(abs(a - greatest(lag1_a, 0.0))) AS base_err,
               sum(a) AS actual FROM test_rows GROUP BY start_date)
  WINDOW w2 AS (ORDER BY start_date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))"""

SQL_BODIES["conformal_band"] = f"""
SELECT round(q, 6) AS half_width, CAST(count(*) AS BIGINT) AS test_rows,
       round(avg(CASE WHEN abs(a - greatest(rolling3_a, 0.0)) <= q THEN 1.0 ELSE 0.0 END), 6) AS coverage
FROM panel, (SELECT quantile_cont(abs(a - greatest(rolling3_a, 0.0)), 0.9) AS q FROM panel
             WHERE start_date BETWEEN DATE '{K.VALID_START}' AND DATE '{K.VALID_END}')
WHERE start_date BETWEEN DATE '{K.TEST_START}' AND DATE '{K.TEST_END}'
GROUP BY q"""

SQL_BODIES["national_series"] = f"""
SELECT CAST(c.start_date AS VARCHAR) AS start_date, c.a, c.total, c.is_partial_period,
       coalesce(c.start_date = p.peak, false) AS is_peak
FROM clean c, (SELECT start_date AS peak FROM nat_month WHERE a IS NOT NULL ORDER BY a DESC, start_date LIMIT 1) p
WHERE c.grain = {_q(K.GRAIN_MONTH)} AND c.geo = {_q(K.GEO_ALL)} AND c.sex = {_q(K.SEX_ALL)}
  AND c.band = {_q(K.BAND_ALL)}"""

_EMB = """,
emb AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE label IS NOT NULL
)"""

SQL_BODIES["inertia_by_label"] = _EMB + """,
cent AS (SELECT label, i, avg(v) AS c FROM emb GROUP BY label, i)
SELECT round(sum((e.v - c.c) * (e.v - c.c)), 6) AS inertia,
       CAST(count(DISTINCT e.vec_id) AS BIGINT) AS n_points, CAST(count(DISTINCT e.label) AS BIGINT) AS n_clusters
FROM emb e JOIN cent c USING (label, i)"""

SQL_BODIES["silhouette_sq"] = _EMB + """,
norms AS (SELECT vec_id, label, sum(v * v) AS xx FROM emb GROUP BY vec_id, label),
cs AS (SELECT label, i, sum(v) AS s FROM emb GROUP BY label, i),
cn AS (SELECT label, count(*) AS n, sum(xx) AS q FROM norms GROUP BY label),
dots AS (SELECT e.vec_id, cs.label AS cl, sum(e.v * cs.s) AS dot FROM emb e JOIN cs USING (i) GROUP BY e.vec_id, cs.label),
dd AS (
  SELECT nm.vec_id, nm.label, d.cl, cn.n * nm.xx - 2 * d.dot + cn.q AS dsum, cn.n AS nc
  FROM norms nm JOIN dots d USING (vec_id) JOIN cn ON cn.label = d.cl
),
per AS (
  SELECT vec_id, max(CASE WHEN cl = label AND nc > 1 THEN dsum / (nc - 1) END) AS a,
         min(CASE WHEN cl <> label THEN dsum / nc END) AS b
  FROM dd GROUP BY vec_id
)
SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_sq,
       CAST(count(*) AS BIGINT) AS n_points
FROM per"""


SQL_BODIES["gap_audit"] = """
SELECT geo, CAST(start_date AS VARCHAR) AS start_date, CAST(prev AS VARCHAR) AS prev
FROM (SELECT geo, start_date, lag(start_date) OVER (PARTITION BY geo ORDER BY start_date) AS prev FROM series)
WHERE date_diff('month', prev, start_date) > 1"""

_OBSERVED = "SELECT geo, start_date, a FROM series WHERE a IS NOT NULL"
SQL_BODIES["gap_audit_observed"] = f"""
SELECT geo, CAST(start_date AS VARCHAR) AS start_date, CAST(prev AS VARCHAR) AS prev, CAST(date_diff('month', prev, start_date) - 1 AS INTEGER) AS missing_months
FROM (SELECT geo, start_date, lag(start_date) OVER (PARTITION BY geo ORDER BY start_date) AS prev FROM ({_OBSERVED}))
WHERE date_diff('month', prev, start_date) > 1"""
SQL_BODIES["calendar_lags"] = f""",
o AS ({_OBSERVED}),
r AS (SELECT *, {", ".join(f"lag(a, {k}) OVER w AS row_lag{k}" for k in (1, 2, 3))} FROM o WINDOW w AS (PARTITION BY geo ORDER BY start_date)),
j AS (SELECT r.*, {", ".join(f"o{k}.a AS cal_lag{k}" for k in (1, 2, 3))} FROM r
      {" ".join(f"LEFT JOIN o o{k} ON o{k}.geo = r.geo AND o{k}.start_date = r.start_date - INTERVAL {k} MONTH" for k in (1, 2, 3))})
SELECT geo, CAST(start_date AS VARCHAR) AS start_date, a, {", ".join(f"{p}_lag{k}" for p in ("row", "cal") for k in (1, 2, 3))},
       round((cal_lag1 + cal_lag2 + cal_lag3) / 3, 6) AS cal_rolling3,
       {" OR ".join(f"(row_lag{k} IS NOT NULL AND row_lag{k} IS DISTINCT FROM cal_lag{k})" for k in (1, 2, 3))} AS crosses_gap FROM j"""

_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)
SQL_BODIES["price_quantiles"] = f"""
SELECT l_returnflag, l_linestatus, {", ".join(f"round(quantile_cont(CAST(l_extendedprice AS DOUBLE), {p}), 6) AS q{round(p * 100)}" for p in _PROBS)}
FROM lineitem GROUP BY l_returnflag, l_linestatus"""
SQL_BODIES["fact_rank_correlation"] = """,
f AS (SELECT l_quantity AS q, l_extendedprice AS p, l_discount AS d FROM lineitem),
k AS (SELECT rank() OVER (ORDER BY q) + (count(*) OVER (PARTITION BY q) - 1) / 2.0 AS q, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS p,
             rank() OVER (ORDER BY d) + (count(*) OVER (PARTITION BY d) - 1) / 2.0 AS d FROM f),
c AS (SELECT corr(q, p) AS qp, corr(q, d) AS qd, corr(p, d) AS pd FROM k)
SELECT x, y, round(rho, 6) AS rho FROM (
  SELECT unnest(['l_quantity', 'l_quantity', 'l_quantity', 'l_extendedprice', 'l_extendedprice', 'l_extendedprice', 'l_discount', 'l_discount', 'l_discount']) AS x,
         unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_quantity', 'l_extendedprice', 'l_discount']) AS y,
         unnest([1.0, qp, qd, qp, 1.0, pd, qd, pd, 1.0]) AS rho FROM c)"""

_FOLD_ROWS = " UNION ALL ".join(
    f"SELECT {_q(lbl)} AS fold, abs(a - greatest(rolling3_a, 0.0)) AS resid FROM panel WHERE start_date BETWEEN DATE '{s}' AND DATE '{e}'" for lbl, s, e in K.FOLDS)
SQL_BODIES["conformal_blocks"] = f"""
SELECT w.fold, w.n, w.rank, round(w.half_width, 6) AS half_width, count(*) AS test_rows,
       round(avg(CASE WHEN abs(a - greatest(rolling3_a, 0.0)) <= w.half_width THEN 1.0 ELSE 0.0 END), 6) AS coverage
FROM test_rows, (SELECT fold, n, CAST(ceil((n + 1) * 0.9) AS BIGINT) AS rank, max(CASE WHEN place = ceil((n + 1) * 0.9) THEN resid END) AS half_width
  FROM (SELECT fold, resid, count(*) OVER (PARTITION BY fold) AS n, row_number() OVER (PARTITION BY fold ORDER BY resid) AS place FROM ({_FOLD_ROWS})) GROUP BY fold, n) w
GROUP BY w.fold, w.n, w.rank, w.half_width"""
SQL_BODIES["monthly_errors"] = f"""
SELECT CAST(m.start_date AS VARCHAR) AS start_date, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(wape_pct, 6) AS wape_pct, w.geo AS worst_geo,
       round(w.off, 6) AS worst_error
FROM (SELECT start_date, {_metrics('a', 'prediction')} FROM test_rows GROUP BY start_date) m
JOIN (SELECT start_date, geo, abs(a - prediction) AS off, row_number() OVER (PARTITION BY start_date ORDER BY abs(a - prediction) DESC, geo) AS place FROM test_rows) w
  ON w.start_date = m.start_date AND w.place = 1"""
SQL_BODIES["rule_audit_in_flight"] = SQL_BODIES["rule_audit"]
SQL_BODIES["wape_monitor_stream"] = SQL_BODIES["wape_monitor"]
_SNAPSHOT_KEYS = 'grain AS "Group", CAST(year AS VARCHAR) AS "Year", CAST(month AS VARCHAR) AS "Month", {0} AS "Geo", sex AS "Sex", band AS "Band"'
SQL_BODIES["snapshot_diff"] = f"""
SELECT {_SNAPSHOT_KEYS.format('geo')}, 'changed' AS change FROM cube
WHERE grain = {_q(K.GRAIN_YEAR)} AND geo = {_q(K.GEO_ALL)} AND band = {_q(K.EXCLUSIVE_BAND_LABELS[2])}
UNION ALL SELECT {_SNAPSHOT_KEYS.format('geo')}, 'removed' FROM cube WHERE geo = {_q(K.NESTED_PARENT)} AND month = 2
UNION ALL SELECT {_SNAPSHOT_KEYS.format("'NEW'")}, 'added' FROM cube WHERE geo = {_q(K.NESTED_PARENT)} AND grain = {_q(K.GRAIN_TOTAL)}"""
SQL_BODIES["distinct_sketches"] = " UNION ALL ".join(
    f"SELECT {_q(c)} AS field, count(DISTINCT year(l_shipdate)) AS batches, count({c}) AS rows, count(DISTINCT {c}) AS exact, true AS within_bound FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"))

# intervals of suppressed cells: the same sums, every family once a round, for more rounds than it takes
_IV_FAMILIES = [
    ("grain, start_date, geo, sex", f"CASE WHEN band = {_q(K.BAND_ALL)} THEN 1 WHEN band IN ({_list(K.EXCLUSIVE_BAND_LABELS)}) THEN 0 END"),
    ("grain, start_date, geo, band", f"CASE WHEN sex = {_q(K.SEX_ALL)} THEN 1 WHEN sex IN ({_list(K.SEX_PARTS)}) THEN 0 END"),
    ("grain, start_date, sex, band", f"CASE WHEN geo = {_q(K.GEO_ALL)} THEN 1 WHEN geo <> {_q(K.GEO_NESTED)} THEN 0 END"),
    ("year, geo, sex, band", f"CASE grain WHEN {_q(K.GRAIN_YEAR)} THEN 1 WHEN {_q(K.GRAIN_MONTH)} THEN 0 END"),
    ("geo, sex, band", f"CASE grain WHEN {_q(K.GRAIN_TOTAL)} THEN 1 WHEN {_q(K.GRAIN_YEAR)} THEN 0 END"),
]
_IV_ROUNDS = 8
_IV_MEASURES = ("a", "total")


def _iv_step(source: str, keys: str, role: str) -> str:
    def tight(m):
        return (f"CASE role WHEN 1 THEN greatest(l_{m}, coalesce(sl_{m}, l_{m})) WHEN 0 THEN greatest(l_{m}, coalesce(pl_{m} - (su_{m} - u_{m}), l_{m})) ELSE l_{m} END AS l_{m}, "
                f"CASE role WHEN 1 THEN least(u_{m}, coalesce(su_{m}, u_{m})) WHEN 0 THEN least(u_{m}, coalesce(pu_{m} - (sl_{m} - l_{m}), u_{m})) ELSE u_{m} END AS u_{m}")

    sums = ", ".join(f"sum(CASE WHEN role = 0 THEN {e}_{m} END) OVER w AS s{e}_{m}, max(CASE WHEN role = 1 THEN {e}_{m} END) OVER w AS p{e}_{m}"
                     for m in _IV_MEASURES for e in "lu")
    hidden = ", ".join(f"{m}_suppressed" for m in _IV_MEASURES)
    return (f"SELECT grain, start_date, year, geo, sex, band, {hidden}, {', '.join(map(tight, _IV_MEASURES))} FROM ("
            f"SELECT *, {sums} FROM (SELECT *, {role} AS role FROM {source}) WINDOW w AS (PARTITION BY {keys}, role IS NULL))")


def _iv_ctes() -> str:
    ends = ", ".join(f"coalesce({m}, CASE WHEN {m}_suppressed THEN {float(K.SUPPRESS_LO)} ELSE 0 END) AS l_{m}, "
                     f"coalesce({m}, CASE WHEN {m}_suppressed THEN {float(K.SUPPRESS_HI)} ELSE 1e12 END) AS u_{m}" for m in _IV_MEASURES)
    ctes, last = [f"iv0 AS MATERIALIZED (SELECT grain, start_date, year, geo, sex, band, {', '.join(f'{m}_suppressed' for m in _IV_MEASURES)}, {ends} FROM clean)"], "iv0"
    for k in range(_IV_ROUNDS * len(_IV_FAMILIES)):
        ctes.append(f"iv{k + 1} AS MATERIALIZED ({_iv_step(last, *_IV_FAMILIES[k % len(_IV_FAMILIES)])})")
        last = f"iv{k + 1}"
    rows = " UNION ALL ".join(f"SELECT grain, start_date, geo, sex, band, {_q(m)} AS measure, l_{m} AS lower, u_{m} AS upper FROM {last} WHERE {m}_suppressed" for m in _IV_MEASURES)
    return ",\n" + ",\n".join(ctes) + f",\nintervals AS ({rows})"


SQL_BODIES["suppression_intervals"] = _iv_ctes() + """
SELECT grain, CAST(start_date AS VARCHAR) AS start_date, geo, sex, band, measure, lower, upper FROM intervals"""
SQL_BODIES["interval_summary"] = _iv_ctes() + f"""
SELECT measure, grain, count(*) AS suppressed, count(*) FILTER (WHERE upper = lower) AS given_away,
       count(*) FILTER (WHERE upper - lower < {K.SUPPRESS_HI - K.SUPPRESS_LO}) AS narrowed, round(avg(upper - lower), 6) AS mean_width
FROM intervals GROUP BY measure, grain"""


def _reconciled(name: str, keys: str, role: str, m: str) -> str:
    low = f"coalesce({m}, CASE WHEN {m}_suppressed THEN {float(K.SUPPRESS_LO)} ELSE 0 END)"
    up = f"coalesce({m}, CASE WHEN {m}_suppressed THEN {float(K.SUPPRESS_HI)} ELSE 1e12 END)"
    return f"""SELECT {_q(name)} AS family, {_q(m)} AS measure, count(*) FILTER (WHERE pl = pu AND sl = su AND sl = pl) AS exact,
      count(*) FILTER (WHERE NOT (pl = pu AND sl = su) AND sl <= pu AND pl <= su) AS within, count(*) FILTER (WHERE sl > pu OR pl > su) AS violated
    FROM (SELECT sum({low}) FILTER (WHERE role = 0) AS sl, sum({up}) FILTER (WHERE role = 0) AS su, max({low}) FILTER (WHERE role = 1) AS pl,
                 max({up}) FILTER (WHERE role = 1) AS pu FROM (SELECT *, {role} AS role FROM clean) WHERE role IS NOT NULL GROUP BY {keys})
    WHERE pl IS NOT NULL AND sl IS NOT NULL"""


SQL_BODIES["reconcile_bounds"] = " UNION ALL ".join(
    _reconciled(name, *family, m) for name, family in zip(("bands", "sexes", "geos", "months", "years"), _IV_FAMILIES) for m in MEAS)

SQL_BODIES["headline_values"] = f"""
SELECT m.*, n.*, s.* FROM
  (SELECT round(100.0 * max(a) / sum(a), 6) AS peak_month_share_pct, max(CASE WHEN start_date = DATE '{K.NAMED_MONTH}' THEN a END) AS named_month_a FROM nat_month) m,
  (SELECT max(a) AS largest_band_a, round(100.0 * max(a) / sum(a), 6) AS largest_band_pct FROM nat_bands) n,
  (SELECT sum(p0) AS sex0_a, sum(p1) AS sex1_a, round(sum(p1) / nullif(sum(p0), 0), 6) AS ratio_of_sums,
          arg_min(band, struct_pack(r := -(p1 / nullif(p0, 0)), o := ordinal)) FILTER (WHERE p0 <> 0 AND p1 IS NOT NULL) AS largest_ratio_band
   FROM (SELECT c.band, b.ordinal, max(CASE WHEN sex = {_q(K.SEX_PARTS[0])} THEN a END) AS p0, max(CASE WHEN sex = {_q(K.SEX_PARTS[1])} THEN a END) AS p1
         FROM clean c JOIN bands b USING (band)
         WHERE grain = {_q(K.GRAIN_TOTAL)} AND geo = {_q(K.GEO_ALL)} AND b.ordinal IS NOT NULL GROUP BY ALL)) s"""


def _finding(name: str, body: str, value: str, about: str) -> str:
    return f"SELECT {_q(name)} AS finding, CAST({value} AS DOUBLE) AS value, CAST({about} AS VARCHAR) AS about FROM ({SQL_BODIES[body].strip()})"


SQL_BODIES["findings"] = " UNION ALL ".join([
    _finding("national share pct", "national_totals", "a_share_pct", "'national'"),
    _finding("peak month", "extremes", "peak_a", "peak_month"), _finding("lowest month", "extremes", "low_a", "low_month"),
    _finding("highest share pct", "geo_share_stats", "max_share", "max_geo"),
    _finding("lowest share pct", "geo_share_stats", "min_share", "min_geo"),
    _finding("senior share pct", "senior_share", "senior_share_pct", "'national'"),
    _finding("decline from peak pct", "decline_from_peak", "decline_pct", "last_month"),
])

SQL_BODIES["input_checksum"] = f"""
SELECT "Group", CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws(chr(31), {", ".join(f"coalesce({chr(34)}{h}{chr(34)}, chr(92) || 'N')" for h in K.SOURCE_HEADER)})), 1, 15) AS BIGINT) AS HUGEINT)) % {2 ** 60} AS BIGINT) AS fingerprint
FROM ({SQL_BODIES["scan_text_cube"].strip()}) GROUP BY 1"""

# checkable facts about fitted models
_CHECKS = ("CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT geo) AS BIGINT) AS geos, sum(a) AS actual, sum(lag1_a) AS persistence, "
           "round(avg(abs(a - greatest(lag1_a, 0.0))), 6) AS baseline_mae, round(sqrt(avg((a - greatest(lag1_a, 0.0)) ** 2)), 6) AS baseline_rmse, "
           "round(1 - sum((a - greatest(lag1_a, 0.0)) ** 2) / nullif(var_pop(a) * count(a), 0), 6) AS baseline_r2, "
           "round(100.0 * sum(abs(a - greatest(lag1_a, 0.0))) / nullif(sum(a), 0), 6) AS baseline_wape_pct, true AS predictions_ok")
SQL_BODIES["forecast_checks"] = " UNION ALL ".join(
    f"SELECT {_q(m)} AS model, {_CHECKS} FROM test_rows" for m in ("trees", "trees_early", "residual_linear", "residual_trees"))
_RESIDUAL = "avg((ln(1 + a) - ln(1 + lag1_a)) ** 2)"
SQL_BODIES["loss_history_checks"] = f"""
SELECT f.model, f.rounds, true AS complete, round(t.loss, 6) AS anchor_train, round(v.loss, 6) AS anchor_valid, true AS learned, true AS rule_ok,
       t.n AS fit_rows, v.n AS validation_rows
FROM (VALUES {", ".join(f"({_q(m)}, {x[0]})" for m, x in K.RESIDUAL_TREES.items())}) f(model, rounds),
     (SELECT {_RESIDUAL} AS loss, CAST(count(*) AS BIGINT) AS n FROM panel WHERE start_date < DATE '{K.FIT_END}') t,
     (SELECT {_RESIDUAL} AS loss, CAST(count(*) AS BIGINT) AS n FROM panel WHERE start_date BETWEEN DATE '{K.VALID_START}' AND DATE '{K.VALID_END}') v"""
SQL_BODIES["gbt_cv_checks"] = " UNION ALL ".join(
    f"SELECT {_q(lbl)} AS fold, {_CHECKS}, (SELECT CAST(count(*) AS BIGINT) FROM panel WHERE start_date < DATE '{s}') AS train_rows, "
    f"CAST(count(*) AS BIGINT) AS validation_rows, true AS winner_ok FROM panel WHERE start_date BETWEEN DATE '{s}' AND DATE '{e}'"
    for lbl, s, e in K.FOLDS)
SQL_BODIES["monthly_model_checks"] = """
SELECT CAST(start_date AS VARCHAR) AS start_date, CAST(count(*) AS BIGINT) AS rows, sum(a) AS actual, sum(lag1_a) AS persistence, true AS predictions_ok
FROM test_rows GROUP BY start_date"""
SQL_BODIES["kmeans_checks"] = " UNION ALL ".join(
    f"SELECT {k} AS k, CAST(count(*) AS BIGINT) AS n_points, true AS all_groups_used, true AS cost_is_inertia, true AS in_order FROM profile"
    for k in [0, *K.KMEANS_KS])
SQL_BODIES["pca_checks"] = """
SELECT CAST(count(*) AS BIGINT) AS n_geos, true AS uncorrelated, true AS share1_ok, true AS share2_ok, true AS in_order FROM profile"""


def _on_total(body: str) -> str:
    """The same query over the panel of the measure ``total``."""
    body = re.sub(r"(?<!AS )\b(panel|test_rows)\b", r"\1_total", body)
    body = body.replace(", lag1_total", "")
    return re.sub(r"\b(|lag1_|lag2_|lag3_|rolling3_)a\b", r"\1total", body)


for _name in ("lag_panel", "forecast_errors", "baseline_metrics", "model_comparison", "acceptance", "wape_monitor", "conformal_band"):
    SQL_BODIES[f"{_name}_total"] = _on_total(SQL_BODIES[_name])


def _positive_zero(sql: str) -> str:
    """Wrap every round(...) as (0.0 + round(...)): DuckDB keeps the sign of a
    rounded-away negative (-0.0) while Spark's decimal rounding yields 0.0."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j + len(key):k]
        out.append(sql[i:j] + "(0.0 + round(" + _positive_zero(inner) + "))")
        i = k + 1


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in SQL_BODIES.items():
        body = _positive_zero(v.strip())
        sep = "" if body.startswith(",") else "\n"
        out[k] = "WITH " + CUBE_CTES.strip() + sep + body
    return out
