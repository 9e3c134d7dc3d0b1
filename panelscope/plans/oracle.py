"""DuckDB SQL for the cross-check: the synthetic inputs as CTEs plus one query per operator.

The CTEs repeat the recipe of :mod:`panelscope.sources.synth` and the loader
in plain SQL, so each oracle query runs on the driver's raw tables only.
"""

from __future__ import annotations

from panelscope.functions.cols import SIZE_CLASS_LABELS, SIZE_CLASS_UPPERS, SUPERSECTOR_MAP
from panelscope.operators.panel import AGGREGATION_LEVELS, _gid
from panelscope.sources.official import CES_SUPERSECTOR_NAMES, QCEW_SIZE_CODES
from panelscope.sources.synth import (EXIT_CUTOFF, SEGMENT_CES_CODE, SEGMENT_NAICS, SEGMENT_QCEW_INDUSTRY,
                                      SIZE_CODE_UPPERS, ZERO_MODULUS)


def _case(expr: str, mapping: dict[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _size_case(e: str) -> str:
    parts = [f"WHEN {e} <= 0 THEN '{SIZE_CLASS_LABELS[0]}'"]
    parts += [f"WHEN {e} <= {u} THEN '{lab}'" for u, lab in zip(SIZE_CLASS_UPPERS, SIZE_CLASS_LABELS)]
    return f"CASE {' '.join(parts)} ELSE '{SIZE_CLASS_LABELS[-1]}' END"


def _supersector(code2: str) -> str:
    return f"coalesce({_case(code2, SUPERSECTOR_MAP)}, 'Other services')"


def _quarter(d: str) -> str:
    return f"(CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR))"


def _month12(ts: str) -> str:
    return f"make_date(year({ts}), month({ts}), 12)"


PAYROLL_CTES = f"""
li_order AS (
  SELECT l_orderkey, sum(l_quantity) AS qty, sum(l_extendedprice) AS price,
         count(*) FILTER (WHERE l_linenumber = 1) AS n_first,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY l_orderkey),
client_months AS (
  SELECT o.o_custkey, {_month12('o.o_orderdate')} AS ref_date,
         sum(l.qty) AS qty, sum(l.price) AS price, sum(l.n_first) AS n_first, sum(l.n_returned) AS n_returned
  FROM orders o JOIN li_order l ON o.o_orderkey = l.l_orderkey
  GROUP BY 1, 2),
client_months_w AS (
  SELECT *, min(ref_date) OVER (PARTITION BY o_custkey) AS _first,
            max(ref_date) OVER (PARTITION BY o_custkey) AS _last
  FROM client_months),
payroll_raw_f AS (
  SELECT cm.o_custkey AS client_id, cm.ref_date, cm._first AS entry_month,
    CASE WHEN cm._last < DATE '{EXIT_CUTOFF}' THEN cm._last END AS exit_month,
    CASE WHEN cm.o_custkey % 4 = 1 THEN true WHEN cm.o_custkey % 4 >= 2 THEN false END AS is_birth,
    {_case('c.c_mktsegment', SEGMENT_NAICS)} AS naics_code,
    lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') AS state_fips,
    CASE WHEN (cm.o_custkey + year(cm.ref_date) * 12 + month(cm.ref_date)) % {ZERO_MODULUS} = 0 THEN CAST(0 AS BIGINT)
         ELSE CAST(cm.qty * 2 AS BIGINT) END AS qualified_employment,
    round(cm.price, 2) AS gross_pay,
    cm._first + CAST(cm.o_custkey % 90 - 45 AS INTEGER) AS filing_date,
    cm.n_first AS hires, cm.n_returned AS separations
  FROM client_months_w cm JOIN customer c ON cm.o_custkey = c.c_custkey),
payroll_flows AS (
  SELECT client_id, ref_date, entry_month, exit_month, is_birth,
    CASE WHEN length(naics_code) >= 6 THEN naics_code ELSE lpad(naics_code, 6, '0') END AS naics_code,
    state_fips, qualified_employment, gross_pay, filing_date, hires, separations,
    substr(CASE WHEN length(naics_code) >= 6 THEN naics_code ELSE lpad(naics_code, 6, '0') END, 1, 2) AS naics2,
    substr(CASE WHEN length(naics_code) >= 6 THEN naics_code ELSE lpad(naics_code, 6, '0') END, 1, 3) AS naics3,
    {_supersector("substr(CASE WHEN length(naics_code) >= 6 THEN naics_code ELSE lpad(naics_code, 6, '0') END, 1, 2)")}
      AS supersector,
    {_size_case('qualified_employment')} AS size_class,
    {_quarter('ref_date')} AS quarter
  FROM payroll_raw_f),
payroll AS (
  SELECT * EXCLUDE (hires, separations) FROM payroll_flows)"""

_LEVEL_CASE = "CASE GROUPING(supersector, state_fips, size_class) " + " ".join(
    f"WHEN {_gid(cols)} THEN '{name}'" for name, cols in AGGREGATION_LEVELS) + " END"
_SETS = ", ".join("(" + ", ".join(["ref_date", "quarter"] + cols) + ")" for _, cols in AGGREGATION_LEVELS)

PANEL_CTE = f"""
panel AS (
  SELECT {_LEVEL_CASE} AS grouping_level, ref_date, quarter, supersector, state_fips, size_class,
    CAST(coalesce(sum(qualified_employment), 0) AS BIGINT) AS payroll_employment,
    count(DISTINCT CASE WHEN qualified_employment > 0 THEN client_id END) AS client_count,
    count(*) FILTER (WHERE is_birth) AS birth_count,
    count(is_birth) AS birth_determinable_count,
    count(*) FILTER (WHERE entry_month = ref_date) AS entry_count,
    count(*) FILTER (WHERE exit_month = ref_date) AS exit_count,
    CAST(coalesce(sum(qualified_employment) FILTER (
      WHERE entry_month <> ref_date AND (exit_month IS NULL OR exit_month <> ref_date)), 0) AS BIGINT)
      AS continuing_employment
  FROM payroll
  GROUP BY GROUPING SETS ({_SETS}))"""

_SIZE_CODE = "CASE " + " ".join(f"WHEN q / 3 <= {u} THEN '{c}'" for u, c in zip(SIZE_CODE_UPPERS, "12345678")) + " ELSE '9' END"

QCEW_CTES = f"""
ship_lines AS (
  SELECT l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_shipdate, c.c_nationkey, c.c_mktsegment
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
qcew_base AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS VARCHAR) AS qtr,
    lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS st,
    {_case('c_mktsegment', SEGMENT_QCEW_INDUSTRY)} AS industry_code,
    month(l_shipdate) - (quarter(l_shipdate) - 1) * 3 AS pos, l_quantity, l_suppkey, l_extendedprice
  FROM ship_lines),
qcew_state AS (
  SELECT st || '000' AS area_fips, '5' AS own_code, industry_code, '58' AS agglvl_code, '0' AS size_code,
    year, qtr,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 1), 0) * 10 AS BIGINT) AS month1_emplvl,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 2), 0) * 10 AS BIGINT) AS month2_emplvl,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 3), 0) * 10 AS BIGINT) AS month3_emplvl,
    CAST(count(DISTINCT l_suppkey) * 5 AS BIGINT) AS qtrly_estabs_count,
    round(sum(l_extendedprice), 2) AS total_qtrly_wages, 'state' AS slice
  FROM qcew_base GROUP BY year, qtr, st, industry_code),
qcew_national AS (
  SELECT 'US000' AS area_fips, '5' AS own_code, industry_code, '14' AS agglvl_code, '0' AS size_code,
    year, qtr,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 1), 0) * 10 AS BIGINT) AS month1_emplvl,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 2), 0) * 10 AS BIGINT) AS month2_emplvl,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 3), 0) * 10 AS BIGINT) AS month3_emplvl,
    CAST(count(DISTINCT l_suppkey) * 5 AS BIGINT) AS qtrly_estabs_count,
    round(sum(l_extendedprice), 2) AS total_qtrly_wages, 'national' AS slice
  FROM qcew_base GROUP BY year, qtr, industry_code),
qcew_supplier AS (
  SELECT year, qtr, industry_code, l_suppkey, sum(l_quantity) AS q, sum(l_extendedprice) AS pay,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 1), 0) * 10 AS BIGINT) AS m1,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 2), 0) * 10 AS BIGINT) AS m2,
    CAST(coalesce(sum(l_quantity) FILTER (WHERE pos = 3), 0) * 10 AS BIGINT) AS m3
  FROM qcew_base WHERE qtr = '1' GROUP BY 1, 2, 3, 4),
qcew_size AS (
  SELECT 'US000' AS area_fips, '5' AS own_code, industry_code, '24' AS agglvl_code, {_SIZE_CODE} AS size_code, year, qtr,
    CAST(sum(m1) AS BIGINT) AS month1_emplvl, CAST(sum(m2) AS BIGINT) AS month2_emplvl, CAST(sum(m3) AS BIGINT) AS month3_emplvl,
    CAST(count(*) * 5 AS BIGINT) AS qtrly_estabs_count, round(sum(pay), 2) AS total_qtrly_wages, 'size' AS slice
  FROM qcew_supplier GROUP BY industry_code, {_SIZE_CODE}, year, qtr),
qcew_raw AS (
  SELECT * FROM qcew_state
  UNION ALL SELECT * FROM qcew_size
  UNION ALL SELECT * FROM qcew_national
  UNION ALL SELECT area_fips, '1' AS own_code, industry_code, '11' AS agglvl_code, size_code, year, qtr,
    month1_emplvl * 3, month2_emplvl * 3, month3_emplvl * 3, qtrly_estabs_count, total_qtrly_wages * 3, slice
    FROM qcew_national),
qcew_long AS (
  SELECT *, {_supersector('substr(industry_code, 1, 2)')} AS supersector, substr(area_fips, 1, 2) AS state_fips,
    {_case('size_code', QCEW_SIZE_CODES)} AS size_class
  FROM (
    SELECT area_fips, own_code, industry_code, agglvl_code, size_code, year, qtr, qtrly_estabs_count AS qcew_establishments,
      total_qtrly_wages, slice, month1_emplvl AS qcew_employment, make_date(CAST(year AS INTEGER), (CAST(qtr AS INTEGER) - 1) * 3 + 1, 12) AS ref_date,
      CAST(year AS VARCHAR) || 'Q' || qtr AS quarter FROM qcew_raw
    UNION ALL
    SELECT area_fips, own_code, industry_code, agglvl_code, size_code, year, qtr, qtrly_estabs_count,
      total_qtrly_wages, slice, month2_emplvl, make_date(CAST(year AS INTEGER), (CAST(qtr AS INTEGER) - 1) * 3 + 2, 12),
      CAST(year AS VARCHAR) || 'Q' || qtr FROM qcew_raw
    UNION ALL
    SELECT area_fips, own_code, industry_code, agglvl_code, size_code, year, qtr, qtrly_estabs_count,
      total_qtrly_wages, slice, month3_emplvl, make_date(CAST(year AS INTEGER), (CAST(qtr AS INTEGER) - 1) * 3 + 3, 12),
      CAST(year AS VARCHAR) || 'Q' || qtr FROM qcew_raw)),
off_national AS (
  SELECT ref_date, quarter, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'national' GROUP BY ref_date, quarter),
off_supersector AS (
  SELECT ref_date, quarter, supersector, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'national' GROUP BY ref_date, quarter, supersector),
off_state AS (
  SELECT ref_date, quarter, state_fips, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'state' GROUP BY ref_date, quarter, state_fips),
off_size_class AS (
  SELECT ref_date, quarter, size_class, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'size' GROUP BY ref_date, quarter, size_class),
off_supersector_size_class AS (
  SELECT ref_date, quarter, supersector, size_class, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'size' GROUP BY ref_date, quarter, supersector, size_class),
off_supersector_state AS (
  SELECT ref_date, quarter, supersector, state_fips, CAST(sum(qcew_employment) AS BIGINT) AS qcew_employment,
    CAST(sum(qcew_establishments) AS BIGINT) AS qcew_establishments
  FROM qcew_long WHERE own_code = '5' AND slice = 'state' GROUP BY ref_date, quarter, supersector, state_fips)"""

CES_CTES = f"""
ces_base AS (
  SELECT {_month12('l.l_shipdate')} AS date, {_case('c.c_mktsegment', SEGMENT_CES_CODE)} AS code, l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
ces_series AS (
  SELECT date, code, sum(l_quantity) AS value FROM ces_base GROUP BY date, code
  UNION ALL SELECT date, '05' AS code, sum(l_quantity) AS value FROM ces_base GROUP BY date),
ces_raw AS (
  SELECT 'CES' || code || '00000001' AS series_id, date, value FROM ces_series
  UNION ALL SELECT 'CEU' || code || '00000001' AS series_id, date, value * 1.02 AS value FROM ces_series),
ces AS (
  SELECT CAST(date AS DATE) AS ref_date,
    coalesce({_case('substr(series_id, 4, 2)', CES_SUPERSECTOR_NAMES)}, substr(series_id, 4, 2)) AS supersector,
    value AS employment,
    CASE WHEN starts_with(series_id, 'CES') THEN 'SA' ELSE 'NSA' END AS seasonal_adjustment
  FROM ces_raw WHERE starts_with(series_id, 'CES'))"""

BED_CTES = f"""
bed_active AS (
  SELECT DISTINCT o.o_custkey AS cust, make_date(year(l.l_shipdate), (quarter(l.l_shipdate) - 1) * 3 + 1, 1) AS qdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
bed_life AS (SELECT cust, min(qdate) AS first_q, max(qdate) AS last_q FROM bed_active GROUP BY cust),
bed_rows AS (
  SELECT a.qdate, {_case('c.c_mktsegment', SEGMENT_NAICS)} AS ind,
    CASE WHEN a.qdate = l.first_q THEN 1 ELSE 0 END AS b, CASE WHEN a.qdate = l.last_q THEN 1 ELSE 0 END AS d
  FROM bed_active a JOIN bed_life l ON a.cust = l.cust JOIN customer c ON a.cust = c.c_custkey),
bed_all AS (
  SELECT qdate, '000000' AS ind, sum(b) AS b, sum(d) AS d, count(*) AS e FROM bed_rows GROUP BY qdate
  UNION ALL SELECT qdate, ind, sum(b), sum(d), count(*) FROM bed_rows GROUP BY qdate, ind),
bed_raw AS (
  SELECT 'BDU' || '00' || '00000' || lpad(ind, 6, '0') || '01' || '1LQ5' AS series_id, qdate AS date, CAST(e AS DOUBLE) AS value FROM bed_all
  UNION ALL SELECT 'BDU' || '00' || '00000' || lpad(ind, 6, '0') || '02' || '1LQ5', qdate, CAST(b AS DOUBLE) FROM bed_all
  UNION ALL SELECT 'BDU' || '00' || '00000' || lpad(ind, 6, '0') || '03' || '1LQ5', qdate, CAST(d AS DOUBLE) FROM bed_all),
bed_pivot AS (
  SELECT CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
    substr(series_id, 4, 2) AS state_fips, substr(series_id, 11, 6) AS naics_code,
    max(value) FILTER (WHERE substr(series_id, 17, 2) = '02') AS births,
    max(value) FILTER (WHERE substr(series_id, 17, 2) = '03') AS deaths,
    max(value) FILTER (WHERE substr(series_id, 17, 2) = '01') AS total_establishments
  FROM bed_raw GROUP BY 1, 2, 3, 4),
bed AS (
  SELECT year, quarter, naics_code, '0' AS size_class, state_fips, births, deaths, total_establishments,
    CASE WHEN total_establishments > 0 THEN births / total_establishments END AS birth_rate,
    CASE WHEN total_establishments > 0 THEN deaths / total_establishments END AS death_rate
  FROM bed_pivot),
bed_national AS (
  SELECT CAST(year AS VARCHAR) || 'Q' || CAST(quarter AS VARCHAR) AS quarter, births AS bed_births,
    deaths AS bed_deaths, total_establishments AS bed_establishments, birth_rate AS bed_birth_rate
  FROM bed WHERE state_fips = '00' AND naics_code = '000000')"""

EMPLOYEE_CTES = f"""
employees AS (
  SELECT e.employee_id, e.client_id, e.ref_date, e.gross_pay,
    lpad(CAST(s.s_nationkey + 1 AS VARCHAR), 2, '0') AS state_fips, CAST(1 AS BIGINT) AS qualified_employment
  FROM (SELECT {_month12('l_shipdate')} AS ref_date, l_partkey AS employee_id, l_suppkey AS client_id,
               round(sum(l_extendedprice), 2) AS gross_pay
        FROM lineitem GROUP BY 1, 2, 3) e
  JOIN supplier s ON e.client_id = s.s_suppkey)"""

ALL_CTES = ",".join([PAYROLL_CTES, PANEL_CTE, QCEW_CTES, CES_CTES, BED_CTES, EMPLOYEE_CTES])


def with_ctes(body: str, extra: str = "") -> str:
    """Prefix a query body with every input CTE (DuckDB inlines only the referenced ones)."""
    ctes = ALL_CTES + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def as_select(sql_body: str) -> str:
    """A query that begins with its own CTEs, as one SELECT below the input CTEs."""
    return f"SELECT * FROM ({sql_body}) AS _q" if sql_body.lstrip().upper().startswith("WITH") else sql_body


__all__ = ["with_ctes", "as_select", "ALL_CTES"]
