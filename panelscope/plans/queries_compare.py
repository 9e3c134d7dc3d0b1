"""Queries for official survival and worker flows, freshness, code lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscope.operators import compare as K
from panelscope.operators import flows as FL
from panelscope.plans.catalog import register
from panelscope.plans.inputs import payroll
from panelscope.plans.queries_dynamics import flows_entry_exit_sql
from panelscope.sources import synth

_Q = "(year({0}) * 4 + quarter({0}))"
_NAME = "(CAST(({0} - 1) // 4 AS VARCHAR) || 'Q' || CAST(({0} - 1) % 4 + 1 AS VARCHAR))"
SPELLS_SQL = f"""pay_spells AS (
      SELECT {_NAME.format('f')} AS cohort, l - f AS duration, l < (SELECT {_Q.format('max(ref_date)')} FROM payroll) AS died, true AS a
      FROM (SELECT {_Q.format('min(entry_month) FILTER (WHERE is_birth)')} AS f, {_Q.format('max(ref_date)')} AS l FROM payroll GROUP BY client_id) x WHERE f IS NOT NULL),
    off_spells AS (
      SELECT {_NAME.format('f')} AS cohort, l - f AS duration, l < (SELECT {_Q.format('max(qdate)')} FROM bed_active) AS died, false AS a
      FROM (SELECT {_Q.format('min(qdate)')} AS f, {_Q.format('max(qdate)')} AS l FROM bed_active GROUP BY cust) x),
    both_spells AS (SELECT * FROM pay_spells UNION ALL SELECT * FROM off_spells)"""


def _follow_up_sql(strata: str) -> str:
    keys = f"{strata}, " if strata else ""
    part = f"PARTITION BY {strata} " if strata else ""
    return f"""SELECT {keys}duration, CAST(sum(na) OVER w AS BIGINT) AS n_a, d_a, CAST(sum(nb) OVER w AS BIGINT) AS n_b, d_b
      FROM (SELECT {keys}duration, count(*) FILTER (WHERE a) AS na, count(*) FILTER (WHERE a AND died) AS d_a,
                   count(*) FILTER (WHERE NOT a) AS nb, count(*) FILTER (WHERE NOT a AND died) AS d_b FROM both_spells GROUP BY {keys}duration) c
      WINDOW w AS ({part}ORDER BY duration DESC ROWS UNBOUNDED PRECEDING)"""


@register("survival_vs_official", f"""WITH {SPELLS_SQL}, t AS ({_follow_up_sql('')}),
      s AS (SELECT *, CASE WHEN n_a > 0 THEN 1 - CAST(d_a AS DOUBLE) / n_a ELSE 1 END AS sa, CASE WHEN n_b > 0 THEN 1 - CAST(d_b AS DOUBLE) / n_b ELSE 1 END AS sb FROM t),
      c AS (SELECT CAST(duration AS INTEGER) AS age_quarters, n_a AS payroll_at_risk, n_b AS official_at_risk,
              product(sa) OVER w AS payroll_survival, product(sb) OVER w AS official_survival FROM s WINDOW w AS (ORDER BY duration ROWS UNBOUNDED PRECEDING))
    SELECT *, payroll_survival - official_survival AS gap FROM c""")
def q_survival_vs_official(spark, d):
    return K.survival_gap(K.birth_spells(payroll(spark, d)), synth.official_spells(spark, d))


@register("survival_log_rank", f"""WITH {SPELLS_SQL}, t AS ({_follow_up_sql('cohort')}),
      e AS (SELECT cohort, d_a, CAST(d_a + d_b AS DOUBLE) * n_a / (n_a + n_b) AS e,
              CASE WHEN n_a + n_b > 1 THEN (d_a + d_b) * (CAST(n_a AS DOUBLE) / (n_a + n_b)) * (CAST(n_b AS DOUBLE) / (n_a + n_b))
                * (n_a + n_b - d_a - d_b) / (n_a + n_b - 1) ELSE 0 END AS v FROM t),
      g AS (SELECT CASE WHEN grouping(cohort) = 1 THEN 'all' ELSE cohort END AS cohort, CAST(sum(d_a) AS BIGINT) AS observed, sum(e) AS expected, sum(v) AS variance
            FROM e GROUP BY GROUPING SETS ((cohort), ()))
    SELECT *, CASE WHEN variance > 1e-12 THEN pow(observed - expected, 2) / variance END AS chi2 FROM g""")
def q_survival_log_rank(spark, d):
    return K.log_rank(K.birth_spells(payroll(spark, d)), synth.official_spells(spark, d))


WORKER_SURVEY_SQL = """SELECT make_date(year(l_shipdate), month(l_shipdate), 12) AS ref_date, s AS supersector, CAST(sum(l_quantity) AS DOUBLE) AS employment,
        CAST(coalesce(sum(l_quantity) FILTER (WHERE l_linenumber = 1), 0) AS DOUBLE) AS hires,
        CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS separations
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN (SELECT c_custkey, {s} AS s FROM customer) c ON o.o_custkey = c.c_custkey GROUP BY 1, 2"""


def _survey_sql() -> str:
    from panelscope.plans.oracle import _case, _supersector
    return WORKER_SURVEY_SQL.format(s=_supersector(f"substr({_case('c_mktsegment', synth.SEGMENT_QCEW_INDUSTRY)}, 1, 2)"))


def _corr(x: str, y: str) -> str:
    return f"covar_samp({x}, {y}) OVER (PARTITION BY supersector) / sqrt(var_samp({x}) OVER (PARTITION BY supersector) * var_samp({y}) OVER (PARTITION BY supersector))"


@register("flows_vs_jolts", f"""WITH o0 AS (SELECT *, employment - lag(employment) OVER (PARTITION BY supersector ORDER BY ref_date) AS chg FROM ({_survey_sql()}) y),
      o1 AS (SELECT *, chg - (hires - separations) AS discrepancy FROM o0),
      o2 AS (SELECT *, CASE WHEN discrepancy IS NULL THEN hires ELSE greatest(hires + discrepancy / 2, chg, 0.0) END AS h FROM o1),
      o3 AS (SELECT ref_date, supersector, discrepancy, h / NULLIF(employment, 0) AS official_hire_rate,
               CASE WHEN discrepancy IS NULL THEN separations ELSE h - chg END / NULLIF(employment, 0) AS official_separation_rate FROM o2),
      m AS (SELECT ref_date, supersector, hire_rate, separation_rate, discrepancy, official_hire_rate, official_separation_rate
            FROM ({flows_entry_exit_sql(['supersector'])}) p JOIN o3 USING (ref_date, supersector))
    SELECT *, hire_rate - official_hire_rate AS hire_gap, separation_rate - official_separation_rate AS separation_gap,
      {_corr('hire_rate', 'official_hire_rate')} AS hire_corr, {_corr('separation_rate', 'official_separation_rate')} AS separation_corr FROM m""")
def q_flows_vs_jolts(spark, d):
    flows = FL.compute_job_flows(payroll(spark, d), ["supersector"], "entry_exit")
    return K.compare_flows_to_worker_survey(flows, synth.worker_survey(spark, d), ["supersector"])


AS_OF = (-30, -15, 0, 15, 30, 45)


@register("filing_freshness", " UNION ALL ".join(f"""SELECT ref_date, CAST({k} AS INTEGER) AS as_of_days,
      CAST(coalesce(sum(qualified_employment) FILTER (WHERE filing_date - ref_date <= {k}), 0) AS BIGINT) AS filed_employment,
      count(*) FILTER (WHERE filing_date - ref_date <= {k}) AS filed_rows, CAST(sum(qualified_employment) AS BIGINT) AS final_employment, count(*) AS final_rows,
      CAST(coalesce(sum(qualified_employment) FILTER (WHERE filing_date - ref_date <= {k}), 0) AS DOUBLE) / NULLIF(sum(qualified_employment), 0) AS employment_share,
      CAST(count(*) FILTER (WHERE filing_date - ref_date <= {k}) AS DOUBLE) / count(*) AS row_share
    FROM payroll GROUP BY ref_date""" for k in AS_OF))
def q_filing_freshness(spark, d):
    return K.filing_freshness(payroll(spark, d), AS_OF)


@register("naics_validity_list", """WITH listed AS (SELECT DISTINCT industry_code AS code FROM qcew_raw),
      codes AS (SELECT CASE WHEN code LIKE '%-%' THEN CAST(unnest(range(CAST(split_part(code, '-', 1) AS INTEGER), CAST(split_part(code, '-', -1) AS INTEGER) + 1)) AS VARCHAR)
                ELSE code END AS prefix, code AS listed FROM listed WHERE code LIKE '%-%' UNION ALL SELECT code, code FROM listed WHERE code NOT LIKE '%-%'),
      f AS (SELECT naics_code, count(*) AS n_rows FROM payroll GROUP BY naics_code),
      h AS (SELECT f.naics_code, max(CASE WHEN starts_with(f.naics_code, prefix) THEN length(prefix) END) AS w,
              max(CASE WHEN starts_with(ltrim(f.naics_code, '0'), prefix) THEN length(prefix) END) AS b FROM f, codes GROUP BY f.naics_code)
    SELECT naics_code, n_rows, (SELECT max(listed) FROM codes WHERE length(prefix) = coalesce(w, b) AND starts_with(CASE WHEN w IS NOT NULL THEN f.naics_code ELSE ltrim(f.naics_code, '0') END, prefix)) AS listed,
      CAST(coalesce(w, b) AS INTEGER) AS n_digits, CASE WHEN w IS NOT NULL THEN 'valid' WHEN b IS NOT NULL THEN 'short' ELSE 'unknown' END AS status
    FROM f JOIN h USING (naics_code)""")
def q_naics_validity_list(spark, d):
    """The official table's industry codes are the list."""
    codes = synth.qcew_raw(spark, d).select(F.col("industry_code").alias("code")).distinct()
    return K.naics_against_list(payroll(spark, d), codes)
