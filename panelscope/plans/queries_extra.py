"""Queries for exhibit tables and the documented assessment / benchmarking operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscope.functions.cols import supersector_of
from panelscope.operators import assess as A
from panelscope.operators import births as B
from panelscope.operators import coverage as C
from panelscope.operators import exhibits as X
from panelscope.operators import flows as FL
from panelscope.operators import growth as G
from panelscope.operators import quality as Q
from panelscope.operators import tenure as T
from panelscope.operators.panel import AGGREGATION_LEVELS, PANEL_MEASURES
from panelscope.plans.catalog import register
from panelscope.plans.inputs import bed, official, panel, panel_at, payroll
from panelscope.plans.queries_births import BIRTH_SQL, REWEIGHTED_SQL, lag_regression_sql, payroll_births, raked_one
from panelscope.plans.queries_core import (DQ_ROWS_SQL, SLICES, VINTAGE_SQL, coverage_df, coverage_sql, csi_sql, entry_exit_sql,
                                           nearest_sql, share_sql)
from panelscope.plans.queries_dynamics import (CES_TOTAL, ces_growth, change_sql, flows_employee_sql,
                                               flows_entry_exit_sql, growth_sql)
from panelscope.sources import synth
from panelscope.sources.payroll import REQUIRED_COLUMNS

NAMES = X.SUPERSECTOR_NAMES
PAYROLL_COLUMNS = REQUIRED_COLUMNS + ["gross_pay", "filing_date", "naics2", "naics3", "supersector", "size_class",
                                      "quarter"]


def _matrix_sql(inner: str, value: str) -> str:
    cols = ", ".join(f"max(CASE WHEN supersector = '{n}' THEN {value} END) AS \"{n}\"" for n in NAMES)
    return f"""SELECT state_fips, {cols} FROM ({inner}) c
      WHERE ref_date = (SELECT max(ref_date) FROM ({inner}) m) GROUP BY state_fips"""


@register("coverage_matrix", _matrix_sql(coverage_sql("supersector_state"), "coverage_ratio_employment"))
def q_coverage_matrix(spark, d):
    return X.coverage_matrix(coverage_df(spark, d, "supersector_state"))


@register("estab_matrix", _matrix_sql(coverage_sql("supersector_state"), "coverage_ratio_estab"))
def q_estab_matrix(spark, d):
    return X.coverage_matrix(coverage_df(spark, d, "supersector_state"), "coverage_ratio_estab")


RELIABILITY_SQL = f"""SELECT *, CASE WHEN coverage_ratio_employment IS NULL THEN 'insufficient'
      WHEN payroll_clients >= 30 AND coverage_ratio_employment >= 0.005 THEN 'reliable'
      WHEN payroll_clients < 30 AND coverage_ratio_employment < 0.005 THEN 'insufficient'
      ELSE 'marginal' END AS reliability FROM ({coverage_sql('supersector_state')}) c"""


@register("usability_matrix", _matrix_sql(
    f"""SELECT *, CASE reliability WHEN 'reliable' THEN 1.0 WHEN 'marginal' THEN 0.5 ELSE 0.0 END AS _score
        FROM ({RELIABILITY_SQL}) r""", "CAST(_score AS DOUBLE)"))
def q_usability_matrix(spark, d):
    return X.usability_matrix(C.compute_cell_reliability(coverage_df(spark, d, "supersector_state")))


@register("share_means", f"""SELECT supersector, avg(payroll_share) AS payroll_share, avg(qcew_share) AS qcew_share
    FROM ({share_sql('supersector', 'supersector')}) s GROUP BY supersector""")
def q_share_means(spark, d):
    sh = C.compute_share_comparison(panel_at(spark, d, "supersector"),
                                    official(spark, d, ["supersector"], "national"), "supersector")
    return X.share_means(sh)


#: Years of the order dates of the given tables (fixed calendar).
VINTAGES = list(range(1995, 2002))


@register("vintage_matrix", "SELECT ref_date, " + ", ".join(
    f'coalesce(max(CASE WHEN vintage_year = {v} THEN share END), CAST(0.0 AS DOUBLE)) AS "{v}"' for v in VINTAGES) + f"""
    FROM (SELECT ref_date, vintage_year,
                 CAST(employment AS DOUBLE) / NULLIF(sum(employment) OVER (PARTITION BY ref_date), 0) AS share
          FROM ({VINTAGE_SQL}) v) s GROUP BY ref_date""")
def q_vintage_matrix(spark, d):
    return X.vintage_matrix(T.compute_vintage_shares(payroll(spark, d)), VINTAGES)


@register("tenure_histogram", """WITH t AS (SELECT CAST(round(date_diff('day', min(ref_date), max(ref_date)) / 30.0) AS DOUBLE) AS v
                 FROM payroll GROUP BY client_id),
      s AS (SELECT count(*) AS n, min(v) AS lo0, max(v) AS hi0 FROM t),
      b AS (SELECT n, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
                   CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
                   least(50, greatest(10, CAST(floor(n / 10) AS INTEGER))) AS bins FROM s),
      c AS (SELECT least(CAST(floor((v - lo) * (bins / (hi - lo))) AS INTEGER), bins - 1) AS bin, count(*) AS cnt
            FROM t JOIN b ON true GROUP BY 1),
      g AS (SELECT CAST(unnest(range(0, bins)) AS INTEGER) AS bin, lo, hi, bins FROM b WHERE n > 0)
    SELECT g.bin, lo + g.bin * ((hi - lo) / bins) AS bin_start, lo + (g.bin + 1) * ((hi - lo) / bins) AS bin_end,
           coalesce(c.cnt, 0) AS count FROM g LEFT JOIN c USING (bin)""")
def q_tenure_histogram(spark, d):
    return X.histogram(T.compute_client_tenure(payroll(spark, d)), "tenure_months")


def _survival_long_sql() -> str:
    from panelscope.plans.queries_births import survival_sql
    parts = [f"SELECT entry_quarter, {int(n.split('_')[1][:-1])} AS horizon_quarters, {n} AS survival_rate FROM s"
             for n in B.SURVIVAL_HORIZONS]
    return (f"WITH s AS ({survival_sql(False)})\n    SELECT * FROM ({' UNION ALL '.join(parts)}) u "
            f"WHERE survival_rate IS NOT NULL")


@register("survival_long", _survival_long_sql())
def q_survival_long(spark, d):
    return X.survival_long(B.compute_survival_curves(payroll(spark, d)))


@register("employment_change_stack", f"""SELECT ref_date, within_change, entry_contribution,
      -exit_contribution AS exit_contribution FROM ({change_sql([])}) c""")
def q_change_stack(spark, d):
    return X.employment_change_stack(G.decompose_employment_change(payroll(spark, d)))


@register("csi_by_dimension", " UNION ALL ".join(
    f"SELECT ref_date, '{dim}' AS dimension, csi FROM ({csi_sql(dim, lvl)}) x{i}"
    for i, (dim, lvl) in enumerate((("supersector", "supersector"), ("state_fips", "state"),
                                    ("size_class", "size_class")))))
def q_csi_by_dimension(spark, d):
    return X.csi_by_dimension({dim: C.compute_composition_shift_index(panel_at(spark, d, lvl), dim)
                               for dim, lvl in (("supersector", "supersector"), ("state_fips", "state"),
                                                ("size_class", "size_class"))})


@register("headline_coverage", f"""SELECT avg(coverage_ratio_employment) AS mean_coverage_ratio_employment,
      avg(coverage_ratio_estab) AS mean_coverage_ratio_estab, count(*) AS n_months
    FROM ({coverage_sql('national')}) c""")
def q_headline(spark, d):
    return X.headline_coverage(coverage_df(spark, d, "national"))


# ---------------------------------------------------------------- assessment (documented operators)

@register("completeness", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS completeness "
    f"FROM payroll" for c in PAYROLL_COLUMNS))
def q_completeness(spark, d):
    return A.column_completeness(payroll(spark, d)).withColumnRenamed("column", "column_name")


@register("zero_employment_months", """SELECT client_id, count(DISTINCT ref_date) AS months_observed,
      count(*) FILTER (WHERE qualified_employment = 0) AS zero_employment_months FROM payroll GROUP BY client_id""")
def q_zero_months(spark, d):
    return A.zero_employment_months(payroll(spark, d))


VALID_SQL = ("coalesce(regexp_full_match(naics_code, '[0-9]{6}'), false) AND substr(naics_code, 1, 2) IN ("
             + ", ".join(f"'{k}'" for k in A.SUPERSECTOR_MAP) + ")")


@register("naics_validity", f"""SELECT ref_date, count(*) AS n_rows, count(*) FILTER (WHERE {VALID_SQL}) AS n_valid,
      CAST(count(*) FILTER (WHERE {VALID_SQL}) AS DOUBLE) / NULLIF(count(*), 0) AS validity_rate
    FROM payroll GROUP BY ref_date""")
def q_naics_validity(spark, d):
    return A.naics_validity(payroll(spark, d))


@register("filing_lag", f"""SELECT ref_date, {nearest_sql('filing_lag_days', 0.1)} AS p10_lag,
      {nearest_sql('filing_lag_days', 0.5)} AS p50_lag, {nearest_sql('filing_lag_days', 0.9)} AS p90_lag,
      avg(filing_lag_days) AS mean_lag, avg(CASE WHEN filing_lag_days > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE
        AS share_after_ref_date, count(*) AS n_filed
    FROM (SELECT ref_date, filing_lag_days, row_number() OVER (PARTITION BY ref_date ORDER BY filing_lag_days) AS _rank,
                 count(*) OVER (PARTITION BY ref_date) AS _n
          FROM (SELECT ref_date, CAST(date_diff('day', ref_date, filing_date) AS INTEGER) AS filing_lag_days
                FROM payroll WHERE filing_date IS NOT NULL) x) r
    GROUP BY ref_date""")
def q_filing_lag(spark, d):
    return A.filing_lag_distribution(payroll(spark, d))


@register("quality_scorecard", f"""WITH m AS (SELECT
      least(""" + ", ".join(f"avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE" for c in
                            ["client_id", "ref_date", "entry_month", "is_birth", "naics_code", "state_fips",
                             "qualified_employment"]) + f""") AS completeness,
      avg(CASE WHEN {VALID_SQL} THEN 1.0 ELSE 0.0 END)::DOUBLE AS naics_validity,
      avg(CASE WHEN qualified_employment = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS zero_employment_share,
      median(CAST(date_diff('day', ref_date, filing_date) AS DOUBLE)) AS median_filing_lag_days FROM payroll)
    SELECT 'completeness' AS metric, completeness AS value, 0.99::DOUBLE AS threshold, completeness >= 0.99 AS passed FROM m
    UNION ALL SELECT 'naics_validity', naics_validity, 0.95::DOUBLE, naics_validity >= 0.95 FROM m
    UNION ALL SELECT 'zero_employment_share', zero_employment_share, 0.05::DOUBLE, zero_employment_share <= 0.05 FROM m
    UNION ALL SELECT 'median_filing_lag_days', median_filing_lag_days, 45.0::DOUBLE, median_filing_lag_days <= 45.0 FROM m""")
def q_scorecard(spark, d):
    return A.quality_scorecard(payroll(spark, d))


@register("tenure_entry_exit", """SELECT client_id, min(entry_month) AS entry_month, max(exit_month) AS exit_month,
      max(exit_month) IS NULL AS active,
      CAST(round(date_diff('day', min(entry_month), coalesce(max(exit_month), (SELECT max(ref_date) FROM payroll)))
                 / 30.0) AS BIGINT) AS tenure_months
    FROM payroll GROUP BY client_id""")
def q_tenure_entry_exit(spark, d):
    return A.tenure_entry_to_exit(payroll(spark, d))


@register("quarterly_churn", """SELECT quarter,
      count(DISTINCT CASE WHEN ref_date = _first_m THEN client_id END) AS start_clients,
      count(DISTINCT CASE WHEN exit_month = ref_date THEN client_id END) AS exits,
      CAST(count(DISTINCT CASE WHEN exit_month = ref_date THEN client_id END) AS DOUBLE)
        / NULLIF(count(DISTINCT CASE WHEN ref_date = _first_m THEN client_id END), 0) AS churn_rate
    FROM payroll JOIN (SELECT quarter, min(ref_date) AS _first_m FROM payroll GROUP BY quarter) f USING (quarter)
    GROUP BY quarter""")
def q_quarterly_churn(spark, d):
    return A.quarterly_churn(payroll(spark, d))


@register("vintage_quarter", """SELECT *, vintage_quarter = max(vintage_quarter) OVER (PARTITION BY ref_date)
      AND employment_share > 0.3 AS is_contaminated FROM (
      SELECT *, CAST(employment AS DOUBLE) / NULLIF(total_emp, 0) AS employment_share FROM (
        SELECT *, CAST(sum(employment) OVER (PARTITION BY ref_date) AS BIGINT) AS total_emp FROM (
          SELECT ref_date, vintage_quarter, CAST(sum(qualified_employment) AS BIGINT) AS employment,
                 count(DISTINCT client_id) AS client_count
          FROM payroll JOIN (SELECT client_id, CAST(year(min(ref_date)) AS VARCHAR) || 'Q' ||
                                    CAST(quarter(min(ref_date)) AS VARCHAR) AS vintage_quarter
                             FROM payroll GROUP BY client_id) v USING (client_id)
          GROUP BY ref_date, vintage_quarter) v) a) b""")
def q_vintage_quarter(spark, d):
    return T.compute_vintage_shares(payroll(spark, d), period="quarter")


def quarterly_flows_sql(monthly: str) -> str:
    return f"""SELECT *, CAST(hires AS DOUBLE) / NULLIF(avg_employment, 0) AS accession_rate,
      CAST(separations AS DOUBLE) / NULLIF(avg_employment, 0) AS separation_rate FROM (
      SELECT CAST(year(ref_date) AS VARCHAR) || 'Q' || CAST(quarter(ref_date) AS VARCHAR) AS quarter,
             CAST(sum(hires) AS BIGINT) AS hires, CAST(sum(separations) AS BIGINT) AS separations,
             avg(employment) AS avg_employment FROM ({monthly}) m GROUP BY 1) q"""


@register("quarterly_flows", quarterly_flows_sql(flows_employee_sql([])))
def q_quarterly_flows(spark, d):
    return A.quarterly_flows(FL.compute_job_flows(synth.employees(spark, d), []))


def _flows_vs_bed_sql() -> str:
    joined = f"""SELECT * FROM ({quarterly_flows_sql(flows_entry_exit_sql([]))}) p
      JOIN (SELECT quarter, bed_births / NULLIF(bed_establishments, 0) AS official_accession_rate,
                   bed_deaths / NULLIF(bed_establishments, 0) AS official_separation_rate FROM bed_national) o USING (quarter)"""
    at = "(CAST(substr({0}.quarter, 1, 4) AS INTEGER) * 4 + CAST(substr({0}.quarter, 6, 1) AS INTEGER))"
    slope = "median((b.{0} - a.{0}) / (" + at.format("b") + " - " + at.format("a") + "))"
    names = [f"{o}{s}" for s in ("accession", "separation") for o in ("", "official_")]
    return f"""WITH j AS ({joined}),
      t AS (SELECT {", ".join(f"{slope.format(n + '_rate')} AS {n}_trend" for n in names)} FROM j a JOIN j b ON {at.format("b")} > {at.format("a")})
    SELECT j.*, t.*, accession_trend - official_accession_trend AS accession_trend_gap, separation_trend - official_separation_trend AS separation_trend_gap,
      accession_rate - official_accession_rate AS accession_gap, separation_rate - official_separation_rate AS separation_gap,
      covar_samp(accession_rate, official_accession_rate) OVER ()
        / sqrt(var_samp(accession_rate) OVER () * var_samp(official_accession_rate) OVER ()) AS accession_corr,
      covar_samp(separation_rate, official_separation_rate) OVER ()
        / sqrt(var_samp(separation_rate) OVER () * var_samp(official_separation_rate) OVER ()) AS separation_corr
    FROM j, t"""


@register("flows_vs_bed", _flows_vs_bed_sql())
def q_flows_vs_bed(spark, d):
    qf = A.quarterly_flows(FL.compute_job_flows(payroll(spark, d), [], "entry_exit"))
    o = B.official_birth_rates(bed(spark, d)).select(
        "quarter", F.try_divide("bed_births", "bed_establishments").alias("official_accession_rate"),
        F.try_divide("bed_deaths", "bed_establishments").alias("official_separation_rate"))
    return A.compare_flows_to_official(qf, o)


@register("job_to_job", """WITH idx AS (SELECT ref_date, dense_rank() OVER (ORDER BY ref_date) - 1 AS _idx
                    FROM (SELECT DISTINCT ref_date FROM employees) d),
      pres AS (SELECT DISTINCT employee_id, client_id, _idx FROM employees JOIN idx USING (ref_date)),
      was AS (SELECT employee_id, client_id, _idx + 1 AS _idx FROM pres),
      joined AS (SELECT DISTINCT employee_id, _idx FROM (SELECT * FROM pres EXCEPT SELECT * FROM was) a),
      quit AS (SELECT DISTINCT employee_id, _idx FROM (SELECT * FROM was EXCEPT SELECT * FROM pres) d),
      moved AS (SELECT * FROM joined INTERSECT SELECT * FROM quit),
      w AS (SELECT _idx, count(DISTINCT employee_id) AS workers FROM pres GROUP BY _idx),
      m AS (SELECT _idx, count(*) AS moves FROM moved GROUP BY _idx)
    SELECT ref_date, workers, coalesce(moves, 0) AS job_to_job_moves,
           CAST(coalesce(moves, 0) AS DOUBLE) / NULLIF(workers, 0) AS job_to_job_rate
    FROM w JOIN idx USING (_idx) LEFT JOIN m USING (_idx)""")
def q_job_to_job(spark, d):
    return A.job_to_job(synth.employees(spark, d))


@register("worker_tenure", """WITH idx AS (SELECT ref_date, dense_rank() OVER (ORDER BY ref_date) - 1 AS _idx
                    FROM (SELECT DISTINCT ref_date FROM employees) d),
      pres AS (SELECT DISTINCT e.employee_id, e.client_id, e.ref_date, i._idx FROM employees e JOIN idx i USING (ref_date)),
      isl AS (SELECT *, _idx - row_number() OVER (PARTITION BY employee_id, client_id ORDER BY _idx) AS _island FROM pres),
      t AS (SELECT ref_date, row_number() OVER (PARTITION BY employee_id, client_id, _island ORDER BY _idx) AS tenure_months
            FROM isl)
    SELECT ref_date, avg(tenure_months) AS mean_tenure_months, CAST(max(tenure_months) AS INTEGER) AS max_tenure_months,
           count(*) AS worker_client_pairs FROM t GROUP BY ref_date""")
def q_worker_tenure(spark, d):
    return A.worker_tenure_summary(synth.employees(spark, d))


PAY_SQL = """SELECT *, pay_per_employee / NULLIF(lag(pay_per_employee, 1) OVER (ORDER BY ref_date), 0) - 1 AS pay_mom,
      pay_per_employee / NULLIF(lag(pay_per_employee, 12) OVER (ORDER BY ref_date), 0) - 1 AS pay_yoy FROM (
      SELECT ref_date, sum(gross_pay) AS total_pay, CAST(sum(qualified_employment) AS BIGINT) AS employment,
             sum(gross_pay) / NULLIF(CAST(sum(qualified_employment) AS DOUBLE), 0) AS pay_per_employee
      FROM payroll GROUP BY ref_date) a"""


@register("pay_per_employee", PAY_SQL)
def q_pay(spark, d):
    return A.pay_per_employee(payroll(spark, d))


@register("pay_vs_official", f"""SELECT *, covar_samp(pay_growth, official_growth) OVER ()
        / sqrt(var_samp(pay_growth) OVER () * var_samp(official_growth) OVER ()) AS growth_corr FROM (
      SELECT *, pay_per_employee / NULLIF(official_monthly_wage, 0) AS pay_ratio,
             pay_per_employee / NULLIF(lag(pay_per_employee) OVER (ORDER BY quarter), 0) - 1 AS pay_growth,
             official_monthly_wage / NULLIF(lag(official_monthly_wage) OVER (ORDER BY quarter), 0) - 1 AS official_growth
      FROM (SELECT CAST(year(ref_date) AS VARCHAR) || 'Q' || CAST(quarter(ref_date) AS VARCHAR) AS quarter,
                   sum(total_pay) / NULLIF(CAST(sum(employment) AS DOUBLE), 0) AS pay_per_employee
            FROM ({PAY_SQL}) p GROUP BY 1) p
      JOIN (SELECT CAST(year AS VARCHAR) || 'Q' || qtr AS quarter,
                   sum(total_qtrly_wages) / NULLIF((sum(month1_emplvl) + sum(month2_emplvl) + sum(month3_emplvl)) / 3.0 * 13.0, 0)
                     * 52.0 / 12.0 AS official_monthly_wage
            FROM qcew_raw WHERE own_code = '5' AND slice = 'national' GROUP BY 1) o USING (quarter)) m""")
def q_pay_vs_official(spark, d):
    return A.compare_pay_to_official(A.pay_per_employee(payroll(spark, d)),
                                     A.official_weekly_wages(synth.qcew_raw(spark, d)))


@register("reweight_quality", f"""WITH m AS (SELECT g.ref_date, g.yoy_growth, r.yoy_growth AS reweighted_yoy,
                   o.yoy_growth AS official_yoy
            FROM ({growth_sql('payroll', 'qualified_employment', [])}) g
            LEFT JOIN ({REWEIGHTED_SQL}) r USING (ref_date)
            JOIN ({growth_sql(CES_TOTAL, 'employment', [], False)}) o USING (ref_date))
    SELECT 'raw' AS series, avg(abs(yoy_growth - official_yoy)) AS mae,
           covar_samp(yoy_growth, official_yoy) / sqrt(var_samp(yoy_growth) * var_samp(official_yoy)) AS correlation,
           count(*) FILTER (WHERE yoy_growth IS NOT NULL AND official_yoy IS NOT NULL) AS n_months FROM m
    UNION ALL
    SELECT 'reweighted', avg(abs(reweighted_yoy - official_yoy)),
           covar_samp(reweighted_yoy, official_yoy) / sqrt(var_samp(reweighted_yoy) * var_samp(official_yoy)),
           count(*) FILTER (WHERE reweighted_yoy IS NOT NULL AND official_yoy IS NOT NULL) FROM m""")
def q_reweight_quality(spark, d):
    from panelscope.operators.reweight import reweighting_impact
    rg = G.compute_growth_rates(raked_one(spark, d), "qualified_employment", [], weight_col="rake_weight")
    imp = reweighting_impact(G.compute_growth_rates(payroll(spark, d), "qualified_employment", []), rg)
    return A.reweighting_quality(imp, ces_growth(spark, d))


def _bed_by_supersector(spark, d):
    b = bed(spark, d).filter((F.col("state_fips") == "00") & (F.col("naics_code") != "000000"))
    return b.groupBy(F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string")).alias("quarter"),
                     supersector_of(F.substring("naics_code", 1, 2)).alias("supersector")).agg(
        F.try_divide(F.sum("births"), F.sum("total_establishments")).alias("bed_birth_rate"))


def _lead_grouped_sql() -> str:
    from panelscope.plans.oracle import _supersector
    births = f"""SELECT ref_date, quarter, supersector, CAST(births AS DOUBLE) / NULLIF(CAST(determinable AS DOUBLE), 0)
        AS birth_rate FROM (SELECT ref_date, quarter, supersector, sum(birth_count) AS births,
                                   sum(birth_determinable_count) AS determinable
                            FROM panel WHERE grouping_level = 'supersector' GROUP BY 1, 2, 3) a"""
    off = f"""SELECT CAST(year AS VARCHAR) || 'Q' || CAST(quarter AS VARCHAR) AS quarter,
        {_supersector('substr(naics_code, 1, 2)')} AS supersector,
        sum(births) / NULLIF(sum(total_establishments), 0) AS y
      FROM bed WHERE state_fips = '00' AND naics_code <> '000000' GROUP BY 1, 2"""
    return f"""WITH m AS (SELECT quarter, supersector, x, y
            FROM (SELECT quarter, supersector, avg(birth_rate) AS x FROM ({births}) b GROUP BY 1, 2) p
            JOIN ({off}) o USING (quarter, supersector)),
      mi AS (SELECT *, row_number() OVER (PARTITION BY supersector ORDER BY quarter) - 1 AS _i,
                    count(*) OVER (PARTITION BY supersector) AS _n,
                    lag(x) OVER (PARTITION BY supersector ORDER BY quarter) AS x_lag,
                    lag(y) OVER (PARTITION BY supersector ORDER BY quarter) AS y_lag FROM m),
      l AS (SELECT supersector, 'concurrent' AS model, 1 AS _o, y, x AS x1, CAST(NULL AS DOUBLE) AS x2 FROM mi WHERE _n >= 10
            UNION ALL SELECT supersector, 'leading', 2, y, x, x_lag FROM mi WHERE _n >= 10 AND _i >= 1
            UNION ALL SELECT supersector, 'incremental', 3, y, y_lag, x_lag FROM mi WHERE _n >= 10 AND _i >= 1),
      s AS (SELECT supersector, model, _o, count(*) AS n, CAST(count(*) AS DOUBLE) AS nd, var_samp(x1) AS s11,
                   var_samp(x2) AS s22, covar_samp(x1, x2) AS s12, covar_samp(x1, y) AS s1y, covar_samp(x2, y) AS s2y,
                   var_samp(y) AS syy,
                   covar_samp(x1, x2) / sqrt(var_samp(x1) * var_samp(x2)) AS r12 FROM l GROUP BY 1, 2, 3),
      f AS (SELECT *, s1y / NULLIF(s11, 0) AS b_1, s1y * s1y / NULLIF(s11 * syy, 0) AS r2_1,
                   s11 * s22 - s12 * s12 AS dd, coalesce(r12 * r12 > 1 - 1e-9, false) AS col FROM s),
      g AS (SELECT *, (s22 * s1y - s12 * s2y) / NULLIF(dd, 0) AS b1, (s11 * s2y - s12 * s1y) / NULLIF(dd, 0) AS b2 FROM f),
      h AS (SELECT *, (b1 * s1y + b2 * s2y) / NULLIF(syy, 0) AS r2_2 FROM g)
    SELECT supersector, model, n,
      CASE WHEN _o = 1 OR col THEN r2_1 ELSE r2_2 END AS r2,
      CASE WHEN _o = 1 THEN b_1 WHEN col THEN NULL ELSE b2 END AS coef,
      CASE WHEN _o = 1 THEN b_1 / sqrt((1 - r2_1) * syy / ((nd - 2) * s11))
           WHEN col THEN NULL ELSE b2 / sqrt((1 - r2_2) * syy * s11 / ((nd - 3) * dd)) END AS t,
      CASE WHEN _o = 1 THEN nd - 2 ELSE nd - 3 END AS dof
    FROM h"""


@register("birth_lead_by_supersector", _lead_grouped_sql())
def q_birth_lead_ss(spark, d):
    pb = B.compute_payroll_birth_rates(panel_at(spark, d, "supersector"), ["supersector"])
    return B.birth_lead_models(pb, _bed_by_supersector(spark, d), ["supersector"]).select(
        "supersector", "model", "n", "r2", "coef", "t", "dof")


def _geo(spark, d):
    return A.add_geography_and_domain(payroll(spark, d))


REGION_CASE = "CASE " + " ".join(f"WHEN state_fips = '{s}' THEN '{A.DIVISION_REGION[v]}'"
                                 for s, v in A.STATE_DIVISION.items()) + " ELSE 'Unknown' END"
DOMAIN_CASE = ("CASE WHEN supersector IN (" + ", ".join(f"'{x}'" for x in A.GOODS_PRODUCING)
               + ") THEN 'Goods-producing' ELSE 'Service-providing' END")


def _flows_by_sql(expr: str, name: str) -> str:
    src = f"(SELECT *, {expr} AS {name} FROM payroll)"
    return flows_entry_exit_sql([name]).replace("FROM payroll GROUP BY", f"FROM {src} p GROUP BY")


@register("flows_region", _flows_by_sql(REGION_CASE, "census_region"))
def q_flows_region(spark, d):
    return FL.compute_job_flows(_geo(spark, d), ["census_region"], "entry_exit")


@register("flows_domain", _flows_by_sql(DOMAIN_CASE, "domain"))
def q_flows_domain(spark, d):
    return FL.compute_job_flows(_geo(spark, d), ["domain"], "entry_exit")


def _all_levels_sql() -> str:
    offs = {"national": "off_national", "supersector": "off_supersector", "state": "off_state",
            "supersector_state": "off_supersector_state", "size_class": "off_size_class",
            "supersector_size_class": "off_supersector_size_class"}
    parts = []
    for level, cols in AGGREGATION_LEVELS:
        keys = ["ref_date", "quarter"] + cols
        sel_keys = ", ".join(f"p.{k}" if k in keys else f"CAST(NULL AS VARCHAR) AS {k}"
                             for k in ["ref_date", "quarter", "supersector", "state_fips", "size_class"])
        meas = ", ".join(f"p.{m}" if m != "client_count" else "p.client_count AS payroll_clients" for m in PANEL_MEASURES)
        if level in offs:
            on = " AND ".join(f"p.{k} = o.{k}" for k in keys)
            src = f"LEFT JOIN {offs[level]} o ON {on}"
            oc = "o.qcew_employment, o.qcew_establishments"
        else:
            src = ""
            oc = "CAST(NULL AS BIGINT) AS qcew_employment, CAST(NULL AS BIGINT) AS qcew_establishments"
        parts.append(f"""SELECT '{level}' AS grouping_level, {sel_keys}, {meas}, {oc}
          FROM (SELECT * FROM panel WHERE grouping_level = '{level}') p {src}""")
    body = " UNION ALL ".join(parts)
    return f"""SELECT *, CAST(payroll_employment AS DOUBLE) / NULLIF(CAST(qcew_employment AS DOUBLE), 0)
        AS coverage_ratio_employment,
      CAST(payroll_clients AS DOUBLE) / NULLIF(CAST(qcew_establishments AS DOUBLE), 0) AS coverage_ratio_estab,
      CASE WHEN CAST(payroll_employment AS DOUBLE) / NULLIF(CAST(qcew_employment AS DOUBLE), 0) IS NULL THEN 'insufficient'
           WHEN payroll_clients >= 30 AND CAST(payroll_employment AS DOUBLE) / NULLIF(CAST(qcew_employment AS DOUBLE), 0) >= 0.005
             THEN 'reliable'
           WHEN payroll_clients < 30 AND CAST(payroll_employment AS DOUBLE) / NULLIF(CAST(qcew_employment AS DOUBLE), 0) < 0.005
             THEN 'insufficient'
           ELSE 'marginal' END AS reliability
    FROM ({body}) u"""


@register("coverage_all_levels", _all_levels_sql())
def q_coverage_all_levels(spark, d):
    """Size levels have official values in first-quarter months only; in others they are NULL and 'insufficient'."""
    offs = {level: official(spark, d, cols, SLICES[level]) for level, cols in AGGREGATION_LEVELS}
    return A.coverage_all_levels(panel(spark, d), offs)


@register("winsorised_pay", f"""SELECT p.* REPLACE (CASE WHEN p.gross_pay IS NULL THEN NULL
                                           ELSE least(greatest(p.gross_pay, b._lo), b._hi) END AS gross_pay)
    FROM payroll p LEFT JOIN (
      SELECT ref_date, {nearest_sql('gross_pay', 0.01)} AS _lo, {nearest_sql('gross_pay', 0.99)} AS _hi
      FROM (SELECT ref_date, gross_pay, row_number() OVER (PARTITION BY ref_date ORDER BY gross_pay) AS _rank,
                   count(*) OVER (PARTITION BY ref_date) AS _n FROM payroll WHERE gross_pay IS NOT NULL) r
      GROUP BY ref_date) b ON p.ref_date IS NOT DISTINCT FROM b.ref_date""")
def q_winsorised(spark, d):
    return A.winsorise(payroll(spark, d), "gross_pay", ["ref_date"])


@register("dq_clean_rows", f"SELECT * FROM ({DQ_ROWS_SQL}) r WHERE NOT has_any_flag")
def q_dq_clean(spark, d):
    return A.exclude_flagged(Q.flag_data_quality_issues(payroll(spark, d))[0])


# ---------------------------------------------------------------- remaining loaders and chart series

from panelscope.plans.queries_births import official_births  # noqa: E402
from panelscope.plans.queries_core import entry_exit_sql  # noqa: E402
from panelscope.plans.queries_dynamics import (SHIFT_SQL, compare_sql, earnings_sql,  # noqa: E402
                                               payroll_growth)
from panelscope.sources.official import STATE_FIPS, qcew_quarterly_dates  # noqa: E402


@register("qcew_quarterly", """SELECT area_fips, own_code, industry_code, agglvl_code, size_code, year, qtr,
      month1_emplvl AS qcew_employment, month2_emplvl, month3_emplvl, qtrly_estabs_count AS qcew_establishments,
      total_qtrly_wages, slice, make_date(CAST(year AS INTEGER), (CAST(qtr AS INTEGER) - 1) * 3 + 1, 12) AS ref_date,
      CAST(year AS VARCHAR) || 'Q' || qtr AS quarter FROM qcew_raw""")
def q_qcew_quarterly(spark, d):
    return qcew_quarterly_dates(synth.qcew_raw(spark, d))


_STATES = ", ".join(f"'{s}'" for s in STATE_FIPS)


@register("state_fips_validity", f"""SELECT ref_date, count(*) AS n_rows,
      count(*) FILTER (WHERE state_fips IN ({_STATES})) AS n_valid_state,
      CAST(count(*) FILTER (WHERE state_fips IN ({_STATES})) AS DOUBLE) / NULLIF(count(*), 0) AS state_validity_rate
    FROM payroll GROUP BY ref_date""")
def q_state_validity(spark, d):
    p = payroll(spark, d)
    return p.groupBy("ref_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("state_fips").isin(STATE_FIPS)).alias("n_valid_state"),
    ).withColumn("state_validity_rate", F.try_divide(F.col("n_valid_state").cast("double"), F.col("n_rows").cast("double")))


@register("birth_rates_quarterly", """SELECT quarter, births, determinable,
      CAST(births AS DOUBLE) / NULLIF(CAST(determinable AS DOUBLE), 0) AS birth_rate
    FROM (SELECT quarter, CAST(sum(birth_count) AS BIGINT) AS births,
                 CAST(sum(birth_determinable_count) AS BIGINT) AS determinable
          FROM panel WHERE grouping_level = 'national' GROUP BY quarter) a""")
def q_birth_rates_quarterly(spark, d):
    return B.quarterly_birth_rates(panel_at(spark, d, "national"), [])


@register("growth_tracking", f"SELECT ref_date, payroll_yoy, ces_yoy FROM ({compare_sql([])}) c")
def q_growth_tracking(spark, d):
    return X.growth_tracking(G.compare_growth(payroll_growth(spark, d), ces_growth(spark, d), []))


@register("divergence_stack", f"""SELECT quarter, composition_effect, within_cell_effect,
      sum(composition_effect + within_cell_effect) OVER (ORDER BY quarter ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS cumulative_divergence FROM ({SHIFT_SQL}) s""")
def q_divergence_stack(spark, d):
    from panelscope.plans.queries_dynamics import ces_quarterly
    return X.divergence_stack(G.decompose_growth_divergence(panel_at(spark, d, "supersector"),
                                                            ces_quarterly(spark, d, False), ["supersector"]))


@register("birth_rate_pairs", f"""SELECT p.ref_date, p.quarter, p.birth_rate, o.bed_birth_rate
    FROM ({BIRTH_SQL}) p LEFT JOIN bed_national o USING (quarter)""")
def q_birth_rate_pairs(spark, d):
    return X.birth_rate_pairs(B.compare_birth_rates(payroll_births(spark, d), official_births(spark, d), []))


@register("reweighting_series", f"""SELECT g.ref_date, g.yoy_growth AS payroll_yoy,
      coalesce(r.yoy_growth, g.yoy_growth) AS reweighted_yoy, o.yoy_growth AS ces_yoy
    FROM ({growth_sql('payroll', 'qualified_employment', [])}) g
    LEFT JOIN ({REWEIGHTED_SQL}) r USING (ref_date)
    LEFT JOIN ({growth_sql(CES_TOTAL, 'employment', [], False)}) o USING (ref_date)""")
def q_reweighting_series(spark, d):
    from panelscope.operators.reweight import reweighting_impact
    rg = G.compute_growth_rates(raked_one(spark, d), "qualified_employment", [], weight_col="rake_weight")
    imp = reweighting_impact(payroll_growth(spark, d), rg)
    return X.reweighting_series(imp, ces_growth(spark, d))


@register("flow_rate_series", f"""SELECT ref_date, hire_rate, separation_rate, churn_rate
    FROM ({flows_entry_exit_sql([])}) f""")
def q_flow_rate_series(spark, d):
    return X.flow_rate_series(FL.compute_job_flows(payroll(spark, d), []))


@register("churn_series", f"SELECT ref_date, entry_rate, exit_rate, net_client_change FROM ({entry_exit_sql([])}) e")
def q_churn_series(spark, d):
    return X.churn_series(T.compute_client_entry_exit(payroll(spark, d), []))


@register("earnings_band", f"SELECT ref_date, p10_earnings, median_earnings, p90_earnings FROM ({earnings_sql([])}) e")
def q_earnings_band(spark, d):
    from panelscope.operators.earnings import compute_earnings_distribution
    return X.earnings_band(compute_earnings_distribution(payroll(spark, d), []))


DIVISION_CASE = "CASE " + " ".join(f"WHEN state_fips = '{s}' THEN '{v}'" for s, v in A.STATE_DIVISION.items()) \
    + " ELSE 'Unknown' END"


@register("flows_division", _flows_by_sql(DIVISION_CASE, "census_division"))
def q_flows_division(spark, d):
    return FL.compute_job_flows(_geo(spark, d), ["census_division"], "entry_exit")


@register("flows_naics2", flows_entry_exit_sql(["naics2"]))
def q_flows_naics2(spark, d):
    return FL.compute_job_flows_by_industry(payroll(spark, d), "naics2", source="entry_exit")


# ---------------------------------------------------------------- further groupings, survival with censoring, loaders

def _churn_by_sql(expr: str, name: str) -> str:
    return entry_exit_sql([name]).replace("FROM payroll GROUP BY", f"FROM (SELECT *, {expr} AS {name} FROM payroll) p GROUP BY")


for _name, _col, _expr in (("churn_region", "census_region", REGION_CASE), ("churn_division", "census_division", DIVISION_CASE),
                           ("churn_domain", "domain", DOMAIN_CASE)):
    register(_name, _churn_by_sql(_expr, _col))(lambda spark, d, _c=_col: T.compute_client_entry_exit(_geo(spark, d), [_c]))


@register("churn_naics2", entry_exit_sql(["naics2"]))
def q_churn_naics2(spark, d):
    return T.compute_client_entry_exit(payroll(spark, d), ["naics2"])


def _cross_grouped_sql() -> str:
    lead = _lead_grouped_sql()
    merged = lead[:lead.index("      l AS (SELECT")].rstrip().rstrip(",")
    return f"""{merged},
      pairs AS (SELECT a.supersector, CAST(l.lag AS INTEGER) AS lag, a.x, b.y
                FROM mi a JOIN (SELECT unnest(range(0, 5)) AS lag) l ON true
                JOIN mi b ON b.supersector = a.supersector AND b._i = a._i + l.lag WHERE a._n >= 4)
    SELECT supersector, lag, coalesce(covar_samp(x, y) / NULLIF(sqrt(var_samp(x) * var_samp(y)), 0), 0.0) AS correlation
    FROM pairs GROUP BY supersector, lag"""


def _lags_grouped_sql() -> str:
    lead = _lead_grouped_sql()
    return lag_regression_sql(lead[:lead.index("      l AS (SELECT")].rstrip().rstrip(","), ["supersector"])


@register("birth_lead_lags_supersector", _lags_grouped_sql())
def q_birth_lead_lags_ss(spark, d):
    pb = B.compute_payroll_birth_rates(panel_at(spark, d, "supersector"), ["supersector"])
    return B.birth_lead_lags(pb, _bed_by_supersector(spark, d), grouping_cols=["supersector"])


@register("cross_correlation_supersector", _cross_grouped_sql())
def q_cross_correlation_ss(spark, d):
    pb = B.compute_payroll_birth_rates(panel_at(spark, d, "supersector"), ["supersector"])
    return B.compute_cross_correlation(pb, _bed_by_supersector(spark, d), 4, ["supersector"])


def _kaplan_meier_sql() -> str:
    cols = ", ".join(
        f"""CASE WHEN max(CASE WHEN t < {m} AND f = n THEN 1 END) = 1 THEN 0.0 WHEN sum(CASE WHEN t >= {m} THEN m ELSE 0 END) > 0
            THEN coalesce(product(CASE WHEN t < {m} THEN 1 - CAST(f AS DOUBLE) / n END), 1.0) END AS {name}"""
        for name, m in B.SURVIVAL_HORIZONS.items())
    return f"""WITH b AS (SELECT DISTINCT client_id, entry_month FROM payroll WHERE is_birth),
      l AS (SELECT client_id, max(ref_date) AS last_seen FROM payroll GROUP BY client_id),
      c AS (SELECT CAST(year(entry_month) AS VARCHAR) || 'Q' || CAST(quarter(entry_month) AS VARCHAR) AS entry_quarter,
                   date_diff('day', entry_month, last_seen) / 30.0 AS t,
                   CASE WHEN last_seen < (SELECT max(ref_date) FROM payroll) THEN 1 ELSE 0 END AS failed FROM b JOIN l USING (client_id)),
      g AS (SELECT entry_quarter, t, sum(failed) AS f, count(*) AS m FROM c GROUP BY 1, 2),
      h AS (SELECT a.entry_quarter, a.t, a.f, a.m, (SELECT sum(m) FROM g z WHERE z.entry_quarter = a.entry_quarter AND z.t >= a.t) AS n FROM g a)
    SELECT entry_quarter, CAST(sum(m) AS BIGINT) AS birth_cohort_n, CAST(sum(f) AS BIGINT) AS failures, {cols} FROM h GROUP BY entry_quarter"""


@register("survival_km", _kaplan_meier_sql())
def q_survival_km(spark, d):
    return B.compute_kaplan_meier(payroll(spark, d))


@register("load_employees", "SELECT * FROM employees")
def q_load_employees(spark, d):
    return synth.employees(spark, d)
