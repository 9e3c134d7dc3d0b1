"""Queries for loaders, panel, coverage, composition, data quality and tenure."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscope.operators import coverage as C
from panelscope.operators import panel as P
from panelscope.operators import quality as Q
from panelscope.operators import tenure as T
from panelscope.plans.catalog import register
from panelscope.plans.inputs import official, official_long, panel, panel_at, payroll
from panelscope.sources import synth

MEASURES = ", ".join(P.PANEL_MEASURES)

# level -> (official CTE, key columns)
LEVELS = {
    "national": ("off_national", []),
    "supersector": ("off_supersector", ["supersector"]),
    "state": ("off_state", ["state_fips"]),
    "supersector_state": ("off_supersector_state", ["supersector", "state_fips"]),
    "size_class": ("off_size_class", ["size_class"]),
    "supersector_size_class": ("off_supersector_size_class", ["supersector", "size_class"]),
}
SLICES = {"national": "national", "supersector": "national", "state": "state", "supersector_state": "state", "size_class": "size",
          "supersector_size_class": "size"}


def panel_level_sql(level: str) -> str:
    cols = dict(P.AGGREGATION_LEVELS)[level]
    sel = ", ".join(["ref_date", "quarter"] + cols)
    return f"SELECT {sel}, {MEASURES} FROM panel WHERE grouping_level = '{level}'"


def coverage_sql(level: str) -> str:
    off, cols = LEVELS[level]
    keys = ["ref_date", "quarter"] + cols
    on = " AND ".join(f"p.{k} = o.{k}" for k in keys)
    pk = ", ".join(f"p.{k}" for k in keys)
    return f"""SELECT {pk}, p.payroll_employment, p.client_count AS payroll_clients, p.birth_count,
      p.birth_determinable_count, p.entry_count, p.exit_count, p.continuing_employment,
      o.qcew_employment, o.qcew_establishments,
      CAST(p.payroll_employment AS DOUBLE) / NULLIF(CAST(o.qcew_employment AS DOUBLE), 0) AS coverage_ratio_employment,
      CAST(p.client_count AS DOUBLE) / NULLIF(CAST(o.qcew_establishments AS DOUBLE), 0) AS coverage_ratio_estab
    FROM ({panel_level_sql(level)}) p LEFT JOIN {off} o ON {on}"""


def coverage_df(spark, d, level):
    _, cols = LEVELS[level]
    return C.compute_coverage(panel_at(spark, d, level), official(spark, d, cols, SLICES[level]), cols)


@register("load_payroll", "SELECT * FROM payroll")
def q_load_payroll(spark, d):
    return payroll(spark, d)


@register("size_class", """SELECT size_class, count(*) AS client_months,
    CAST(sum(qualified_employment) AS BIGINT) AS employment FROM payroll GROUP BY size_class""")
def q_size_class(spark, d):
    return payroll(spark, d).groupBy("size_class").agg(
        F.count(F.lit(1)).alias("client_months"), F.sum("qualified_employment").alias("employment"))


@register("panel_all_levels", "SELECT * FROM panel")
def q_panel(spark, d):
    return panel(spark, d)


@register("qcew_unpivot", """SELECT area_fips, own_code, industry_code, agglvl_code, size_code, year, qtr,
    qcew_establishments, total_qtrly_wages, slice, qcew_employment, ref_date, quarter, supersector, state_fips
    FROM qcew_long""")
def q_qcew_unpivot(spark, d):
    return official_long(spark, d).drop("size_class")


for _lvl in ("national", "supersector", "state", "size_class"):
    register(f"coverage_{_lvl}", coverage_sql(_lvl))(
        lambda spark, d, _l=_lvl: coverage_df(spark, d, _l))


@register("cell_reliability", f"""SELECT *, CASE
      WHEN coverage_ratio_employment IS NULL THEN 'insufficient'
      WHEN payroll_clients >= 30 AND coverage_ratio_employment >= 0.005 THEN 'reliable'
      WHEN payroll_clients < 30 AND coverage_ratio_employment < 0.005 THEN 'insufficient'
      ELSE 'marginal' END AS reliability
    FROM ({coverage_sql('supersector_state')}) c""")
def q_cell_reliability(spark, d):
    return C.compute_cell_reliability(coverage_df(spark, d, "supersector_state"))


def share_sql(dim: str, level: str) -> str:
    off, _ = LEVELS[level]
    return f"""SELECT ref_date, quarter, {dim}, payroll_share, qcew_share,
      abs(coalesce(payroll_share, 0) - coalesce(qcew_share, 0)) AS abs_dev,
      sum(abs(coalesce(payroll_share, 0) - coalesce(qcew_share, 0))) OVER (PARTITION BY ref_date, quarter) / 2
        AS misallocation_index
    FROM (SELECT ref_date, quarter, {dim}, CAST(payroll_employment AS DOUBLE)
                 / NULLIF(CAST(sum(payroll_employment) OVER (PARTITION BY ref_date, quarter) AS DOUBLE), 0) AS payroll_share
          FROM ({panel_level_sql(level)}) x) p
    FULL OUTER JOIN
         (SELECT ref_date, quarter, {dim}, CAST(qcew_employment AS DOUBLE)
                 / NULLIF(CAST(sum(qcew_employment) OVER (PARTITION BY ref_date, quarter) AS DOUBLE), 0) AS qcew_share
          FROM {off}) o
    USING (ref_date, quarter, {dim})"""


@register("share_comparison", share_sql("supersector", "supersector"))
def q_share(spark, d):
    return C.compute_share_comparison(panel_at(spark, d, "supersector"),
                                      official(spark, d, ["supersector"], "national"), "supersector")


@register("share_comparison_state", share_sql("state_fips", "state"))
def q_share_state(spark, d):
    return C.compute_share_comparison(panel_at(spark, d, "state"),
                                      official(spark, d, ["state_fips"], "state"), "state_fips")


@register("share_comparison_size", share_sql("size_class", "size_class"))
def q_share_size(spark, d):
    """Months outside the first quarter have no official size rows: their official share is NULL."""
    return C.compute_share_comparison(panel_at(spark, d, "size_class"), official(spark, d, ["size_class"], "size"), "size_class")


@register("csi_dense", f"""WITH p AS (SELECT ref_date, supersector, state_fips, CAST(payroll_employment AS DOUBLE)
                 / NULLIF(CAST(sum(payroll_employment) OVER (PARTITION BY ref_date) AS DOUBLE), 0) AS share
               FROM ({panel_level_sql('supersector_state')}) x),
      grid AS (SELECT * FROM (SELECT DISTINCT ref_date FROM p) a, (SELECT DISTINCT supersector, state_fips FROM p) b),
      s AS (SELECT ref_date, supersector, state_fips, coalesce(share, 0.0) AS share FROM grid LEFT JOIN p USING (ref_date, supersector, state_fips))
    SELECT ref_date, sum(shift) AS csi FROM (SELECT ref_date, coalesce(abs(share - lag(share) OVER (PARTITION BY supersector, state_fips
      ORDER BY ref_date)), 0.0) AS shift FROM s) y GROUP BY ref_date""")
def q_csi_dense(spark, d):
    cells = panel_at(spark, d, "supersector_state").withColumn("cell", F.struct("supersector", "state_fips"))
    return C.compute_composition_shift_index(cells, "cell", dense=True)


def csi_sql(dim: str, level: str) -> str:
    return f"""SELECT ref_date, coalesce(sum(abs_shift), 0.0) AS csi FROM (
      SELECT ref_date, abs(share - lag(share) OVER (PARTITION BY {dim} ORDER BY ref_date)) AS abs_shift FROM (
        SELECT ref_date, {dim}, CAST(payroll_employment AS DOUBLE)
               / NULLIF(CAST(sum(payroll_employment) OVER (PARTITION BY ref_date) AS DOUBLE), 0) AS share
        FROM ({panel_level_sql(level)}) x) y) z GROUP BY ref_date"""


for _dim, _lvl in (("supersector", "supersector"), ("state_fips", "state"), ("size_class", "size_class")):
    register(f"csi_{_lvl}", csi_sql(_dim, _lvl))(
        lambda spark, d, _d=_dim, _l=_lvl: C.compute_composition_shift_index(panel_at(spark, d, _l), _d))


@register("stable_panel", """SELECT * FROM payroll WHERE client_id IN (
    SELECT client_id FROM payroll GROUP BY client_id
    HAVING date_diff('day', min(ref_date), max(ref_date)) / 30.0 >= 12)""")
def q_stable(spark, d):
    return P.filter_stable_panel(payroll(spark, d), 12)


DQ_ROWS_SQL = """SELECT * EXCLUDE (_prev, _first_obs),
      flag_extreme_change OR flag_zero_employment OR flag_multi_client OR flag_filing_anomaly AS has_any_flag
    FROM (
      SELECT *, coalesce(_prev IS NOT NULL AND _prev > 0 AND abs(qualified_employment - _prev) / _prev > 0.5, false)
               AS flag_extreme_change,
             qualified_employment = 0 AS flag_zero_employment,
             false AS flag_multi_client,
             coalesce(filing_date IS NOT NULL AND filing_date > _first_obs, false) AS flag_filing_anomaly
      FROM (SELECT *, lag(qualified_employment) OVER (PARTITION BY client_id ORDER BY ref_date, qualified_employment) AS _prev,
                   min(ref_date) OVER (PARTITION BY client_id) AS _first_obs FROM payroll) a) b"""

DQ_SUMMARY_COLS = """count(*) FILTER (WHERE flag_extreme_change) AS extreme_change_count,
      count(*) FILTER (WHERE flag_zero_employment) AS zero_employment_count,
      count(*) FILTER (WHERE flag_multi_client) AS multi_client_count,
      count(*) FILTER (WHERE flag_filing_anomaly) AS filing_anomaly_count,
      count(*) FILTER (WHERE has_any_flag) AS total_flagged, count(*) AS total_records"""


@register("dq_flags", DQ_ROWS_SQL)
def q_dq_flags(spark, d):
    return Q.flag_data_quality_issues(payroll(spark, d))[0]


@register("dq_summary", f"SELECT ref_date, {DQ_SUMMARY_COLS} FROM ({DQ_ROWS_SQL}) r GROUP BY ref_date")
def q_dq_summary(spark, d):
    return Q.flag_data_quality_issues(payroll(spark, d))[1]


@register("dq_summary_employees", f"""SELECT ref_date, {DQ_SUMMARY_COLS} FROM (
      SELECT *, flag_extreme_change OR flag_zero_employment OR flag_multi_client OR flag_filing_anomaly AS has_any_flag
      FROM (SELECT e.ref_date, coalesce(c.prev > 0 AND abs(c.emp - c.prev) / c.prev > 0.5, false) AS flag_extreme_change,
                   e.qualified_employment = 0 AS flag_zero_employment, coalesce(m.n > 1, false) AS flag_multi_client,
                   false AS flag_filing_anomaly
            FROM employees e
            LEFT JOIN (SELECT ref_date, employee_id, count(DISTINCT client_id) AS n FROM employees GROUP BY 1, 2) m
              USING (ref_date, employee_id)
            LEFT JOIN (SELECT client_id, ref_date, emp, lag(emp) OVER (PARTITION BY client_id ORDER BY ref_date) AS prev
                       FROM (SELECT client_id, ref_date, sum(qualified_employment) AS emp FROM employees GROUP BY 1, 2) s) c
              USING (client_id, ref_date)) x) r GROUP BY ref_date""")
def q_dq_summary_emp(spark, d):
    return Q.flag_data_quality_issues(synth.employees(spark, d))[1]


@register("client_tenure", """SELECT client_id, min(ref_date) AS first_observed, max(ref_date) AS last_observed,
      count(DISTINCT ref_date) AS months_observed, arg_min(qualified_employment, ref_date) AS initial_emp,
      arg_max(qualified_employment, ref_date) AS final_emp, avg(qualified_employment) AS avg_emp,
      arg_min_null(is_birth, ref_date) AS is_likely_birth,
      CAST(round(date_diff('day', min(ref_date), max(ref_date)) / 30.0) AS BIGINT) AS tenure_months
    FROM payroll GROUP BY client_id""")
def q_client_tenure(spark, d):
    return T.compute_client_tenure(payroll(spark, d))


def entry_exit_sql(groups: list[str]) -> str:
    g = "".join(f", {c}" for c in groups)
    return f"""SELECT *, CAST(entries AS DOUBLE) / NULLIF(active_clients, 0) AS entry_rate,
      CAST(exits AS DOUBLE) / NULLIF(active_clients, 0) AS exit_rate,
      CAST(entries + exits AS DOUBLE) / NULLIF(active_clients, 0) AS churn_rate,
      entries - exits AS net_client_change
    FROM (SELECT ref_date{g}, count(DISTINCT client_id) AS active_clients,
            count(*) FILTER (WHERE entry_month = ref_date) AS entries,
            count(*) FILTER (WHERE exit_month = ref_date) AS exits
          FROM payroll GROUP BY ref_date{g}) a"""


for _name, _g in (("entry_exit", []), ("churn_state", ["state_fips"]), ("churn_industry", ["supersector"]),
                  ("churn_size", ["size_class"])):
    register(_name, entry_exit_sql(_g))(
        lambda spark, d, _gg=_g: T.compute_client_entry_exit(payroll(spark, d), _gg))


VINTAGE_SQL = """SELECT ref_date, vintage_year, CAST(sum(qualified_employment) AS BIGINT) AS employment,
      count(DISTINCT client_id) AS client_count
    FROM payroll JOIN (SELECT client_id, CAST(year(min(ref_date)) AS INTEGER) AS vintage_year
                       FROM payroll GROUP BY client_id) v USING (client_id)
    GROUP BY ref_date, vintage_year"""


@register("vintage", VINTAGE_SQL)
def q_vintage(spark, d):
    return T.compute_vintage_analysis(payroll(spark, d), [])


@register("vintage_shares", f"""SELECT *, vintage_year = max(vintage_year) OVER (PARTITION BY ref_date)
      AND employment_share > 0.3 AS is_contaminated FROM (
      SELECT *, CAST(employment AS DOUBLE) / NULLIF(total_emp, 0) AS employment_share FROM (
        SELECT *, CAST(sum(employment) OVER (PARTITION BY ref_date) AS BIGINT) AS total_emp FROM ({VINTAGE_SQL}) v) a) b""")
def q_vintage_shares(spark, d):
    return T.compute_vintage_shares(payroll(spark, d))


def nearest_sql(value: str, q: float) -> str:
    return f"max(CASE WHEN _rank = floor((_n - 1) * {q} + 0.5) + 1 THEN {value} END)"


def median_sql(value: str) -> str:
    return (f"(max(CASE WHEN _rank = floor((_n - 1) / 2) + 1 THEN {value} END)"
            f" + max(CASE WHEN _rank = floor(_n / 2) + 1 THEN {value} END)) / 2.0")


@register("tenure_summary", f"""SELECT supersector, avg(tenure_months) AS mean_tenure,
      {median_sql('tenure_months')} AS median_tenure, {nearest_sql('tenure_months', 0.25)} AS p25_tenure,
      {nearest_sql('tenure_months', 0.75)} AS p75_tenure, stddev_samp(tenure_months) AS std_tenure,
      count(DISTINCT client_id) AS client_count
    FROM (SELECT *, row_number() OVER (PARTITION BY supersector ORDER BY tenure_months) AS _rank,
                 count(*) OVER (PARTITION BY supersector) AS _n
          FROM (SELECT client_id, arg_min(supersector, ref_date) AS supersector,
                  CAST(round(date_diff('day', min(ref_date), max(ref_date)) / 30.0) AS BIGINT) AS tenure_months
                FROM payroll GROUP BY client_id) t) r
    GROUP BY supersector""")
def q_tenure_summary(spark, d):
    return T.tenure_summary_by_group(payroll(spark, d), "supersector")
