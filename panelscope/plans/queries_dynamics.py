"""Queries for growth, decompositions, turning points, worker flows and earnings."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscope.functions.cols import quarter_label
from panelscope.operators import earnings as E
from panelscope.operators import flows as FL
from panelscope.operators import growth as G
from panelscope.plans.catalog import register
from panelscope.plans.inputs import ces, panel_at, payroll
from panelscope.plans.queries_core import median_sql, nearest_sql, panel_level_sql
from panelscope.sources import synth

TOTAL = "Total private"


def _g(groups):
    return "".join(f", {c}" for c in groups)


def growth_sql(source: str, col: str, groups: list[str], cast_bigint: bool = True) -> str:
    part = f"PARTITION BY {', '.join(groups)} " if groups else ""
    s = f"CAST(sum({col}) AS BIGINT)" if cast_bigint else f"sum({col})"
    return f"""SELECT ref_date{_g(groups)}, employment,
      CAST(employment AS DOUBLE) / NULLIF(CAST(lag(employment, 1) OVER ({part}ORDER BY ref_date) AS DOUBLE), 0) - 1
        AS mom_growth,
      CAST(employment AS DOUBLE) / NULLIF(CAST(lag(employment, 12) OVER ({part}ORDER BY ref_date) AS DOUBLE), 0) - 1
        AS yoy_growth
    FROM (SELECT ref_date{_g(groups)}, {s} AS employment FROM {source} GROUP BY ref_date{_g(groups)}) a"""


CES_TOTAL = f"(SELECT * FROM ces WHERE supersector = '{TOTAL}')"
CES_CELLS = f"(SELECT * FROM ces WHERE supersector <> '{TOTAL}')"


def payroll_growth(spark, d, groups=()):
    return G.compute_growth_rates(payroll(spark, d), "qualified_employment", list(groups))


def ces_growth(spark, d, total=True, groups=()):
    c = ces(spark, d)
    c = c.filter(F.col("supersector") == TOTAL) if total else c.filter(F.col("supersector") != TOTAL)
    return G.compute_growth_rates(c, "employment", list(groups))


@register("ces_normalise", "SELECT * FROM ces")
def q_ces(spark, d):
    return ces(spark, d)


@register("growth_national", growth_sql("payroll", "qualified_employment", []))
def q_growth_national(spark, d):
    return payroll_growth(spark, d)


@register("growth_supersector", growth_sql("payroll", "qualified_employment", ["supersector"]))
def q_growth_supersector(spark, d):
    return payroll_growth(spark, d, ["supersector"])


@register("growth_ces", growth_sql(CES_TOTAL, "employment", [], False))
def q_growth_ces(spark, d):
    return ces_growth(spark, d)


def compare_sql(groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)} " if groups else ""
    on = " AND ".join(f"p.{k} = o.{k}" for k in ["ref_date"] + groups)
    keys = ", ".join(f"p.{k}" for k in ["ref_date"] + groups)
    return f"""SELECT *, CASE WHEN count(CASE WHEN payroll_yoy IS NOT NULL AND ces_yoy IS NOT NULL THEN 1 END)
          OVER w = 12 THEN corr(payroll_yoy, ces_yoy) OVER w END AS rolling_corr_12
      FROM (SELECT {keys}, p.yoy_growth AS payroll_yoy, o.yoy_growth AS ces_yoy,
                   p.yoy_growth - o.yoy_growth AS growth_diff, abs(p.yoy_growth - o.yoy_growth) AS abs_diff
            FROM ({growth_sql('payroll', 'qualified_employment', groups)}) p
            JOIN ({growth_sql(CES_TOTAL if not groups else CES_CELLS, 'employment', groups, False)}) o ON {on}) m
      WINDOW w AS ({part}ORDER BY ref_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""


@register("compare_growth", compare_sql([]))
def q_compare_growth(spark, d):
    return G.compare_growth(payroll_growth(spark, d), ces_growth(spark, d), [])


@register("compare_growth_supersector", compare_sql(["supersector"]))
def q_compare_growth_ss(spark, d):
    return G.compare_growth(payroll_growth(spark, d, ["supersector"]),
                            ces_growth(spark, d, False, ["supersector"]), ["supersector"])


def ces_quarterly(spark, d, total):
    c = ces(spark, d)
    c = c.filter(F.col("supersector") == TOTAL) if total else c.filter(F.col("supersector") != TOTAL)
    return c.withColumn("quarter", quarter_label("ref_date"))


SHIFT_SQL = f"""SELECT quarter, composition_effect + within_cell_effect AS total_divergence, composition_effect,
      within_cell_effect FROM (
      SELECT quarter, coalesce(sum((w_p - w_o) * g_o), 0.0) AS composition_effect,
             coalesce(sum(w_p * (g_p - g_o)), 0.0) AS within_cell_effect
      FROM (SELECT quarter, supersector, CAST(p_emp AS DOUBLE) / NULLIF(sum(p_emp) OVER (PARTITION BY quarter), 0) AS w_p,
                   CAST(p_emp AS DOUBLE) / NULLIF(lag(p_emp) OVER (PARTITION BY supersector ORDER BY quarter), 0) - 1 AS g_p
            FROM (SELECT quarter, supersector, sum(payroll_employment) AS p_emp
                  FROM ({panel_level_sql('supersector')}) x GROUP BY quarter, supersector) a) p
      JOIN (SELECT quarter, supersector, o_emp / NULLIF(sum(o_emp) OVER (PARTITION BY quarter), 0) AS w_o,
                   o_emp / NULLIF(lag(o_emp) OVER (PARTITION BY supersector ORDER BY quarter), 0) - 1 AS g_o
            FROM (SELECT CAST(year(ref_date) AS VARCHAR) || 'Q' || CAST(quarter(ref_date) AS VARCHAR) AS quarter,
                         supersector, sum(employment) AS o_emp
                  FROM {CES_CELLS} c GROUP BY 1, 2) b) o
      USING (quarter, supersector)
      GROUP BY quarter) r"""


@register("shift_share", SHIFT_SQL)
def q_shift_share(spark, d):
    return G.decompose_growth_divergence(panel_at(spark, d, "supersector"), ces_quarterly(spark, d, False),
                                         ["supersector"])


@register("divergence_simple", f"""SELECT quarter,
      (_p / NULLIF(lag(_p) OVER (ORDER BY quarter), 0) - 1) - (_o / NULLIF(lag(_o) OVER (ORDER BY quarter), 0) - 1)
        AS total_divergence, CAST(0.0 AS DOUBLE) AS composition_effect,
      (_p / NULLIF(lag(_p) OVER (ORDER BY quarter), 0) - 1) - (_o / NULLIF(lag(_o) OVER (ORDER BY quarter), 0) - 1)
        AS within_cell_effect
    FROM (SELECT quarter, CAST(sum(payroll_employment) AS DOUBLE) AS _p FROM ({panel_level_sql('national')}) x
          GROUP BY quarter) p
    JOIN (SELECT CAST(year(ref_date) AS VARCHAR) || 'Q' || CAST(quarter(ref_date) AS VARCHAR) AS quarter,
                 sum(employment) AS _o FROM {CES_TOTAL} c GROUP BY 1) o USING (quarter)""")
def q_divergence_simple(spark, d):
    return G.decompose_growth_divergence(panel_at(spark, d, "national"), ces_quarterly(spark, d, True), [])


def change_sql(groups: list[str]) -> str:
    g = _g(groups)
    return f"""WITH idx AS (SELECT ref_date, dense_rank() OVER (ORDER BY ref_date) - 1 AS _idx
                    FROM (SELECT DISTINCT ref_date FROM payroll) d),
      cm AS (SELECT c.*, i._idx FROM (SELECT client_id{g}, ref_date, sum(qualified_employment) AS _e
                                      FROM payroll GROUP BY client_id{g}, ref_date) c JOIN idx i USING (ref_date)),
      w AS (SELECT *, lag(_idx) OVER (PARTITION BY client_id{g} ORDER BY _idx) AS _pi,
                   lag(_e) OVER (PARTITION BY client_id{g} ORDER BY _idx) AS _pe,
                   lead(_idx) OVER (PARTITION BY client_id{g} ORDER BY _idx) AS _ni FROM cm),
      u AS (SELECT _idx{g}, CASE WHEN _pi = _idx - 1 THEN _e - _pe ELSE 0 END AS wc,
                   CASE WHEN _pi = _idx - 1 THEN 0 ELSE _e END AS en, 0 AS ex FROM w
            UNION ALL
            SELECT _idx + 1{g}, 0, 0, _e FROM w WHERE _ni IS NULL OR _ni <> _idx + 1),
      s AS (SELECT _idx{g}, CAST(sum(wc) AS BIGINT) AS within_change, CAST(sum(en) AS BIGINT) AS entry_contribution,
                   CAST(sum(ex) AS BIGINT) AS exit_contribution FROM u WHERE _idx > 0 GROUP BY _idx{g})
    SELECT ref_date{g}, within_change + entry_contribution - exit_contribution AS total_change,
           within_change, entry_contribution, exit_contribution FROM s JOIN idx USING (_idx)"""


@register("employment_change", change_sql([]))
def q_employment_change(spark, d):
    return G.decompose_employment_change(payroll(spark, d))


@register("employment_change_state", change_sql(["state_fips"]))
def q_employment_change_state(spark, d):
    return G.decompose_employment_change(payroll(spark, d), ["state_fips"])


def turning_sql(p_growth: str, o_growth: str, groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)} " if groups else ""
    g = _g(groups)
    on = " AND ".join([f"p.{c} = o.{c}" for c in groups] or ["true"])
    pg = ", ".join([f"p.{c}" for c in groups]) + (", " if groups else "")
    return f"""WITH pt AS (SELECT ref_date{g} FROM (SELECT *, sign(yoy_growth) - lag(sign(yoy_growth))
                    OVER ({part}ORDER BY ref_date) AS t FROM ({p_growth}) a) b WHERE abs(t) = 2),
      ot AS (SELECT ref_date{g} FROM (SELECT *, sign(yoy_growth) - lag(sign(yoy_growth))
                    OVER ({part}ORDER BY ref_date) AS t FROM ({o_growth}) a) b WHERE abs(t) = 2),
      m AS (SELECT {pg}p.ref_date AS payroll_turn_date, o.ref_date AS official_turn_date,
                   row_number() OVER (PARTITION BY {pg}p.ref_date
                                      ORDER BY abs(date_diff('day', o.ref_date, p.ref_date)), o.ref_date) AS rn
            FROM pt p JOIN ot o ON {on})
    SELECT * EXCLUDE (rn), round(date_diff('day', official_turn_date, payroll_turn_date) / 30.0, 1) AS lead_lag_months,
           median(round(date_diff('day', official_turn_date, payroll_turn_date) / 30.0, 1)) OVER ({part}) AS median_lead_lag,
           avg(round(date_diff('day', official_turn_date, payroll_turn_date) / 30.0, 1)) OVER ({part}) AS mean_lead_lag
    FROM m WHERE rn = 1"""


@register("turning_points", turning_sql(growth_sql("payroll", "qualified_employment", []),
                                        growth_sql(CES_TOTAL, "employment", [], False), []))
def q_turning_points(spark, d):
    return G.analyze_turning_points(payroll_growth(spark, d), ces_growth(spark, d))


@register("turning_points_by_group", turning_sql(growth_sql("payroll", "qualified_employment", ["supersector"]),
                                                 growth_sql(CES_CELLS, "employment", ["supersector"], False),
                                                 ["supersector"]))
def q_turning_points_group(spark, d):
    return G.analyze_turning_points(payroll_growth(spark, d, ["supersector"]),
                                    ces_growth(spark, d, False, ["supersector"]), ["supersector"])


# ---------------------------------------------------------------- flows


def flow_rates_sql(inner: str, groups: list[str]) -> str:
    return f"""SELECT ref_date{_g(groups)}, hires, separations, employment, continuing_employment,
      CAST(hires AS DOUBLE) / NULLIF(employment, 0) AS hire_rate,
      CAST(separations AS DOUBLE) / NULLIF(employment, 0) AS separation_rate,
      CAST(hires + separations AS DOUBLE) / NULLIF(employment, 0) AS churn_rate,
      CAST(hires - separations AS DOUBLE) / NULLIF(employment, 0) AS net_growth_rate
    FROM ({inner}) f"""


def flows_entry_exit_sql(groups: list[str]) -> str:
    g = _g(groups)
    return flow_rates_sql(f"""SELECT *, employment - hires AS continuing_employment FROM (
        SELECT ref_date{g}, CAST(sum(qualified_employment) AS BIGINT) AS employment,
          CAST(sum(CASE WHEN entry_month = ref_date THEN qualified_employment ELSE 0 END) AS BIGINT) AS hires,
          CAST(sum(CASE WHEN exit_month = ref_date THEN qualified_employment ELSE 0 END) AS BIGINT) AS separations
        FROM payroll GROUP BY ref_date{g}) a""", groups)


@register("flows_columns", flow_rates_sql("""SELECT *, employment - hires AS continuing_employment FROM (
      SELECT ref_date, CAST(sum(hires) AS BIGINT) AS hires, CAST(sum(separations) AS BIGINT) AS separations,
             CAST(sum(qualified_employment) AS BIGINT) AS employment FROM payroll_flows GROUP BY ref_date) a""", []))
def q_flows_columns(spark, d):
    return FL.compute_job_flows(payroll(spark, d, with_flows=True), [])


@register("flows_entry_exit", flows_entry_exit_sql([]))
def q_flows_entry_exit(spark, d):
    return FL.compute_job_flows(payroll(spark, d), [])


for _name, _col in (("flows_state", "state_fips"), ("flows_industry", "supersector"), ("flows_size", "size_class")):
    register(_name, flows_entry_exit_sql([_col]))(
        lambda spark, d, _c=_col: FL.compute_job_flows(payroll(spark, d), [_c], "entry_exit"))


def flows_employee_sql(groups: list[str]) -> str:
    """Set differences of the employees of each group at consecutive observed dates."""
    g = _g(groups)
    return f"""WITH idx AS (SELECT ref_date, dense_rank() OVER (ORDER BY ref_date) - 1 AS _idx
                    FROM (SELECT DISTINCT ref_date FROM employees) d),
      pres AS (SELECT DISTINCT employee_id, _idx{g} FROM employees JOIN idx USING (ref_date)),
      was AS (SELECT employee_id, _idx + 1 AS _idx{g} FROM pres),
      arrived AS (SELECT * FROM pres EXCEPT SELECT * FROM was),
      departed AS (SELECT * FROM was EXCEPT SELECT * FROM pres),
      u AS (SELECT _idx{g}, 1 AS e, 0 AS h, 0 AS s FROM pres
            UNION ALL SELECT _idx{g}, 0, 1, 0 FROM arrived UNION ALL SELECT _idx{g}, 0, 0, 1 FROM departed)
    {flow_rates_sql(f'''SELECT ref_date{g}, CAST(sum(h) AS BIGINT) AS hires, CAST(sum(s) AS BIGINT) AS separations,
          CAST(sum(e) AS BIGINT) AS employment, CAST(sum(e) - sum(h) AS BIGINT) AS continuing_employment
          FROM u JOIN idx USING (_idx) GROUP BY ref_date{g}''', groups)}"""


@register("flows_employee", flows_employee_sql([]))
def q_flows_employee(spark, d):
    return FL.compute_job_flows(synth.employees(spark, d), [])


@register("flows_employee_client", flows_employee_sql(["client_id"]))
def q_flows_employee_client(spark, d):
    return FL.compute_job_flows(synth.employees(spark, d), ["client_id"])


@register("flows_employee_state", flows_employee_sql(["state_fips"]))
def q_flows_employee_state(spark, d):
    return FL.compute_job_flows(synth.employees(spark, d), ["state_fips"])


# ---------------------------------------------------------------- earnings

def earnings_sql(groups: list[str]) -> str:
    g = _g(groups)
    return f"""SELECT ref_date{g}, avg(gross_pay) AS mean_earnings, {median_sql('gross_pay')} AS median_earnings,
      {nearest_sql('gross_pay', 0.1)} AS p10_earnings, {nearest_sql('gross_pay', 0.25)} AS p25_earnings,
      {nearest_sql('gross_pay', 0.75)} AS p75_earnings, {nearest_sql('gross_pay', 0.9)} AS p90_earnings,
      stddev_samp(gross_pay) AS std_earnings, stddev_samp(gross_pay) / NULLIF(avg(gross_pay), 0) AS cv_earnings
    FROM (SELECT ref_date{g}, gross_pay,
                 row_number() OVER (PARTITION BY ref_date{g} ORDER BY gross_pay) AS _rank,
                 count(*) OVER (PARTITION BY ref_date{g}) AS _n
          FROM payroll WHERE gross_pay IS NOT NULL AND gross_pay > 0) r
    GROUP BY ref_date{g}"""


def earnings_growth_sql(groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)} " if groups else ""
    return f"""SELECT *,
      mean_earnings / NULLIF(lag(mean_earnings, 12) OVER ({part}ORDER BY ref_date), 0) - 1 AS mean_earnings_yoy,
      median_earnings / NULLIF(lag(median_earnings, 12) OVER ({part}ORDER BY ref_date), 0) - 1 AS median_earnings_yoy
    FROM ({earnings_sql(groups)}) e"""


@register("earnings_dist", earnings_sql([]))
def q_earnings(spark, d):
    return E.compute_earnings_distribution(payroll(spark, d), [])


@register("earnings_dist_supersector", earnings_sql(["supersector"]))
def q_earnings_ss(spark, d):
    return E.compute_earnings_distribution(payroll(spark, d), ["supersector"])


@register("earnings_growth", earnings_growth_sql([]))
def q_earnings_growth(spark, d):
    return E.compute_earnings_growth(payroll(spark, d), [])


@register("earnings_growth_supersector", earnings_growth_sql(["supersector"]))
def q_earnings_growth_ss(spark, d):
    return E.compute_earnings_growth(payroll(spark, d), ["supersector"])


def calendar_growth_sql(groups: list[str]) -> str:
    g = _g(groups)
    on = "".join(f" AND p.{c} = q.{c}" for c in groups)
    base = f"""SELECT ref_date{g}, CAST(sum(qualified_employment) AS BIGINT) AS employment
               FROM payroll GROUP BY ref_date{g}"""
    return f"""WITH a AS ({base})
    SELECT p.*, CAST(p.employment AS DOUBLE) / NULLIF(CAST(m.employment AS DOUBLE), 0) - 1 AS mom_growth,
           CAST(p.employment AS DOUBLE) / NULLIF(CAST(y.employment AS DOUBLE), 0) - 1 AS yoy_growth
    FROM a p
    LEFT JOIN a m ON m.ref_date = CAST(p.ref_date - INTERVAL 1 MONTH AS DATE){on.replace('q.', 'm.')}
    LEFT JOIN a y ON y.ref_date = CAST(p.ref_date - INTERVAL 12 MONTH AS DATE){on.replace('q.', 'y.')}"""


@register("growth_calendar_supersector", calendar_growth_sql(["supersector"]))
def q_growth_calendar_ss(spark, d):
    return G.compute_growth_rates(payroll(spark, d), "qualified_employment", ["supersector"], calendar=True)
