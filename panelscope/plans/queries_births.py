"""Queries for births, lead tests, survival and raking."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscope.functions.stats import t_pvalue_sql
from panelscope.operators import births as B
from panelscope.operators import growth as G
from panelscope.operators import reweight as R
from panelscope.plans.catalog import register
from panelscope.plans.inputs import bed, official, panel_at, payroll
from panelscope.plans.queries_core import panel_level_sql
from panelscope.plans.queries_dynamics import growth_sql

BIRTH_SQL = f"""SELECT ref_date, quarter, births, determinable,
      CAST(births AS DOUBLE) / NULLIF(CAST(determinable AS DOUBLE), 0) AS birth_rate
    FROM (SELECT ref_date, quarter, CAST(sum(birth_count) AS BIGINT) AS births,
                 CAST(sum(birth_determinable_count) AS BIGINT) AS determinable
          FROM ({panel_level_sql('national')}) x GROUP BY ref_date, quarter) a"""


def payroll_births(spark, d, level="national", groups=()):
    return B.compute_payroll_birth_rates(panel_at(spark, d, level), list(groups))


def official_births(spark, d):
    return B.official_birth_rates(bed(spark, d))


@register("bed_normalise", "SELECT * FROM bed")
def q_bed(spark, d):
    return bed(spark, d)


@register("birth_rates", BIRTH_SQL)
def q_birth_rates(spark, d):
    return payroll_births(spark, d)


@register("birth_rates_supersector", f"""SELECT ref_date, quarter, supersector, births, determinable,
      CAST(births AS DOUBLE) / NULLIF(CAST(determinable AS DOUBLE), 0) AS birth_rate
    FROM (SELECT ref_date, quarter, supersector, CAST(sum(birth_count) AS BIGINT) AS births,
                 CAST(sum(birth_determinable_count) AS BIGINT) AS determinable
          FROM ({panel_level_sql('supersector')}) x GROUP BY ref_date, quarter, supersector) a""")
def q_birth_rates_ss(spark, d):
    return payroll_births(spark, d, "supersector", ["supersector"])


@register("compare_birth_rates", f"""SELECT p.*, o.bed_births, o.bed_deaths, o.bed_establishments, o.bed_birth_rate,
      p.birth_rate - coalesce(o.bed_birth_rate, 0.0) AS birth_rate_diff,
      p.birth_rate / NULLIF(coalesce(o.bed_birth_rate, 1.0), 0) AS birth_rate_ratio
    FROM ({BIRTH_SQL}) p LEFT JOIN bed_national o USING (quarter)""")
def q_compare_birth_rates(spark, d):
    return B.compare_birth_rates(payroll_births(spark, d), official_births(spark, d), [])


def _shares(src: str, name: str) -> str:
    return f"""SELECT dimension, value, CAST(_n AS DOUBLE) / NULLIF(sum(_n) OVER (PARTITION BY dimension), 0) AS {name}
      FROM (SELECT dimension, value, count(*) AS _n FROM (
              SELECT 'supersector' AS dimension, supersector AS value FROM {src}
              UNION ALL SELECT 'state_fips', state_fips FROM {src}
              UNION ALL SELECT 'size_class', size_class FROM {src}) u GROUP BY dimension, value) c"""


@register("birth_composition", f"""SELECT dimension, sum(abs(coalesce(share_det, 0.0) - coalesce(share_full, 0.0))) / 2
      AS misallocation_index
    FROM ({_shares('(SELECT * FROM payroll WHERE is_birth IS NOT NULL)', 'share_det')}) a
    FULL OUTER JOIN ({_shares('payroll', 'share_full')}) b USING (dimension, value)
    GROUP BY dimension""")
def q_birth_composition(spark, d):
    p = payroll(spark, d)
    return B.compare_birth_determinable_composition(p.filter(F.col("is_birth").isNotNull()), p)


MERGED_SQL = f"""m AS (SELECT quarter, x, bed_birth_rate AS y
            FROM (SELECT quarter, avg(birth_rate) AS x FROM ({BIRTH_SQL}) b GROUP BY quarter) p
            JOIN bed_national USING (quarter)),
      mi AS (SELECT *, row_number() OVER (ORDER BY quarter) - 1 AS _i, count(*) OVER () AS _n,
                    lag(x) OVER (ORDER BY quarter) AS x_lag, lag(y) OVER (ORDER BY quarter) AS y_lag FROM m)"""

LEAD_SQL = f"""WITH {MERGED_SQL},
      l AS (SELECT 'concurrent' AS model, 1 AS _o, y, x AS x1, CAST(NULL AS DOUBLE) AS x2 FROM mi WHERE _n >= 10
            UNION ALL SELECT 'leading', 2, y, x, x_lag FROM mi WHERE _n >= 10 AND _i >= 1
            UNION ALL SELECT 'incremental', 3, y, y_lag, x_lag FROM mi WHERE _n >= 10 AND _i >= 1),
      s AS (SELECT model, _o, count(*) AS n, CAST(count(*) AS DOUBLE) AS nd, var_samp(x1) AS s11, var_samp(x2) AS s22,
                   covar_samp(x1, x2) AS s12, covar_samp(x1, y) AS s1y, covar_samp(x2, y) AS s2y,
                   var_samp(y) AS syy, corr(x1, x2) AS r12 FROM l GROUP BY model, _o),
      f AS (SELECT *, s1y / s11 AS b_1, s1y * s1y / (s11 * syy) AS r2_1,
                   s11 * s22 - s12 * s12 AS dd, coalesce(r12 * r12 > 1 - 1e-9, false) AS col FROM s),
      g AS (SELECT *, (s22 * s1y - s12 * s2y) / dd AS b1, (s11 * s2y - s12 * s1y) / dd AS b2 FROM f),
      h AS (SELECT *, (b1 * s1y + b2 * s2y) / syy AS r2_2 FROM g)
    SELECT model, n,
      CASE WHEN _o = 1 OR col THEN r2_1 ELSE r2_2 END AS r2,
      CASE WHEN _o = 1 THEN b_1 WHEN col THEN NULL ELSE b2 END AS coef,
      CASE WHEN _o = 1 THEN b_1 / sqrt((1 - r2_1) * syy / ((nd - 2) * s11))
           WHEN col THEN NULL ELSE b2 / sqrt((1 - r2_2) * syy * s11 / ((nd - 3) * dd)) END AS t,
      CASE WHEN _o = 1 THEN nd - 2 ELSE nd - 3 END AS dof
    FROM h"""


@register("birth_lead", LEAD_SQL)
def q_birth_lead(spark, d):
    m = B.birth_lead_models(payroll_births(spark, d), official_births(spark, d))
    return m.select("model", "n", "r2", "coef", "t", "dof")


@register("birth_lead_pvalues", f"SELECT model, r2, coef, {t_pvalue_sql('t', 'dof')} AS pvalue FROM ({LEAD_SQL}) l")
def q_birth_lead_p(spark, d):
    return B.test_birth_lead(payroll_births(spark, d), official_births(spark, d))


def lag_regression_sql(merged: str, groups: list[str], max_order: int = 4) -> str:
    """``birth_lead_lags`` by Gram-Schmidt: a copy of the rows for each term, with that term the last to be made orthogonal.

    Columns are padded with zeros in front, up to two lists of lags; the copies with the term '' are the restricted models. Terms that are
    zero in all quarters have the coefficient 0; other collinear terms are not handled here.
    """
    width = 2 * max_order
    by = "".join(f"{g}, " for g in groups)
    part = ("PARTITION BY " + ", ".join(groups)) if groups else ""
    lags = ", ".join(f"lag({c}, {k}) OVER ({part} ORDER BY _i) AS {c}{k}" for c in "xy" for k in range(1, max_order + 1))
    copies = []
    for order in range(1, max_order + 1):
        payroll = {f"payroll_lag{k}": f"x{k}" for k in range(1, order + 1)}
        own = {f"official_lag{k}": f"y{k}" for k in range(1, order + 1)}
        for model, before in (("leading", {"payroll": "x"}), ("incremental", own)):
            terms = {**before, **payroll}
            for term in ["", *terms]:
                cols = list(before.values()) if not term else [c for t, c in terms.items() if t != term] + [terms[term]]
                zs = ["0.0"] * (width - len(cols)) + cols
                copies.append(f"SELECT {by}CAST({order} AS INTEGER) AS lag_order, '{model}' AS model, '{term}' AS term, "
                              f"y AS z{width}, "
                              + ", ".join(f"{c} AS z{i}" for i, c in enumerate(zs)) + f" FROM q WHERE _i >= {order}")
    keys = f"{by}lag_order, model, term"
    every = range(width + 1)
    steps = [f"o0 AS (SELECT {keys}, " + ", ".join(f"z{i} - avg(z{i}) OVER w AS z{i}" for i in every) + f" FROM u WINDOW w AS (PARTITION BY {keys}))"]
    for k in range(width):
        less = lambda i: f"z{i} - z{k} * coalesce(sum(z{i} * z{k}) OVER w / NULLIF(sum(z{k} * z{k}) OVER w, 0), 0.0)"
        kept = ", ".join(f"z{i}" if i <= k else f"{less(i)} AS z{i}" for i in every)
        total = f", z{width} AS z" if k == 0 else ", z"
        steps.append(f"o{k + 1} AS (SELECT {keys}{total}, {kept} FROM o{k} WINDOW w AS (PARTITION BY {keys}))")
    q, e = f"z{width - 1}", f"z{width}"
    rank = " + ".join(f"(sum(z{i} * z{i}) > 1e-20)::INTEGER" for i in range(width))  # constant lags have nothing left
    return f"""{merged},
      q AS (SELECT *, {lags} FROM mi WHERE _n >= 10),
      u AS ({" UNION ALL ".join(copies)}),
      {", ".join(steps)},
      s AS (SELECT {keys}, count(*) AS n, {rank} AS rank, coalesce(sum(z * {q}) / NULLIF(sum({q} * {q}), 0), 0.0) AS coef, sum({q} * {q}) AS qq, sum({e} * {e}) AS rss, sum(z * z) AS tss
            FROM o{width} GROUP BY {keys})
    SELECT {"".join(f"a.{g}, " for g in groups)}a.lag_order, a.model, a.term, a.n, a.rank, 1 - a.rss / NULLIF(a.tss, 0) AS r2,
      (b.rss - a.rss) * (a.n - 1 - a.rank) / NULLIF(a.rss * (a.rank - b.rank), 0) AS f, a.rank - b.rank AS f_dof, a.n - 1 - a.rank AS dof, a.coef,
      a.coef / NULLIF(sqrt(a.rss / (a.n - 1 - a.rank) / NULLIF(a.qq, 0)), 0) AS t
    FROM s a JOIN s b ON {"".join(f"a.{g} = b.{g} AND " for g in groups)}a.lag_order = b.lag_order AND a.model = b.model AND b.term = ''
    WHERE a.term <> '' AND a.n - 1 - a.rank > 0"""


@register("birth_lead_lags", lag_regression_sql(f"WITH {MERGED_SQL}", []))
def q_birth_lead_lags(spark, d):
    return B.birth_lead_lags(payroll_births(spark, d), official_births(spark, d))


@register("cross_correlation", f"""WITH {MERGED_SQL},
      pairs AS (SELECT CAST(l.lag AS INTEGER) AS lag, a.x, b.y
                FROM mi a JOIN (SELECT unnest(range(0, 5)) AS lag) l ON true
                JOIN mi b ON b._i = a._i + l.lag WHERE a._n >= 4)
    SELECT lag, coalesce(CASE WHEN isnan(corr(x, y)) THEN 0.0 ELSE corr(x, y) END, 0.0) AS correlation
    FROM pairs GROUP BY lag""")
def q_cross_correlation(spark, d):
    return B.compute_cross_correlation(payroll_births(spark, d), official_births(spark, d), 4)


def survival_sql(censored: bool) -> str:
    horizons = B.SURVIVAL_HORIZONS
    if censored:
        cols = ", ".join(
            f"CAST(count(*) FILTER (WHERE date_diff('day', entry_month, _end) / 30.0 >= {m} AND tenure >= {m}) AS DOUBLE)"
            f" / NULLIF(count(*) FILTER (WHERE date_diff('day', entry_month, _end) / 30.0 >= {m}), 0) AS {n}"
            for n, m in horizons.items())
    else:
        cols = ", ".join(f"avg(CASE WHEN tenure >= {m} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS {n}"
                         for n, m in horizons.items())
    return f"""WITH b AS (SELECT DISTINCT client_id, entry_month FROM payroll WHERE is_birth),
      l AS (SELECT client_id, max(ref_date) AS last_seen FROM payroll GROUP BY client_id),
      t AS (SELECT b.client_id, b.entry_month, CAST(year(entry_month) AS VARCHAR) || 'Q' || CAST(quarter(entry_month) AS VARCHAR)
                     AS entry_quarter, date_diff('day', entry_month, last_seen) / 30.0 AS tenure,
                   max(last_seen) OVER () AS _end
            FROM b LEFT JOIN l USING (client_id))
    SELECT entry_quarter, count(DISTINCT client_id) AS birth_cohort_n, {cols} FROM t GROUP BY entry_quarter"""


@register("survival", survival_sql(False))
def q_survival(spark, d):
    return B.compute_survival_curves(payroll(spark, d))


@register("survival_censored", survival_sql(True))
def q_survival_censored(spark, d):
    return B.compute_survival_curves(payroll(spark, d), censored=True)


# ---------------------------------------------------------------- raking

RAKE_ONE_SQL = """SELECT p.*, coalesce(m._q / NULLIF(t._p, 0), 1.0) AS rake_weight
    FROM payroll p
    LEFT JOIN (SELECT ref_date, quarter, supersector, CAST(sum(qualified_employment) AS DOUBLE) AS _p
               FROM payroll GROUP BY 1, 2, 3) t USING (ref_date, quarter, supersector)
    LEFT JOIN (SELECT ref_date, quarter, supersector, CAST(sum(qcew_employment) AS DOUBLE) AS _q
               FROM off_supersector GROUP BY 1, 2, 3) m USING (ref_date, quarter, supersector)"""


def raked_one(spark, d):
    return R.rake_to_qcew(payroll(spark, d), official(spark, d, ["supersector"], "national"), ["supersector"])


@register("rake_one_dim", RAKE_ONE_SQL)
def q_rake_one(spark, d):
    return raked_one(spark, d)


def rake_sql(dims: list[str], official_cte: str | dict[str, str], max_iter: int = 100, tolerance: float = 1e-6) -> str:
    """CTEs up to ``fitted``: cells with their weight, rounds and last change, by a recursive query with the same stop rule."""
    table = official_cte if isinstance(official_cte, dict) else {d: official_cte for d in dims}
    keys = ["ref_date", "quarter"] + dims
    kl = ", ".join(keys)
    margins = [f"""m_{d} AS (SELECT ref_date, quarter, {d}, CAST(sum(qcew_employment) AS DOUBLE) AS q_{d}
                    FROM {table[d]} GROUP BY ref_date, quarter, {d})""" for d in dims]
    joins = " ".join(f"LEFT JOIN m_{d} USING (ref_date, quarter, {d})" for d in dims)
    qs = ", ".join(f"q_{d}" for d in dims)
    change = []
    inner = f"(SELECT {kl}, _e, {qs}, it, chg, w AS w0 FROM rounds WHERE it < {max_iter} AND (it = 0 OR chg >= {tolerance}))"
    for k, d in enumerate(dims):
        ratio = f"coalesce(q_{d} / NULLIF(sum(_e * w{k}) OVER (PARTITION BY ref_date, quarter, {d}), 0), 1.0)"
        inner = f"(SELECT *, w{k} * {ratio} AS w{k + 1} FROM {inner} r{k})"
        change.append(f"abs(w{k + 1} - w{k})")
    top = f"greatest({', '.join(change)})"
    return f"""c AS (SELECT {kl}, CAST(sum(qualified_employment) AS DOUBLE) AS _e FROM payroll GROUP BY {kl}),
      {', '.join(margins)},
      rounds AS (SELECT {kl}, _e, {qs}, 0 AS it, CAST(0.0 AS DOUBLE) AS chg, CAST(1.0 AS DOUBLE) AS w FROM c {joins}
        UNION ALL
        SELECT {kl}, _e, {qs}, it + 1, max({top}) OVER (PARTITION BY ref_date, quarter), w{len(dims)} FROM {inner} s),
      fitted AS (SELECT {kl}, w, it AS rounds, chg AS last_change, chg < {tolerance} AS converged FROM rounds
        QUALIFY it = max(it) OVER (PARTITION BY ref_date, quarter))"""


def raked_sql(dims: list[str], official_cte: str | dict[str, str], weight: str = "coalesce(f.w, 1.0)") -> str:
    on = " AND ".join(f"p.{x} IS NOT DISTINCT FROM f.{x}" for x in ["ref_date", "quarter"] + dims)
    return (f"WITH RECURSIVE {rake_sql(dims, official_cte)}\n    SELECT p.*, {weight} AS rake_weight, f.rounds, f.converged "
            f"FROM payroll p LEFT JOIN fitted f ON {on}")


def convergence_sql(dims: list[str], official_cte: str) -> str:
    return f"WITH RECURSIVE {rake_sql(dims, official_cte)}\n    SELECT DISTINCT ref_date, quarter, rounds, last_change, converged FROM fitted"


TWO_DIMS = ["supersector", "state_fips"]
THREE_DIMS = ["supersector", "state_fips", "size_class"]
THREE_TABLES = {"supersector": "off_supersector_state", "state_fips": "off_supersector_state", "size_class": "off_size_class"}


@register("rake_two_dims", raked_sql(TWO_DIMS, "off_supersector_state"))
def q_rake_two(spark, d):
    """Without the last change: below the tolerance it is rounding noise, which no two engines share; tests compare it with an absolute tolerance."""
    return R.rake_to_qcew(payroll(spark, d), official(spark, d, TWO_DIMS, "state"), TWO_DIMS, report=True).drop("last_change")


@register("rake_three_dims", raked_sql(THREE_DIMS, THREE_TABLES, "CASE WHEN f.converged THEN coalesce(f.w, 1.0) END"))
def q_rake_three(spark, d):
    """Industry and state margins of the state slice, size margins of the size slice (first quarters only); weights of converged months."""
    by_state = official(spark, d, TWO_DIMS, "state")
    tables = {"supersector": by_state, "state_fips": by_state, "size_class": official(spark, d, ["size_class"], "size")}
    return R.rake_to_qcew(payroll(spark, d), tables, THREE_DIMS, report=True, keep_unconverged=False).drop("last_change")


@register("rake_convergence", convergence_sql(TWO_DIMS, "off_supersector_state"))
def q_rake_convergence(spark, d):
    """The whole report of each month: rounds, last change and convergence."""
    return R.rake_convergence(payroll(spark, d), official(spark, d, TWO_DIMS, "state"), TWO_DIMS)


REWEIGHTED_SQL = growth_sql(f"(SELECT *, qualified_employment * rake_weight AS _we FROM ({RAKE_ONE_SQL}) r)",
                            "_we", [], False)


@register("reweighted_growth", REWEIGHTED_SQL)
def q_reweighted_growth(spark, d):
    return G.compute_growth_rates(raked_one(spark, d), "qualified_employment", [], weight_col="rake_weight")


@register("reweighting_impact", f"""SELECT g.*, r.yoy_growth AS reweighted_yoy
    FROM ({growth_sql('payroll', 'qualified_employment', [])}) g LEFT JOIN ({REWEIGHTED_SQL}) r USING (ref_date)""")
def q_reweighting_impact(spark, d):
    rg = G.compute_growth_rates(raked_one(spark, d), "qualified_employment", [], weight_col="rake_weight")
    return R.reweighting_impact(G.compute_growth_rates(payroll(spark, d), "qualified_employment", []), rg)
