"""Birth rates, comparison with official births, lead tests and survival."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import days_over_30, quarter_label, td
from panelscope.functions.regress import least_squares
from panelscope.functions.stats import safe_corr, t_pvalue

SURVIVAL_HORIZONS = {"survival_4q": 12, "survival_8q": 24, "survival_12q": 36, "survival_16q": 48,
                     "survival_20q": 60}


def compute_payroll_birth_rates(panel: DataFrame, grouping_cols: list[str]) -> DataFrame:
    by = ["ref_date", "quarter"] + list(grouping_cols)
    return panel.groupBy(*by).agg(
        F.sum("birth_count").alias("births"), F.sum("birth_determinable_count").alias("determinable"),
    ).withColumn("birth_rate", td("births", "determinable"))


def quarterly_birth_rates(panel: DataFrame, grouping_cols: list[str]) -> DataFrame:
    """Quarterly variant: births / determinable summed over the quarter's months."""
    by = ["quarter"] + list(grouping_cols)
    return panel.groupBy(*by).agg(
        F.sum("birth_count").alias("births"), F.sum("birth_determinable_count").alias("determinable"),
    ).withColumn("birth_rate", td("births", "determinable"))


def official_birth_rates(bed: DataFrame, state: str = "00", naics: str = "000000") -> DataFrame:
    """One level of a normalised BED table with the 'YYYYQn' quarter label."""
    lvl = bed.filter((F.col("state_fips") == state) & (F.col("naics_code") == naics))
    return lvl.select(
        F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string")).alias("quarter"),
        F.col("births").alias("bed_births"), F.col("deaths").alias("bed_deaths"),
        F.col("total_establishments").alias("bed_establishments"),
        F.col("birth_rate").alias("bed_birth_rate"),
    )


def compare_birth_rates(payroll_births: DataFrame, official: DataFrame, grouping_cols: list[str]) -> DataFrame:
    """Left join on quarter (+ shared groups); diff (missing official -> 0) and ratio (-> 1)."""
    keys = ["quarter"] + [c for c in grouping_cols if c in payroll_births.columns and c in official.columns]
    m = payroll_births.join(official, keys, "left")
    b = F.col("bed_birth_rate")
    return m.withColumns({
        "birth_rate_diff": F.col("birth_rate") - F.coalesce(b, F.lit(0.0)),
        "birth_rate_ratio": td("birth_rate", F.coalesce(b, F.lit(1.0))),
    })


def compare_birth_determinable_composition(subset: DataFrame, full: DataFrame,
                                           dims: list[str] | None = None) -> DataFrame:
    """Misallocation index of row shares (subset vs full) for each dimension, in one job."""
    dims = dims or ["supersector", "state_fips", "size_class"]

    def shares(df, name):
        long = df.select(*[F.col(d).cast("string").alias(d) for d in dims]).unpivot(
            [], dims, "dimension", "value")
        c = long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("_n"))
        return c.select("dimension", "value",
                        td("_n", F.sum("_n").over(Window.partitionBy("dimension"))).alias(name))

    m = shares(subset, "share_det").join(shares(full, "share_full"), ["dimension", "value"], "full_outer")
    dev = F.abs(F.coalesce("share_det", F.lit(0.0)) - F.coalesce("share_full", F.lit(0.0)))
    return m.groupBy("dimension").agg((F.sum(dev) / 2).alias("misallocation_index"))


def _merged_quarterly(payroll_births: DataFrame, official: DataFrame, groups: list[str]) -> DataFrame:
    """Quarterly mean payroll rate joined to the official rate, with a 0-based position per group."""
    p = payroll_births.groupBy("quarter", *groups).agg(F.avg("birth_rate").alias("x"))
    keys = ["quarter"] + [g for g in groups if g in official.columns]
    o = official.select(*keys, F.col("bed_birth_rate").alias("y"))
    m = p.join(o, keys, "inner")
    w = Window.partitionBy(*groups)
    return m.withColumns({"_i": F.row_number().over(w.orderBy("quarter")) - 1, "_n": F.count(F.lit(1)).over(w)})


def _ols_two(n, s11, s22, s12, s1y, s2y, syy):
    """Closed-form OLS with intercept on two regressors from sample covariances."""
    d = s11 * s22 - s12 * s12
    b1 = td(s22 * s1y - s12 * s2y, d)
    b2 = td(s11 * s2y - s12 * s1y, d)
    r2 = td(b1 * s1y + b2 * s2y, syy)
    se2 = td((F.lit(1.0) - r2) * syy * s11, (n - 3) * d)
    return b2, r2, td(b2, F.sqrt(se2))


def birth_lead_models(payroll_births: DataFrame, official: DataFrame, grouping_cols: list[str] | None = None,
                      min_quarters: int = 10) -> DataFrame:
    """Concurrent, leading and incremental OLS of the official rate on payroll rates.

    Returns (groups, model, n, r2, coef, t, dof); the series are ordered by
    quarter within each group and lags are positional. Needs ``min_quarters``.
    """
    g = list(grouping_cols or [])
    m = _merged_quarterly(payroll_births, official, g).filter(F.col("_n") >= min_quarters)
    w = Window.partitionBy(*g).orderBy("_i")
    m = m.withColumns({"x_lag": F.lag("x").over(w), "y_lag": F.lag("y").over(w)})
    # All moments of the three models in one aggregate; the lagged ones leave out each group's first quarter.
    later = lambda c: F.when(F.col("_i") >= 1, F.col(c))
    x, y, xl, yl = later("x"), later("y"), F.col("x_lag"), F.col("y_lag")
    null = F.lit(None).cast("double")
    moments = {
        "concurrent": (1, F.count(F.lit(1)), F.var_samp("x"), null, null, F.covar_samp("x", "y"), null, F.var_samp("y")),
        "leading": (2, F.count_if(F.col("_i") >= 1), F.var_samp(x), F.var_samp(xl), F.covar_samp(x, xl), F.covar_samp(x, y), F.covar_samp(xl, y), F.var_samp(y)),
        "incremental": (3, F.count_if(F.col("_i") >= 1), F.var_samp(yl), F.var_samp(xl), F.covar_samp(yl, xl), F.covar_samp(yl, y), F.covar_samp(xl, y), F.var_samp(y)),
    }
    names = ["_o", "n", "s11", "s22", "s12", "s1y", "s2y", "syy"]
    structs = [F.struct(F.lit(model).alias("model"), F.lit(cols[0]).alias("_o"), *[c.alias(name) for c, name in zip(cols[1:], names[1:])])
               for model, cols in moments.items()]
    s = m.groupBy(*g).agg(F.array(*structs).alias("_models")).select(*g, F.explode("_models").alias("_m")).select(*g, "_m.*")
    s = s.filter("n > 0").withColumn("r12", td("s12", F.sqrt(F.col("s11") * F.col("s22"))))
    n = F.col("n").cast("double")
    s11, s22, s12, s1y, s2y, syy = (F.col(c) for c in ("s11", "s22", "s12", "s1y", "s2y", "syy"))
    # one regressor: slope, r2, t with n-2 degrees of freedom
    b_1 = td(s1y, s11)
    r2_1 = td(s1y * s1y, s11 * syy)
    t_1 = td(b_1, F.sqrt(td((F.lit(1.0) - r2_1) * syy, (n - 2) * s11)))
    b2, r2_2, t_2 = _ols_two(n, s11, s22, s12, s1y, s2y, syy)
    collinear = F.col("r12") * F.col("r12") > F.lit(1 - 1e-9)
    single = F.col("_o") == 1
    out = s.select(
        *g, "model", "_o", "n",
        F.when(single | collinear, r2_1).otherwise(r2_2).alias("r2"),
        F.when(single, b_1).when(collinear, F.lit(None)).otherwise(b2).alias("coef"),
        F.when(single, t_1).when(collinear, F.lit(None)).otherwise(t_2).alias("t"),
        F.when(single, n - 2).otherwise(n - 3).alias("dof"),
    )
    return out


def test_birth_lead(payroll_births: DataFrame, official: DataFrame, grouping_cols: list[str] | None = None,
                    min_quarters: int = 10) -> DataFrame:
    """model, r2, coef, pvalue (p-values through a vectorised Student-t helper)."""
    g = list(grouping_cols or [])
    m = birth_lead_models(payroll_births, official, g, min_quarters)
    return m.select(*g, "model", "r2", "coef", t_pvalue(F.col("t"), F.col("dof")).alias("pvalue"))


test_birth_lead.__test__ = False  # not a pytest test


def birth_lead_lags(payroll_births: DataFrame, official: DataFrame, max_order: int = 4, grouping_cols: list[str] | None = None,
                    min_quarters: int = 10) -> DataFrame:
    """Leading and incremental regressions with 1 to ``max_order`` lags of the payroll rate; one row per order, model and term.

    leading: the official rate on the payroll rate and its lags, against the payroll rate alone. incremental: on its own lags and the
    payroll lags, against its own lags alone. ``f`` tests the payroll lags together (``f_dof``, ``dof``), ``t`` a single term. Lags are
    positional, each order uses the quarters that have all its lags, and orders without a degree of freedom have no rows. Collinear
    terms share the solution of least norm and have no ``t``.
    """
    g = list(grouping_cols or [])
    m = _merged_quarterly(payroll_births, official, g).filter(F.col("_n") >= min_quarters)
    w = Window.partitionBy(*g).orderBy("_i")
    lags = range(1, max_order + 1)
    m = m.withColumns({f"{c}{k}": F.lag(c, k).over(w) for c in ("x", "y") for k in lags})
    term = lambda name, c: F.struct(F.lit(name).alias("term"), F.col(c).alias("value"))
    models = []
    for order in lags:
        payroll = [term(f"payroll_lag{k}", f"x{k}") for k in range(1, order + 1)]
        own = [term(f"official_lag{k}", f"y{k}") for k in range(1, order + 1)]
        for name, before in (("leading", [term("payroll", "x")]), ("incremental", own)):
            models.append(F.struct(F.lit(order).alias("lag_order"), F.lit(name).alias("model"), F.lit(len(before)).alias("base"),
                                   F.array(*before, *payroll).alias("terms")))
    rows = m.select(*g, "y", F.explode(F.array(*models)).alias("_m")).select(*g, "y", "_m.*")
    by = g + ["lag_order", "model"]
    fits = least_squares(rows, by, "y", "terms", "base").filter("dof > 0")
    return fits.select(*by, "n", "rank", "r2", "f", "f_dof", "dof", F.explode("fit").alias("_t")).select(
        *by, "_t.term", "n", "rank", "r2", "f", "f_dof", "dof", "_t.coef", td("_t.coef", "_t.se").alias("t"))


def compute_cross_correlation(payroll_births: DataFrame, official: DataFrame, max_lag: int = 4,
                              grouping_cols: list[str] | None = None, min_quarters: int = 4) -> DataFrame:
    """corr(payroll_q, official_(q+lag)) for lag 0..max_lag (lag < n); NaN -> 0."""
    g = list(grouping_cols or [])
    m = _merged_quarterly(payroll_births, official, g).filter(F.col("_n") >= min_quarters)
    xs = m.select(*g, "x", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"),
                  F.col("_i").alias("_xi"))
    xs = xs.withColumn("_j", F.col("_xi") + F.col("lag"))
    ys = m.select(*g, F.col("_i").alias("_j"), "y")
    pairs = xs.join(ys, g + ["_j"], "inner")
    c = safe_corr("x", "y")
    return pairs.groupBy(*g, "lag").agg(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)).alias("correlation"))


def compute_survival_curves(payroll: DataFrame, grouping_cols: list[str] | None = None,
                            censored: bool = False) -> DataFrame:
    """Share of birth clients of each entry quarter still observed 4..20 quarters later.

    Default (parity): still-active clients near the data end count as failures.
    ``censored=True`` divides by the clients whose horizon falls inside the data.
    """
    g = list(grouping_cols or [])
    births = (payroll.filter(F.col("is_birth") == F.lit(True))
              .select("client_id", "entry_month", *g).distinct())
    last = payroll.groupBy("client_id").agg(F.max("ref_date").alias("last_seen"))
    b = births.join(last, "client_id", "left").withColumns({
        "entry_quarter": quarter_label("entry_month"),
        "tenure_months": days_over_30("last_seen", "entry_month"),
    })
    aggs = [F.count_distinct("client_id").alias("birth_cohort_n")]
    if censored:
        end = b.agg(F.max("last_seen")).scalar()
        for name, months in SURVIVAL_HORIZONS.items():
            at_risk = days_over_30(end, F.col("entry_month")) >= months
            aggs.append(td(F.count_if(at_risk & (F.col("tenure_months") >= months)), F.count_if(at_risk)).alias(name))
    else:
        for name, months in SURVIVAL_HORIZONS.items():
            aggs.append(F.avg(F.when(F.col("tenure_months") >= months, 1.0).otherwise(0.0)).alias(name))
    return b.groupBy("entry_quarter", *g).agg(*aggs)


def compute_kaplan_meier(payroll: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Kaplan-Meier survival of the birth clients of each entry quarter, at the horizons of :func:`compute_survival_curves`.

    A client last seen at the end of the data is censored there, any other is a failure. S(h) is the product over the
    failure times t < h of 1 - d(t) / n(t), n(t) being the clients seen for t months or more. Without censoring it equals the share
    still there. Once a cohort has nobody seen for h months and was not all failures, S(h) is NULL.
    """
    g = list(grouping_cols or [])
    births = payroll.filter(F.col("is_birth") == F.lit(True)).select("client_id", "entry_month", *g).distinct()
    last = payroll.groupBy("client_id").agg(F.max("ref_date").alias("last_seen"))
    end = payroll.agg(F.max("ref_date")).scalar()
    b = births.join(last, "client_id").select(*g, quarter_label("entry_month").alias("entry_quarter"),
                                              days_over_30("last_seen", "entry_month").alias("t"), (F.col("last_seen") < end).cast("int").alias("failed"))
    by = ["entry_quarter", *g]
    times = b.groupBy(*by, "t").agg(F.sum("failed").alias("d"), F.count(F.lit(1)).alias("m"))
    # One row per cohort and follow-up time, at most as many as the panel has months.
    on = F.sum("m").over(Window.partitionBy(*by).orderBy("t").rowsBetween(0, Window.unboundedFollowing))
    times = times.withColumn("n", on)
    aggs = [F.sum("m").alias("birth_cohort_n"), F.sum("d").alias("failures")]
    for name, months in SURVIVAL_HORIZONS.items():
        before = F.col("t") < months
        none_left = F.max(F.when(before & (F.col("d") == F.col("n")), 1)).isNotNull()
        log = F.coalesce(F.sum(F.when(before & (F.col("d") < F.col("n")), F.ln(1 - F.col("d") / F.col("n")))), F.lit(0.0))
        seen = F.coalesce(F.sum(F.when(~before, F.col("m"))), F.lit(0)) > 0
        aggs.append(F.when(none_left, F.lit(0.0)).when(seen, F.exp(log)).alias(name))
    return times.groupBy(*by).agg(*aggs)
