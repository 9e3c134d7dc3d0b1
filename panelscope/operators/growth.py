"""Growth rates, comparison with official growth, shift-share, employment-change
decomposition and turning points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import guarded_rolling_corr, nearest_event, period_index


def pct_change(col: str, n: int, groups: list[str], order: str = "ref_date"):
    """Positional percent change against the row ``n`` back within the group."""
    prev = F.lag(F.col(col), n).over(Window.partitionBy(*groups).orderBy(order))
    return td(col, prev) - F.lit(1.0)


def calendar_pct_change(agg: DataFrame, col: str, months: int, groups: list[str], name: str) -> DataFrame:
    """Percent change against the value exactly ``months`` calendar months earlier (NULL if absent).

    A join of the aggregated series with itself shifted by ``add_months``; the
    series has one row per (group, month).
    """
    prev = agg.select(*groups, F.add_months("ref_date", months).alias("ref_date"), F.col(col).alias(f"_prev_{name}"))
    j = agg.join(prev, groups + ["ref_date"], "left")
    return j.withColumn(name, td(col, f"_prev_{name}") - F.lit(1.0)).drop(f"_prev_{name}")


def compute_growth_rates(df: DataFrame, employment_col: str, grouping_cols: list[str],
                         weight_col: str | None = None, calendar: bool = False) -> DataFrame:
    """Sum (optionally weighted) employment by ref_date x groups; MoM and YoY growth per group.

    Default: positional (previous row / 12 rows back within the group). ``calendar=True``
    compares with the same group 1 and 12 calendar months earlier instead.
    """
    emp = F.col(employment_col)
    if weight_col:
        emp = emp * F.col(weight_col)
    agg = df.groupBy("ref_date", *grouping_cols).agg(F.sum(emp).alias("employment"))
    if calendar:
        g = list(grouping_cols)
        out = calendar_pct_change(agg, "employment", 1, g, "mom_growth")
        return calendar_pct_change(out, "employment", 12, g, "yoy_growth")
    return agg.withColumns({
        "mom_growth": pct_change("employment", 1, grouping_cols),
        "yoy_growth": pct_change("employment", 12, grouping_cols),
    })


def compare_growth(payroll_growth: DataFrame, official_growth: DataFrame, grouping_cols: list[str],
                   window: int = 12) -> DataFrame:
    """Inner join on ref_date (+ shared groups); difference and guarded rolling correlation per group."""
    shared = [c for c in grouping_cols if c in payroll_growth.columns and c in official_growth.columns]
    keys = ["ref_date"] + shared
    p = payroll_growth.select(*keys, F.col("yoy_growth").alias("payroll_yoy"))
    o = official_growth.select(*keys, F.col("yoy_growth").alias("ces_yoy"))
    m = p.join(o, keys, "inner")
    m = m.withColumns({
        "growth_diff": F.col("payroll_yoy") - F.col("ces_yoy"),
        "abs_diff": F.abs(F.col("payroll_yoy") - F.col("ces_yoy")),
    })
    return m.withColumn(f"rolling_corr_{window}",
                        guarded_rolling_corr("payroll_yoy", "ces_yoy", shared, "ref_date", window))


def _simple_divergence(p: DataFrame, o: DataFrame, p_col: str, o_col: str) -> DataFrame:
    pa = p.groupBy("quarter").agg(F.sum(p_col).alias("_p"))
    oa = o.groupBy("quarter").agg(F.sum(o_col).alias("_o"))
    m = pa.join(oa, "quarter", "inner")
    total = (pct_change("_p", 1, [], "quarter")
             - pct_change("_o", 1, [], "quarter"))
    m = m.withColumn("total_divergence", total)
    return m.select("quarter", "total_divergence", F.lit(0.0).alias("composition_effect"),
                    F.col("total_divergence").alias("within_cell_effect"))


def decompose_growth_divergence(payroll: DataFrame, official: DataFrame,
                                grouping_cols: list[str] | None = None) -> DataFrame:
    """Shift-share by quarter: composition = sum (w_p - w_o) g_o, within = sum w_p (g_p - g_o).

    Cells are all ``grouping_cols``; with none (or cells missing on the official
    side) the divergence is the difference of total growth rates.
    """
    cells = list(grouping_cols or [])
    p_col = "payroll_employment" if "payroll_employment" in payroll.columns else "employment"
    o_col = "employment" if "employment" in official.columns else p_col
    if not cells or any(c not in payroll.columns or c not in official.columns for c in cells):
        return _simple_divergence(payroll, official, p_col, o_col)

    def side(df, col, e, w, g):
        c = df.groupBy("quarter", *cells).agg(F.sum(col).alias(e))
        c = c.withColumn(w, td(e, F.sum(e).over(Window.partitionBy("quarter"))))
        return c.withColumn(g, pct_change(e, 1, cells, "quarter"))

    pc = side(payroll, p_col, "p_emp", "w_p", "g_p")
    oc = side(official, o_col, "o_emp", "w_o", "g_o")
    m = pc.join(oc, ["quarter"] + cells, "inner")
    comp = (F.col("w_p") - F.col("w_o")) * F.col("g_o")
    within = F.col("w_p") * (F.col("g_p") - F.col("g_o"))
    r = m.groupBy("quarter").agg(F.coalesce(F.sum(comp), F.lit(0.0)).alias("composition_effect"),
                                 F.coalesce(F.sum(within), F.lit(0.0)).alias("within_cell_effect"))
    return r.select("quarter", (F.col("composition_effect") + F.col("within_cell_effect")).alias("total_divergence"),
                    "composition_effect", "within_cell_effect")


def decompose_employment_change(payroll: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Change between consecutive observed dates split into continuing, entering and exiting clients.

    Per client (and group) the previous / next observed date index comes from a
    window over that client's month rows; exits are attributed to the next
    date. total = within + entry - exit; the first date has no row.
    """
    g = list(grouping_cols or [])
    idx = period_index(payroll)
    cm = (payroll.groupBy(*g, "client_id", "ref_date")
          .agg(F.sum("qualified_employment").alias("_e"))
          .join(idx, "ref_date"))  # idx: one row per observed date
    w = Window.partitionBy(*g, "client_id").orderBy("_idx")
    cm = cm.select("*", F.lag("_idx").over(w).alias("_pi"), F.lag("_e").over(w).alias("_pe"),
                   F.lead("_idx").over(w).alias("_ni"))
    cont = F.coalesce(F.col("_pi") == F.col("_idx") - 1, F.lit(False))
    zero = F.lit(0).cast("bigint")
    cur = cm.select(*g, "_idx",
                    F.when(cont, F.col("_e") - F.col("_pe")).otherwise(zero).alias("within_change"),
                    F.when(~cont, F.col("_e")).otherwise(zero).alias("entry_contribution"),
                    zero.alias("exit_contribution"))
    gone = F.col("_ni").isNull() | (F.col("_ni") != F.col("_idx") + 1)
    ex = cm.filter(gone).select(*g, (F.col("_idx") + 1).alias("_idx"), zero.alias("within_change"),
                                zero.alias("entry_contribution"), F.col("_e").alias("exit_contribution"))
    r = (cur.unionByName(ex).filter(F.col("_idx") > 0)
         .groupBy(*g, "_idx").agg(*[F.sum(c).alias(c) for c in
                                    ("within_change", "entry_contribution", "exit_contribution")])
         .join(idx, "_idx"))  # drops exits beyond the last date
    total = F.col("within_change") + F.col("entry_contribution") - F.col("exit_contribution")
    return r.select("ref_date", *g, total.alias("total_change"), "within_change", "entry_contribution",
                    "exit_contribution")


def turning_points(growth: DataFrame, groups: list[str] | None = None, col: str = "yoy_growth") -> DataFrame:
    """Dates where the sign of ``col`` flips (sign difference of magnitude 2)."""
    g = list(groups or [])
    s = F.signum(F.col(col))
    d = s - F.lag(s).over(Window.partitionBy(*g).orderBy("ref_date"))
    return growth.select(*g, "ref_date", d.alias("_turn")).filter(F.abs("_turn") == 2).select(*g, "ref_date")


def analyze_turning_points(payroll_growth: DataFrame, official_growth: DataFrame,
                           grouping_cols: list[str] | None = None) -> DataFrame:
    """Match each payroll turning point to the nearest official one; lead/lag in months."""
    g = list(grouping_cols or [])
    pt = turning_points(payroll_growth, g).withColumnRenamed("ref_date", "payroll_turn_date")
    ot = turning_points(official_growth, g).withColumnRenamed("ref_date", "official_turn_date")
    m = nearest_event(pt, ot, g, "payroll_turn_date", "official_turn_date")
    m = m.withColumn("lead_lag_months",
                     F.round(F.datediff("payroll_turn_date", "official_turn_date") / F.lit(30.0), 1))
    w = Window.partitionBy(*g)
    return m.withColumns({"median_lead_lag": F.median("lead_lag_months").over(w),
                          "mean_lead_lag": F.avg("lead_lag_months").over(w)})
