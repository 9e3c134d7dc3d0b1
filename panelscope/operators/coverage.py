"""Coverage ratios, share comparison, composition shift and cell reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import period_index


def compute_coverage(payroll_agg: DataFrame, official: DataFrame, grouping_cols: list[str],
                     missing: str = "null") -> DataFrame:
    """Left join panel cells to official cells; employment and establishment coverage.

    ``missing='null'`` (default) leaves the ratio NULL when the official value is
    missing; ``missing='one'`` divides by 1 instead.
    """
    keys = ["ref_date", "quarter"] + [c for c in grouping_cols if c]
    off_cols = [c for c in ("qcew_employment", "qcew_establishments") if c in official.columns]
    off = official.select(*keys, *off_cols)
    j = payroll_agg.join(off, keys, "left")
    q_emp, q_est = F.col("qcew_employment"), F.col("qcew_establishments")
    if missing == "one":
        q_emp, q_est = F.coalesce(q_emp, F.lit(1)), F.coalesce(q_est, F.lit(1))
    return j.withColumns({
        "coverage_ratio_employment": td("payroll_employment", q_emp),
        "coverage_ratio_estab": td("client_count", q_est),
    }).withColumnRenamed("client_count", "payroll_clients")


def compute_coverage_over_time(payroll_agg: DataFrame, official: DataFrame, grouping_cols: list[str],
                               missing: str = "null") -> DataFrame:
    return compute_coverage(payroll_agg, official, grouping_cols, missing)


def compute_share_comparison(payroll_agg: DataFrame, official: DataFrame, dimension: str) -> DataFrame:
    """Within-month shares on both sides, full outer join, abs deviation, misallocation index."""
    period = ["ref_date", "quarter"]
    if "qcew_employment" not in official.columns and "month1_emplvl" in official.columns:
        official = official.withColumnRenamed("month1_emplvl", "qcew_employment")
    w = Window.partitionBy(*period)
    p = payroll_agg.select(*period, dimension,
                           td("payroll_employment", F.sum("payroll_employment").over(w)).alias("payroll_share"))
    o = official.select(*period, dimension,
                        td("qcew_employment", F.sum("qcew_employment").over(w)).alias("qcew_share"))
    m = p.join(o, period + [dimension], "full_outer")
    m = m.withColumn("abs_dev", F.abs(F.coalesce("payroll_share", F.lit(0.0)) - F.coalesce("qcew_share", F.lit(0.0))))
    return m.withColumn("misallocation_index", F.sum("abs_dev").over(Window.partitionBy(*period)) / 2)


def compute_composition_shift_index(payroll_agg: DataFrame, dimension: str, dense: bool = False) -> DataFrame:
    """CSI_t = sum over cells of |share_t - share_(t-1)| (previous row of the cell); first month 0.

    By default a cell's first month, and the month after its last, add nothing. ``dense`` takes the share of a missing
    (cell, month) as 0: a cell that comes adds its share in that month, one that goes adds its last share in the next month.
    """
    share = td("payroll_employment", F.sum("payroll_employment").over(Window.partitionBy("ref_date")))
    s = payroll_agg.select("ref_date", dimension, share.alias("share"))
    w = Window.partitionBy(dimension).orderBy("ref_date")
    if not dense:
        s = s.withColumn("abs_shift", F.abs(F.col("share") - F.lag("share").over(w)))
        return s.groupBy("ref_date").agg(F.coalesce(F.sum("abs_shift"), F.lit(0.0)).alias("csi"))
    idx = period_index(payroll_agg)
    s = s.withColumn("share", F.coalesce("share", F.lit(0.0))).join(idx, "ref_date")
    s = s.select("_idx", "share", F.lag("_idx").over(w).alias("_pi"), F.lag("share").over(w).alias("_ps"), F.lead("_idx").over(w).alias("_ni"))
    here = s.select("_idx", F.when(F.col("_idx") == 0, 0.0).when(F.col("_pi") == F.col("_idx") - 1, F.abs(F.col("share") - F.col("_ps")))
                    .otherwise(F.col("share")).alias("abs_shift"))
    gone = s.filter(F.coalesce(F.col("_ni") != F.col("_idx") + 1, F.lit(True))).select((F.col("_idx") + 1).alias("_idx"), F.col("share").alias("abs_shift"))
    return (here.unionByName(gone).groupBy("_idx").agg(F.sum("abs_shift").alias("csi")).join(idx, "_idx").select("ref_date", "csi"))


def compute_cell_reliability(coverage: DataFrame, min_clients: int = 30, min_coverage: float = 0.005) -> DataFrame:
    """reliable (both thresholds met) / insufficient (both missed or no official value) / marginal."""
    n, r = F.col("payroll_clients"), F.col("coverage_ratio_employment")
    rel = (F.when(r.isNull(), F.lit("insufficient"))
           .when((n >= min_clients) & (r >= min_coverage), F.lit("reliable"))
           .when((n < min_clients) & (r < min_coverage), F.lit("insufficient"))
           .otherwise(F.lit("marginal")))
    return coverage.withColumn("reliability", rel)
