"""Tables behind the report exhibits (the drawing itself is not rebuilt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import SUPERSECTOR_MAP

# Pivot columns: every supersector the industry map can produce, in map order.
SUPERSECTOR_NAMES: list[str] = list(dict.fromkeys(SUPERSECTOR_MAP.values()))
RELIABILITY_SCORES = {"reliable": 1.0, "marginal": 0.5, "insufficient": 0.0}


def _latest(df: DataFrame, at=None) -> DataFrame:
    """Rows of one month: ``at`` or the latest ref_date (a scalar subquery, run once)."""
    when = F.lit(at).cast("date") if at is not None else df.agg(F.max("ref_date")).scalar()
    return df.filter(F.col("ref_date") == when)


def cell_matrix(cells: DataFrame, row: str, col: str, value: str, col_values: list | None = None) -> DataFrame:
    """row x col matrix of ``value`` (one value per cell)."""
    return cells.groupBy(row).pivot(col, col_values).agg(F.max(value))


def coverage_matrix(coverage: DataFrame, value: str = "coverage_ratio_employment", at=None) -> DataFrame:
    """State x supersector coverage for one month (X1 employment, X2 establishments)."""
    return cell_matrix(_latest(coverage, at), "state_fips", "supersector", value, SUPERSECTOR_NAMES)


def usability_matrix(reliability: DataFrame, at=None) -> DataFrame:
    """State x supersector usability score: reliable 1, marginal 0.5, insufficient 0."""
    score = F.element_at(F.create_map(*[F.lit(x) for kv in RELIABILITY_SCORES.items() for x in kv]),
                         F.col("reliability"))
    cells = _latest(reliability, at).withColumn("_score", score)
    return cell_matrix(cells, "state_fips", "supersector", "_score", SUPERSECTOR_NAMES)


def share_means(share: DataFrame, dimension: str = "supersector") -> DataFrame:
    """Mean payroll and official share per cell over time (X3)."""
    return share.groupBy(dimension).agg(F.avg("payroll_share").alias("payroll_share"),
                                        F.avg("qcew_share").alias("qcew_share"))


def vintage_matrix(vintage_shares: DataFrame, vintages: list) -> DataFrame:
    """ref_date x vintage employment share, missing -> 0 (X5).

    ``vintages`` declares the columns; other vintages raise an error when the rows are read,
    so that no share gets lost unseen.
    """
    known = F.col("vintage_year").isin([int(v) for v in vintages]) | F.col("vintage_year").isNull()
    checked = vintage_shares.withColumn("employment_share", F.when(known, F.col("employment_share")).otherwise(
        F.raise_error(F.concat(F.lit("undeclared vintage "), F.col("vintage_year").cast("string"))).cast("double")))
    return checked.groupBy("ref_date").agg(*[
        F.coalesce(F.max(F.when(F.col("vintage_year") == int(v), F.col("employment_share"))), F.lit(0.0)).alias(str(v))
        for v in vintages])


def histogram(df: DataFrame, value: str, min_bins: int = 10, max_bins: int = 50, per_bin: int = 10,
              n_bins: int | None = None) -> DataFrame:
    """Equal-width histogram over [min, max]: ``n_bins`` bins, or min(max_bins, max(min_bins, n // per_bin)).

    The last bin includes the maximum; a constant column uses [v - 0.5, v + 0.5].
    Scalars come from one aggregate evaluated as scalar subqueries; every bin
    is reported, empty ones with count 0.
    """
    v = F.col(value).cast("double")
    vals = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    # one scalar subquery (a struct of count, min, max), evaluated once
    stats = vals.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("s"))
    sc = stats.scalar()
    n, lo0, hi0 = sc.getField("n"), sc.getField("lo"), sc.getField("hi")
    same = lo0 == hi0
    lo = F.when(same, lo0 - F.lit(0.5)).otherwise(lo0)
    hi = F.when(same, hi0 + F.lit(0.5)).otherwise(hi0)
    bins = F.lit(n_bins) if n_bins else F.least(F.lit(max_bins), F.greatest(F.lit(min_bins), F.floor(n / F.lit(per_bin)).cast("int")))
    width = (hi - lo) / bins
    idx = F.least(F.floor((F.col("_v") - lo) * (bins / (hi - lo))).cast("int"), bins - 1)
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = stats.select(F.explode(F.sequence(F.lit(0), bins - 1)).alias("bin")).filter(F.lit(n) > 0)
    out = all_bins.join(counts, "bin", "left")
    return out.select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                      F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def survival_long(survival: DataFrame) -> DataFrame:
    """(entry_quarter, horizon_quarters, survival_rate), NULL rates dropped (X7)."""
    cols = [c for c in survival.columns if c.startswith("survival_")]
    long = survival.unpivot(["entry_quarter"], cols, "_h", "survival_rate")
    return long.select("entry_quarter", F.regexp_extract("_h", r"survival_(\d+)q", 1).cast("int").alias("horizon_quarters"),
                       "survival_rate").filter(F.col("survival_rate").isNotNull())


def employment_change_stack(change: DataFrame) -> DataFrame:
    """Series for a stacked bar: within, entry, and the exit contribution negated (X8)."""
    return change.select("ref_date", "within_change", "entry_contribution",
                         (-F.col("exit_contribution")).alias("exit_contribution"))


def headline_coverage(national_coverage: DataFrame) -> DataFrame:
    """Mean national coverage over all months, one row (X10)."""
    return national_coverage.agg(
        F.avg("coverage_ratio_employment").alias("mean_coverage_ratio_employment"),
        F.avg("coverage_ratio_estab").alias("mean_coverage_ratio_estab"),
        F.count(F.lit(1)).alias("n_months"),
    )


def csi_by_dimension(csi: dict[str, DataFrame]) -> DataFrame:
    """Union of CSI series with a ``dimension`` column (X9k)."""
    out = None
    for dim, df in csi.items():
        d = df.select("ref_date", F.lit(dim).alias("dimension"), "csi")
        out = d if out is None else out.unionByName(d)
    return out


def write_outputs(outputs: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One table per analysis (X11 CSV export, X12 parquet outputs)."""
    for name, df in outputs.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{path}/{name}")
        else:
            w.parquet(f"{path}/{name}")


# ---------------------------------------------------------------- chart series (X9)

def growth_tracking(comparison: DataFrame) -> DataFrame:
    """ref_date, payroll_yoy, ces_yoy (X9c)."""
    return comparison.select("ref_date", "payroll_yoy", "ces_yoy")


def divergence_stack(divergence: DataFrame) -> DataFrame:
    """quarter, composition and within-cell effects, with the running total of both (X9d)."""
    w = Window.orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    return divergence.select("quarter", "composition_effect", "within_cell_effect",
                             F.sum(F.col("composition_effect") + F.col("within_cell_effect")).over(w)
                             .alias("cumulative_divergence"))


def birth_rate_pairs(comparison: DataFrame) -> DataFrame:
    """ref_date, quarter, payroll and official birth rates (X9e)."""
    return comparison.select("ref_date", "quarter", "birth_rate", "bed_birth_rate")


def reweighting_series(impact: DataFrame, official_growth: DataFrame) -> DataFrame:
    """ref_date, payroll_yoy, reweighted_yoy (falls back to payroll_yoy), ces_yoy (X9h)."""
    o = official_growth.select("ref_date", F.col("yoy_growth").alias("ces_yoy"))
    return impact.join(o, "ref_date", "left").select(
        "ref_date", F.col("yoy_growth").alias("payroll_yoy"),
        F.coalesce("reweighted_yoy", "yoy_growth").alias("reweighted_yoy"), "ces_yoy")


def flow_rate_series(flows: DataFrame) -> DataFrame:
    """ref_date, hire_rate, separation_rate, churn_rate (X9i)."""
    return flows.select("ref_date", "hire_rate", "separation_rate", "churn_rate")


def churn_series(entry_exit: DataFrame) -> DataFrame:
    """ref_date, entry_rate, exit_rate, net_client_change (X9j)."""
    return entry_exit.select("ref_date", "entry_rate", "exit_rate", "net_client_change")


def earnings_band(dist: DataFrame) -> DataFrame:
    """ref_date, p10, median, p90 earnings (X9l)."""
    return dist.select("ref_date", "p10_earnings", "median_earnings", "p90_earnings")
