"""Client tenure, entry/exit churn and vintage analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import grouped_quantiles


def _first_last(value: str):
    """Value at the earliest / latest ref_date (ties broken by the value itself)."""
    v = F.col(value)
    return (F.min_by(v, F.struct(F.col("ref_date"), v)), F.max_by(v, F.struct(F.col("ref_date"), v)))


def compute_client_tenure(payroll: DataFrame, extra_first: list[str] | None = None) -> DataFrame:
    """One row per client: first/last observed, months observed, first/last/mean employment,
    first is_birth, tenure in months (days/30 rounded)."""
    first_e, last_e = _first_last("qualified_employment")
    aggs = [
        F.min("ref_date").alias("first_observed"),
        F.max("ref_date").alias("last_observed"),
        F.count_distinct("ref_date").alias("months_observed"),
        first_e.alias("initial_emp"),
        last_e.alias("final_emp"),
        F.avg("qualified_employment").alias("avg_emp"),
        _first_last("is_birth")[0].alias("is_likely_birth"),
    ]
    for c in extra_first or []:
        aggs.append(_first_last(c)[0].alias(c))
    t = payroll.groupBy("client_id").agg(*aggs)
    return t.withColumn("tenure_months",
                        F.round(F.datediff("last_observed", "first_observed") / F.lit(30.0)).cast("bigint"))


def compute_client_entry_exit(payroll: DataFrame, grouping_cols: list[str]) -> DataFrame:
    by = ["ref_date"] + list(grouping_cols)
    agg = payroll.groupBy(*by).agg(
        F.count_distinct("client_id").alias("active_clients"),
        F.count_if(F.col("entry_month") == F.col("ref_date")).alias("entries"),
        F.count_if(F.col("exit_month") == F.col("ref_date")).alias("exits"),
    )
    return agg.withColumns({
        "entry_rate": td("entries", "active_clients"),
        "exit_rate": td("exits", "active_clients"),
        "churn_rate": td(F.col("entries") + F.col("exits"), "active_clients"),
        "net_client_change": F.col("entries") - F.col("exits"),
    })


def client_churn_by_geography(payroll: DataFrame, geo_col: str = "state_fips") -> DataFrame:
    return compute_client_entry_exit(payroll, [geo_col])


def client_churn_by_industry(payroll: DataFrame, industry_col: str = "supersector") -> DataFrame:
    return compute_client_entry_exit(payroll, [industry_col])


def client_churn_by_size(payroll: DataFrame) -> DataFrame:
    return compute_client_entry_exit(payroll, ["size_class"])


def client_vintage(payroll: DataFrame, period: str = "year") -> DataFrame:
    """client_id -> vintage (year, or 'YYYYQn' when period='quarter') of the first observation."""
    first = F.min("ref_date")
    v = F.year(first) if period == "year" else F.concat(F.year(first).cast("string"), F.lit("Q"),
                                                          F.quarter(first).cast("string"))
    name = "vintage_year" if period == "year" else "vintage_quarter"
    return payroll.groupBy("client_id").agg(v.alias(name))


def compute_vintage_analysis(payroll: DataFrame, grouping_cols: list[str], period: str = "year") -> DataFrame:
    """Employment and distinct clients by ref_date x vintage x groups.

    The vintage is a per-client aggregate joined back (AQE splits a hot client's
    partition), not a window over all of a client's rows.
    """
    vint = client_vintage(payroll, period)
    name = vint.columns[1]
    j = payroll.join(vint, "client_id")
    return j.groupBy("ref_date", name, *grouping_cols).agg(
        F.sum("qualified_employment").alias("employment"),
        F.count_distinct("client_id").alias("client_count"),
    )


def compute_vintage_shares(payroll: DataFrame, period: str = "year", threshold: float = 0.3) -> DataFrame:
    v = compute_vintage_analysis(payroll, [], period)
    name = v.columns[1]
    w = Window.partitionBy("ref_date")
    v = v.withColumn("total_emp", F.sum("employment").over(w))
    v = v.withColumn("employment_share", td("employment", "total_emp"))
    latest = F.max(name).over(w)
    return v.withColumn("is_contaminated", (F.col(name) == latest) & (F.col("employment_share") > threshold))


def tenure_summary_by_group(payroll: DataFrame, group_col: str) -> DataFrame:
    """Tenure distribution by the client's first value of ``group_col``."""
    t = compute_client_tenure(payroll, extra_first=[group_col])
    return grouped_quantiles(
        t, [group_col], "tenure_months", {"p25_tenure": 0.25, "p75_tenure": 0.75}, median="median_tenure",
        extra_aggs=[F.avg("tenure_months").alias("mean_tenure"),
                    F.stddev_samp("tenure_months").alias("std_tenure"),
                    F.count_distinct("client_id").alias("client_count")],
    ).select(group_col, "mean_tenure", "median_tenure", "p25_tenure", "p75_tenure", "std_tenure", "client_count")
