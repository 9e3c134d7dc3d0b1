"""Earnings distribution (exact nearest-rank quantiles) and earnings growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import grouped_quantiles
from panelscope.operators.growth import pct_change

EARNINGS_QUANTILES = {"p10_earnings": 0.10, "p25_earnings": 0.25, "p75_earnings": 0.75, "p90_earnings": 0.90}
EARNINGS_COLUMNS = ["mean_earnings", "median_earnings", "p10_earnings", "p25_earnings", "p75_earnings",
                    "p90_earnings", "std_earnings", "cv_earnings"]


def compute_earnings_distribution(payroll: DataFrame, grouping_cols: list[str]) -> DataFrame:
    by = ["ref_date"] + list(grouping_cols)
    if "gross_pay" not in payroll.columns:
        empty = [F.lit(None).cast("double").alias(c) for c in EARNINGS_COLUMNS]
        return payroll.select(*by, *empty).filter(F.lit(False))
    pos = payroll.filter(F.col("gross_pay").isNotNull() & (F.col("gross_pay") > 0)).select(*by, "gross_pay")
    d = grouped_quantiles(pos, by, "gross_pay", EARNINGS_QUANTILES, median="median_earnings",
                          extra_aggs=[F.avg("gross_pay").alias("mean_earnings"),
                                      F.stddev_samp("gross_pay").alias("std_earnings")])
    d = d.withColumn("cv_earnings", td("std_earnings", "mean_earnings"))
    return d.select(*by, *EARNINGS_COLUMNS)


def compute_earnings_growth(payroll: DataFrame, grouping_cols: list[str]) -> DataFrame:
    d = compute_earnings_distribution(payroll, grouping_cols)
    g = list(grouping_cols)
    return d.withColumns({
        "mean_earnings_yoy": pct_change("mean_earnings", 12, g),
        "median_earnings_yoy": pct_change("median_earnings", 12, g),
    })
