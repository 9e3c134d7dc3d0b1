"""Flagship plan: payroll -> panel -> supersector coverage -> cell usability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelscope.operators.coverage import compute_cell_reliability, compute_coverage
from panelscope.plans.inputs import official, panel_at


def coverage_usability(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = compute_coverage(panel_at(spark, sf_dir, "supersector"),
                           official(spark, sf_dir, ["supersector"], "national"), ["supersector"])
    return compute_cell_reliability(cov)
