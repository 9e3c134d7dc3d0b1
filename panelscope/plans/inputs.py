"""Shared inputs of the registered queries (plans over the driver's tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelscope.operators.panel import AGGREGATION_LEVELS, build_panel, panel_level
from panelscope.sources import synth
from panelscope.sources.official import (normalise_bed, normalise_ces, official_cells, qcew_keys,
                                         unpivot_qcew_months)


def payroll(spark: SparkSession, d: str, with_flows: bool = False) -> DataFrame:
    return synth.payroll(spark, d, with_flows)


def panel(spark: SparkSession, d: str) -> DataFrame:
    return build_panel(payroll(spark, d))


def panel_at(spark: SparkSession, d: str, level: str) -> DataFrame:
    """One aggregation level, computed alone (a single grouping set, no 6x Expand)."""
    levels = [(level, dict(AGGREGATION_LEVELS)[level])]
    return panel_level(build_panel(payroll(spark, d), levels), level)


def official_long(spark: SparkSession, d: str) -> DataFrame:
    return qcew_keys(unpivot_qcew_months(synth.qcew_raw(spark, d)))


def official(spark: SparkSession, d: str, cols: list[str], slice_name: str) -> DataFrame:
    return official_cells(official_long(spark, d), cols, slice_name)


def ces(spark: SparkSession, d: str) -> DataFrame:
    return normalise_ces(synth.ces_raw(spark, d))


def bed(spark: SparkSession, d: str) -> DataFrame:
    return normalise_bed(synth.bed_raw(spark, d))
