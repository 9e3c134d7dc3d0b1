"""Multi-level client-month panel (one grouping-sets aggregate) and stable-panel filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.functions.cols import days_over_30

KEY_COLUMNS = ["supersector", "state_fips", "size_class"]
# Aggregation levels: grouping_level name -> key columns (besides ref_date, quarter).
AGGREGATION_LEVELS: list[tuple[str, list[str]]] = [
    ("national", []),
    ("supersector", ["supersector"]),
    ("state", ["state_fips"]),
    ("size_class", ["size_class"]),
    ("supersector_state", ["supersector", "state_fips"]),
    ("supersector_size_class", ["supersector", "size_class"]),
]
PANEL_MEASURES = ["payroll_employment", "client_count", "birth_count", "birth_determinable_count",
                  "entry_count", "exit_count", "continuing_employment"]


def _same_period(d: str, match: str) -> Column:
    """entry/exit test: exact date equality (parity) or the same calendar month (match='month')."""
    if match == "month":
        return F.trunc(F.col(d), "MM") == F.trunc(F.col("ref_date"), "MM")
    return F.col(d) == F.col("ref_date")


def panel_measures(match: str = "date") -> list[Column]:
    e = F.col("qualified_employment")
    entering = _same_period("entry_month", match)
    exiting = _same_period("exit_month", match)
    continuing = (~_same_period("entry_month", match)) & (
        F.col("exit_month").isNull() | ~_same_period("exit_month", match))
    return [
        F.coalesce(F.sum(e), F.lit(0)).cast("bigint").alias("payroll_employment"),
        F.count_distinct(F.when(e > 0, F.col("client_id"))).alias("client_count"),
        F.count_if(F.col("is_birth")).alias("birth_count"),
        F.count(F.col("is_birth")).alias("birth_determinable_count"),
        F.count_if(entering).alias("entry_count"),
        F.count_if(exiting).alias("exit_count"),
        F.coalesce(F.sum(F.when(continuing, e)), F.lit(0)).cast("bigint").alias("continuing_employment"),
    ]


def _gid(level_cols: list[str]) -> int:
    n = len(KEY_COLUMNS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(KEY_COLUMNS) if c not in level_cols)


def level_names(levels: list[tuple[str, list[str]]] = AGGREGATION_LEVELS) -> tuple[list[list[str]], Column]:
    """The grouping sets of the levels, and the level's name by the grouping id ``_gid``."""
    name = F.lit(None).cast("string")
    for level, cols in levels:
        name = F.when(F.col("_gid") == _gid(cols), F.lit(level)).otherwise(name)
    return [["ref_date", "quarter"] + cols for _, cols in levels], name


def build_panel(payroll: DataFrame, levels: list[tuple[str, list[str]]] | None = None,
                match: str = "date") -> DataFrame:
    """All aggregation levels in one scan: GROUPING SETS + grouping_id -> grouping_level.

    Keys that are not part of a level are NULL. The distinct client count is
    planned by Spark as a two-phase aggregate keyed on (cell, client), so a
    large cell is spread over many tasks. ``match='month'`` counts a day-1
    entry_month as an entry in its month (the default compares dates exactly).
    """
    sets, level = level_names(levels or AGGREGATION_LEVELS)
    agg = payroll.groupingSets(sets, "ref_date", "quarter", *KEY_COLUMNS).agg(
        *panel_measures(match), F.grouping_id().alias("_gid"))  # ref_date, quarter always grouped
    return agg.select(level.alias("grouping_level"), "ref_date", "quarter", *KEY_COLUMNS, *PANEL_MEASURES)


def panel_level(panel: DataFrame, level: str) -> DataFrame:
    """Select one aggregation level (drops the key columns that level does not use)."""
    cols = dict(AGGREGATION_LEVELS)[level]
    return panel.filter(F.col("grouping_level") == level).select(
        "ref_date", "quarter", *cols, *PANEL_MEASURES)


def filter_stable_panel(payroll: DataFrame, min_tenure_months: float = 12) -> DataFrame:
    """Rows of clients observed over at least ``min_tenure_months`` (days/30)."""
    stable = (payroll.groupBy("client_id")
              .agg(F.min("ref_date").alias("_first"), F.max("ref_date").alias("_last"))
              .filter(days_over_30("_last", "_first") >= F.lit(float(min_tenure_months)))
              .select("client_id"))
    return payroll.join(stable, "client_id", "left_semi")
