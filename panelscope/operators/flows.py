"""Gross job flows: hires, separations, continuing employment and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import period_index, spread

FLOW_COLUMNS = ["hires", "separations", "employment", "continuing_employment",
                "hire_rate", "separation_rate", "churn_rate", "net_growth_rate"]


def _rates(df: DataFrame) -> DataFrame:
    h, s = F.col("hires"), F.col("separations")
    return df.withColumns({
        "hire_rate": td(h, "employment"),
        "separation_rate": td(s, "employment"),
        "churn_rate": td(h + s, "employment"),
        "net_growth_rate": td(h - s, "employment"),
    })


def compute_job_flows(payroll: DataFrame, grouping_cols: list[str], source: str = "auto") -> DataFrame:
    """Flows by ref_date x groups.

    source: 'employees' (employee_id presence month to month), 'columns'
    (hires/separations columns), 'entry_exit' (employment of entering/exiting
    clients) or 'auto' (first available, in that order).
    """
    cols = payroll.columns
    if source == "auto":
        source = ("employees" if "employee_id" in cols
                  else "columns" if "hires" in cols and "separations" in cols else "entry_exit")
    if source == "employees":
        return flows_from_employees(payroll, grouping_cols)
    by = ["ref_date"] + list(grouping_cols)
    e = F.col("qualified_employment")
    if source == "columns":
        agg = payroll.groupBy(*by).agg(F.sum("hires").alias("hires"), F.sum("separations").alias("separations"),
                                       F.sum(e).alias("employment"))
    else:
        zero = F.lit(0).cast("bigint")
        hires = (F.sum(F.when(F.col("entry_month") == F.col("ref_date"), e).otherwise(zero))
                 if "entry_month" in cols else zero)
        seps = (F.sum(F.when(F.col("exit_month") == F.col("ref_date"), e).otherwise(zero))
                if "exit_month" in cols else zero)
        agg = payroll.groupBy(*by).agg(F.sum(e).alias("employment"), hires.alias("hires"), seps.alias("separations"))
    agg = agg.withColumn("continuing_employment", F.col("employment") - F.col("hires"))
    return _rates(agg).select(*by, *FLOW_COLUMNS)


def flows_from_employees(employees: DataFrame, grouping_cols: list[str]) -> DataFrame:
    """Employee-set differences between consecutive observed dates, per group.

    For each (group, employee) the previous and next observed date index come
    from one window; an employee is a hire when absent at the previous date
    (everyone on the first date) and a separation at the next date when absent
    there. Arrivals, stays and departures come from one pass and one group-by, so a
    group keeps its separations when nobody is left in it, and a NULL group is
    a group. A (group, date) has a row if it has employees or separations.
    """
    g = list(grouping_cols)
    idx = period_index(employees)
    # Distinct rows and window share one exchange; the date index is bounded by the calendar.
    pres = spread(employees.select(*g, "employee_id", "ref_date"), *g, "employee_id").distinct().join(F.broadcast(idx), "ref_date")
    w = Window.partitionBy(*g, "employee_id").orderBy("_idx")
    pres = pres.select(*g, "_idx", F.lag("_idx").over(w).alias("_pi"), F.lead("_idx").over(w).alias("_ni"))
    cont = F.coalesce(F.col("_pi") == F.col("_idx") - 1, F.lit(False)).cast("int")
    gone = F.col("_ni").isNull() | (F.col("_ni") != F.col("_idx") + 1)
    here = F.struct(F.col("_idx"), F.lit(1).alias("_e"), cont.alias("_c"), F.lit(0).alias("_s"))
    left = F.struct((F.col("_idx") + 1).alias("_idx"), F.lit(0).alias("_e"), F.lit(0).alias("_c"), F.lit(1).alias("_s"))
    events = pres.select(*g, F.inline(F.when(gone, F.array(here, left)).otherwise(F.array(here))))
    r = events.groupBy(*g, "_idx").agg(
        F.sum("_e").alias("employment"), F.sum(F.col("_e") - F.col("_c")).alias("hires"),
        F.sum("_c").alias("continuing_employment"), F.sum("_s").alias("separations"))
    r = r.join(F.broadcast(idx), "_idx")  # departures after the last observed date fall away
    return _rates(r).select("ref_date", *g, *FLOW_COLUMNS)


def compute_job_flows_by_geography(payroll: DataFrame, geo_col: str = "state_fips",
                                   grouping_cols: list[str] | None = None, source: str = "auto") -> DataFrame:
    return compute_job_flows(payroll, [geo_col] + list(grouping_cols or []), source)


def compute_job_flows_by_industry(payroll: DataFrame, industry_col: str = "supersector",
                                  grouping_cols: list[str] | None = None, source: str = "auto") -> DataFrame:
    return compute_job_flows(payroll, [industry_col] + list(grouping_cols or []), source)


def compute_job_flows_by_size(payroll: DataFrame, grouping_cols: list[str] | None = None,
                              source: str = "auto") -> DataFrame:
    return compute_job_flows(payroll, ["size_class"] + list(grouping_cols or []), source)
