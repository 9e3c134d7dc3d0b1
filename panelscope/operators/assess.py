"""Operators the methodology documents specify beyond the core modules.

Data-quality assessment and scorecard, entry-to-exit tenure, quarterly churn,
vintage by entry quarter, quarterly and benchmarked flows, job-to-job
transitions, worker tenure, pay per employee, reweighting quality, lookups for
Census regions / goods-services domain, coverage at every panel level and
winsorising.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import SUPERSECTOR_MAP, td
from panelscope.functions.stats import grouped_quantiles, period_index, safe_corr, spread
from panelscope.operators.compare import theil_sen
from panelscope.operators.coverage import compute_cell_reliability
from panelscope.operators.panel import AGGREGATION_LEVELS

# Census regions and divisions of the state FIPS codes.
CENSUS_DIVISIONS: dict[str, list[str]] = {
    "New England": ["09", "23", "25", "33", "44", "50"],
    "Middle Atlantic": ["34", "36", "42"],
    "East North Central": ["17", "18", "26", "39", "55"],
    "West North Central": ["19", "20", "27", "29", "31", "38", "46"],
    "South Atlantic": ["10", "11", "12", "13", "24", "37", "45", "51", "54"],
    "East South Central": ["01", "21", "28", "47"],
    "West South Central": ["05", "22", "40", "48"],
    "Mountain": ["04", "08", "16", "30", "32", "35", "49", "56"],
    "Pacific": ["02", "06", "15", "41", "53"],
}
CENSUS_REGIONS: dict[str, list[str]] = {
    "Northeast": ["New England", "Middle Atlantic"],
    "Midwest": ["East North Central", "West North Central"],
    "South": ["South Atlantic", "East South Central", "West South Central"],
    "West": ["Mountain", "Pacific"],
}
# Goods-producing supersectors (all others are service-providing).
GOODS_PRODUCING = ["Mining and logging", "Construction", "Manufacturing"]

STATE_DIVISION = {st: div for div, sts in CENSUS_DIVISIONS.items() for st in sts}
DIVISION_REGION = {div: reg for reg, divs in CENSUS_REGIONS.items() for div in divs}


def _map(d: dict) -> F.Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def add_geography_and_domain(df: DataFrame) -> DataFrame:
    """Add census_division, census_region (unknown FIPS -> 'Unknown') and domain."""
    div = F.coalesce(F.element_at(_map(STATE_DIVISION), F.col("state_fips")), F.lit("Unknown"))
    reg = F.coalesce(F.element_at(_map(DIVISION_REGION), div), F.lit("Unknown"))
    out = df.withColumns({"census_division": div, "census_region": reg})
    if "supersector" in df.columns:
        out = out.withColumn("domain", F.when(F.col("supersector").isin(GOODS_PRODUCING), F.lit("Goods-producing"))
                             .otherwise(F.lit("Service-providing")))
    return out


# ---------------------------------------------------------------- data quality assessment

def column_completeness(df: DataFrame) -> DataFrame:
    """(column, completeness): share of non-NULL values of every column, one scan."""
    aggs = [F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    return wide.unpivot([], df.columns, "column", "completeness")


def zero_employment_months(payroll: DataFrame) -> DataFrame:
    """Per client: months observed and months with zero employment."""
    return payroll.groupBy("client_id").agg(
        F.count_distinct("ref_date").alias("months_observed"),
        F.count_if(F.col("qualified_employment") == 0).alias("zero_employment_months"),
    )


def valid_naics(code: str = "naics_code") -> F.Column:
    c = F.col(code).cast("string")
    return (F.coalesce(c.rlike(r"^[0-9]{6}$"), F.lit(False))
            & F.substring(c, 1, 2).isin(list(SUPERSECTOR_MAP)))


def naics_validity(payroll: DataFrame) -> DataFrame:
    """Share of rows per month whose industry code is 6 digits with a known sector."""
    return payroll.groupBy("ref_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(valid_naics()).alias("n_valid"),
    ).withColumn("validity_rate", td("n_valid", "n_rows"))


def filing_lag_distribution(payroll: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Days from ref_date to filing_date: mean, nearest-rank p10/p50/p90 and share filed late."""
    g = list(groups if groups is not None else ["ref_date"])
    lag = payroll.select(*g, F.datediff("filing_date", "ref_date").alias("filing_lag_days"))
    return grouped_quantiles(
        lag, g, "filing_lag_days", {"p10_lag": 0.1, "p50_lag": 0.5, "p90_lag": 0.9},
        extra_aggs=[F.avg("filing_lag_days").alias("mean_lag"),
                    F.avg((F.col("filing_lag_days") > 0).cast("double")).alias("share_after_ref_date"),
                    F.count(F.lit(1)).alias("n_filed")])


# Fixed thresholds of the scorecard (configurable through the arguments).
DEFAULT_THRESHOLDS = {"completeness": 0.99, "naics_validity": 0.95, "zero_employment_share": 0.05,
                      "median_filing_lag_days": 45.0}


def quality_scorecard(payroll: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """One row per metric: value, threshold and pass flag (completeness, validity, zeros, timeliness)."""
    th = dict(DEFAULT_THRESHOLDS, **(thresholds or {}))
    required = ["client_id", "ref_date", "entry_month", "is_birth", "naics_code", "state_fips", "qualified_employment"]
    cols = [c for c in required if c in payroll.columns]
    aggs = [F.least(*[F.avg(F.col(c).isNotNull().cast("double")) for c in cols]).alias("completeness"),
            F.avg(valid_naics().cast("double")).alias("naics_validity"),
            F.avg((F.col("qualified_employment") == 0).cast("double")).alias("zero_employment_share")]
    higher_is_better = {"completeness": True, "naics_validity": True, "zero_employment_share": False}
    if "filing_date" in payroll.columns:
        aggs.append(F.median(F.datediff("filing_date", "ref_date").cast("double")).alias("median_filing_lag_days"))
        higher_is_better["median_filing_lag_days"] = False
    wide = payroll.agg(*aggs)
    long = wide.unpivot([], list(higher_is_better), "metric", "value")
    thr = F.element_at(_map({k: float(v) for k, v in th.items()}), F.col("metric"))
    hib = F.element_at(_map(higher_is_better), F.col("metric"))
    return long.select("metric", "value", thr.alias("threshold"),
                       F.when(hib, F.col("value") >= thr).otherwise(F.col("value") <= thr).alias("passed"))


# ---------------------------------------------------------------- tenure, churn, vintage

def tenure_entry_to_exit(payroll: DataFrame) -> DataFrame:
    """Per client: months from entry_month to exit_month, or to the latest ref_date if still active."""
    end = payroll.agg(F.max("ref_date")).scalar()
    per = payroll.groupBy("client_id").agg(F.min("entry_month").alias("entry_month"),
                                           F.max("exit_month").alias("exit_month"))
    stop = F.coalesce(F.col("exit_month"), end)
    return per.select("client_id", "entry_month", "exit_month", F.col("exit_month").isNull().alias("active"),
                      F.round(F.datediff(stop, F.col("entry_month")) / F.lit(30.0)).cast("bigint").alias("tenure_months"))


def quarterly_churn(payroll: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Exits in the quarter / clients active in the quarter's first observed month."""
    g = list(grouping_cols or [])
    # one row per quarter (bounded by the calendar), partial-aggregated, broadcast back
    firsts = payroll.groupBy("quarter").agg(F.min("ref_date").alias("_first_m"))
    d = payroll.join((firsts), "quarter")
    out = d.groupBy("quarter", *g).agg(
        F.count_distinct(F.when(F.col("ref_date") == F.col("_first_m"), F.col("client_id"))).alias("start_clients"),
        F.count_distinct(F.when(F.col("exit_month") == F.col("ref_date"), F.col("client_id"))).alias("exits"),
    )
    return out.withColumn("churn_rate", td("exits", "start_clients"))


# ---------------------------------------------------------------- flows

def quarterly_flows(monthly_flows: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Monthly flows rolled to quarters: summed hires/separations over mean monthly employment."""
    g = list(grouping_cols or [])
    q = monthly_flows.withColumn("quarter", F.concat(F.year("ref_date").cast("string"), F.lit("Q"),
                                                     F.quarter("ref_date").cast("string")))
    out = q.groupBy("quarter", *g).agg(F.sum("hires").alias("hires"), F.sum("separations").alias("separations"),
                                       F.avg("employment").alias("avg_employment"))
    return out.withColumns({"accession_rate": td("hires", "avg_employment"),
                            "separation_rate": td("separations", "avg_employment")})


def compare_flows_to_official(quarterly: DataFrame, official: DataFrame) -> DataFrame:
    """Join quarterly payroll flows to official gross flows (quarter; official_accession/separation_rate);
    level gaps per quarter, and on every row the correlation over time and the robust trends (Theil-Sen, a quarter) of both sides."""
    m = quarterly.join(official, "quarter", "inner")
    w = Window.partitionBy()
    at = F.substring("quarter", 1, 4).cast("int") * 4 + F.substring("quarter", 6, 1).cast("int")
    sides = ["accession", "separation"]
    trends = theil_sen(m, [], at, {f"{o}{s}_rate": f"{o}{s}_trend" for s in sides for o in ("", "official_")})
    trends = trends.withColumns({f"{s}_trend_gap": F.col(f"{s}_trend") - F.col(f"official_{s}_trend") for s in sides})
    m = m.withColumn("_t", trends.select(F.struct(*trends.columns)).scalar()).select(*m.columns, "_t.*")
    return m.withColumns({
        "accession_gap": F.col("accession_rate") - F.col("official_accession_rate"),
        "separation_gap": F.col("separation_rate") - F.col("official_separation_rate"),
        "accession_corr": safe_corr("accession_rate", "official_accession_rate", w),
        "separation_corr": safe_corr("separation_rate", "official_separation_rate", w),
    })


def job_to_job(employees: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Workers who leave a client of the previous observed date for another one.

    A move is counted at the later date, once per worker: a client is new and a client of the previous
    date is gone. A second job taken up while the first goes on is no move. rate = moves / workers present.
    """
    g = list(grouping_cols or [])
    idx = period_index(employees)
    # Distinct rows and window share one exchange; the date index is bounded by the calendar.
    pres = spread(employees.select(*g, "employee_id", "client_id", "ref_date"), *g, "employee_id", "client_id").distinct().join(F.broadcast(idx), "ref_date")
    w = Window.partitionBy(*g, "employee_id", "client_id").orderBy("_idx")
    at = pres.select(*g, "employee_id", "_idx", (F.lag("_idx").over(w).eqNullSafe(F.col("_idx") - 1)).alias("_stayed"),
                     (F.lead("_idx").over(w).eqNullSafe(F.col("_idx") + 1)).alias("_stays"))
    here = F.struct(F.col("_idx"), F.lit(1).alias("_here"), (~F.col("_stayed")).cast("int").alias("_new"), F.lit(0).alias("_gone"))
    gone = F.struct((F.col("_idx") + 1).alias("_idx"), F.lit(0).alias("_here"), F.lit(0).alias("_new"), F.lit(1).alias("_gone"))
    events = at.select(*g, "employee_id", F.inline(F.when(F.col("_stays"), F.array(here)).otherwise(F.array(here, gone))))
    # a worker has few rows a date, so they are dealt out as they are
    workers = spread(events, *g, "employee_id", "_idx").groupBy(*g, "employee_id", "_idx").agg(
        F.max("_here").alias("_here"), F.max("_new").alias("_new"), F.max("_gone").alias("_gone"))
    out = workers.filter("_here = 1").groupBy(*g, "_idx").agg(
        F.count(F.lit(1)).alias("workers"), F.sum(F.col("_new") * F.col("_gone")).alias("job_to_job_moves"))
    out = out.join(F.broadcast(idx), "_idx").select(*g, "ref_date", "workers", "job_to_job_moves")
    return out.withColumn("job_to_job_rate", td("job_to_job_moves", "workers"))


def worker_tenure(employees: DataFrame) -> DataFrame:
    """Months each worker has been at the current client without a gap (gaps and islands).

    Returns one row per (employee, client, ref_date) with ``tenure_months``
    (1 in the first month of a spell).
    """
    idx = period_index(employees)
    # Distinct rows and windows share one exchange; the date index is bounded by the calendar.
    pres = (spread(employees.select("employee_id", "client_id", "ref_date"), "employee_id", "client_id").distinct()
            .join(F.broadcast(idx), "ref_date"))
    w = Window.partitionBy("employee_id", "client_id").orderBy("_idx")
    pres = pres.withColumn("_island", F.col("_idx") - F.row_number().over(w))
    ws = Window.partitionBy("employee_id", "client_id", "_island").orderBy("_idx")
    return pres.select("employee_id", "client_id", "ref_date", F.row_number().over(ws).alias("tenure_months"))


def worker_tenure_summary(employees: DataFrame) -> DataFrame:
    t = worker_tenure(employees)
    return t.groupBy("ref_date").agg(F.avg("tenure_months").alias("mean_tenure_months"),
                                     F.max("tenure_months").alias("max_tenure_months"),
                                     F.count(F.lit(1)).alias("worker_client_pairs"))


# ---------------------------------------------------------------- earnings

def pay_per_employee(payroll: DataFrame, grouping_cols: list[str] | None = None) -> DataFrame:
    """Average pay per employee = sum(gross_pay) / sum(employment), with MoM and YoY growth."""
    g = list(grouping_cols or [])
    a = payroll.groupBy("ref_date", *g).agg(F.sum("gross_pay").alias("total_pay"),
                                            F.sum("qualified_employment").alias("employment"))
    a = a.withColumn("pay_per_employee", td("total_pay", "employment"))
    w = Window.partitionBy(*g).orderBy("ref_date")
    return a.withColumns({
        "pay_mom": td("pay_per_employee", F.lag("pay_per_employee", 1).over(w)) - F.lit(1.0),
        "pay_yoy": td("pay_per_employee", F.lag("pay_per_employee", 12).over(w)) - F.lit(1.0),
    })


def compare_pay_to_official(pay: DataFrame, official_wages: DataFrame) -> DataFrame:
    """Monthly pay per employee vs official average monthly wage (weekly x 52 / 12) by quarter."""
    q = pay.withColumn("quarter", F.concat(F.year("ref_date").cast("string"), F.lit("Q"),
                                           F.quarter("ref_date").cast("string")))
    pq = q.groupBy("quarter").agg(td(F.sum("total_pay"), F.sum("employment")).alias("pay_per_employee"))
    o = official_wages.select("quarter", (F.col("avg_weekly_wage") * F.lit(52.0) / F.lit(12.0)).alias("official_monthly_wage"))
    m = pq.join(o, "quarter", "inner")
    w = Window.orderBy("quarter")
    m = m.withColumns({"pay_ratio": td("pay_per_employee", "official_monthly_wage"),
                       "pay_growth": td("pay_per_employee", F.lag("pay_per_employee").over(w)) - F.lit(1.0),
                       "official_growth": td("official_monthly_wage", F.lag("official_monthly_wage").over(w)) - F.lit(1.0)})
    return m.withColumn("growth_corr", safe_corr("pay_growth", "official_growth", Window.partitionBy()))


def official_weekly_wages(qcew_raw: DataFrame, slice_name: str = "national") -> DataFrame:
    """Average weekly wage per quarter: total wages / mean monthly employment / 13."""
    d = qcew_raw.filter((F.col("own_code") == "5") & (F.col("slice") == slice_name))
    q = d.groupBy(F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("qtr")).alias("quarter")).agg(
        F.sum("total_qtrly_wages").alias("wages"),
        ((F.sum("month1_emplvl") + F.sum("month2_emplvl") + F.sum("month3_emplvl")) / F.lit(3.0)).alias("emp"))
    return q.select("quarter", td(F.col("wages"), F.col("emp") * F.lit(13.0)).alias("avg_weekly_wage"))


# ---------------------------------------------------------------- reweighting quality, coverage levels, winsorising

def reweighting_quality(impact: DataFrame, official_growth: DataFrame) -> DataFrame:
    """MAE and correlation of raw and reweighted YoY growth against official YoY growth."""
    m = impact.join(official_growth.select("ref_date", F.col("yoy_growth").alias("official_yoy")), "ref_date")
    long = m.select("official_yoy", F.explode(F.array(*[
        F.struct(F.lit(name).alias("series"), F.col(col).alias("yoy"))
        for name, col in (("raw", "yoy_growth"), ("reweighted", "reweighted_yoy"))])).alias("s"))
    long = long.select("official_yoy", "s.series", "s.yoy")
    both = F.col("yoy").isNotNull() & F.col("official_yoy").isNotNull()
    return long.groupBy("series").agg(
        F.avg(F.when(both, F.abs(F.col("yoy") - F.col("official_yoy")))).alias("mae"),
        safe_corr("yoy", "official_yoy").alias("correlation"), F.count_if(both).alias("n_months"))


def coverage_all_levels(panel: DataFrame, official_by_level: dict[str, DataFrame]) -> DataFrame:
    """Coverage and reliability at every panel level in one null-safe equi-join.

    The official tables of the levels are unioned with a ``grouping_level`` tag
    (unused keys NULL) and joined once to the multi-level panel on
    (grouping_level, ref_date, quarter, keys <=>). Levels without an official
    table get NULL ratios and reliability 'insufficient'.
    """
    keys = ["supersector", "state_fips", "size_class"]
    off = None
    for level, cols in AGGREGATION_LEVELS:
        o = official_by_level.get(level)
        if o is None:
            continue
        o = o.select(F.lit(level).alias("_o_level"), F.col("ref_date").alias("_o_ref_date"),
                     F.col("quarter").alias("_o_quarter"),
                     *[(F.col(k) if k in cols else F.lit(None).cast("string")).alias(f"_o_{k}") for k in keys],
                     F.col("qcew_employment").cast("bigint").alias("qcew_employment"),
                     F.col("qcew_establishments").cast("bigint").alias("qcew_establishments"))
        off = o if off is None else off.unionByName(o)
    p = panel.withColumnRenamed("client_count", "payroll_clients")
    if off is None:
        j = p.withColumns({"qcew_employment": F.lit(None).cast("bigint"),
                           "qcew_establishments": F.lit(None).cast("bigint")})
    else:
        on = ((F.col("grouping_level") == F.col("_o_level")) & (F.col("ref_date") == F.col("_o_ref_date"))
              & (F.col("quarter") == F.col("_o_quarter")))
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
        j = p.join(off, on, "left").drop(*[c for c in off.columns if c.startswith("_o_")])
    j = j.withColumns({
        "coverage_ratio_employment": td("payroll_employment", "qcew_employment"),
        "coverage_ratio_estab": td("payroll_clients", "qcew_establishments"),
    })
    return compute_cell_reliability(j)


def winsorise(df: DataFrame, value: str, groups: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clip ``value`` to its group's nearest-rank [lower, upper] quantiles (bounds joined back per group)."""
    b = grouped_quantiles(df.select(*groups, value), groups, value, {"_lo": lower, "_hi": upper})
    if not groups:  # one pair of bounds: scalar subqueries, no join
        clipped = F.when(F.col(value).isNotNull(),
                         F.least(F.greatest(F.col(value), b.select("_lo").scalar()), b.select("_hi").scalar()))
        return df.select(*[clipped.alias(c) if c == value else F.col(c) for c in df.columns])
    keys = [f"_wk{i}" for i in range(len(groups))]
    b = b.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], "_lo", "_hi")
    on = None
    for g, k in zip(groups, keys):
        e = F.col(g).eqNullSafe(F.col(k))
        on = e if on is None else on & e
    j = df.join(b, on, "left")
    clipped = F.when(F.col(value).isNotNull(), F.least(F.greatest(F.col(value), F.col("_lo")), F.col("_hi")))
    return j.select(*[clipped.alias(c) if c == value else F.col(c) for c in df.columns])


def exclude_flagged(flagged_rows: DataFrame) -> DataFrame:
    return flagged_rows.filter(~F.col("has_any_flag"))
