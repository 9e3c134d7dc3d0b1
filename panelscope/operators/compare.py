"""Comparisons with official survival and worker flows, freshness of filings, and validity against a code list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import safe_corr

# ---------------------------------------------------------------- survival (D19)


def quarter_number(date: str | Column) -> Column:
    return F.year(date) * 4 + F.quarter(date)


def quarter_name(number: Column) -> Column:
    q = (number - 1) % 4 + 1
    return F.concat(((number - q) / 4).cast("int").cast("string"), F.lit("Q"), q.cast("string"))


def spells(first: DataFrame, end: DataFrame) -> DataFrame:
    """(cohort, duration, died) of (first_q, last_q): quarters lived, and whether the end is seen before the last quarter of the data.

    ``end`` has one row, the last quarter.
    """
    return first.select(quarter_name(F.col("first_q")).alias("cohort"), (F.col("last_q") - F.col("first_q")).alias("duration"),
                        (F.col("last_q") < end.scalar()).alias("died"))


def birth_spells(payroll: DataFrame) -> DataFrame:
    """Spells of birth clients, from the quarter of their entry to the last one they are seen in."""
    last = payroll.groupBy("client_id").agg(F.max("ref_date").alias("_last"), F.min(F.when(F.col("is_birth"), F.col("entry_month"))).alias("_entry"))
    born = last.where("_entry is not null").select(quarter_number("_entry").alias("first_q"), quarter_number("_last").alias("last_q"))
    return spells(born, payroll.agg(quarter_number(F.max("ref_date"))))


def follow_up(a: DataFrame, b: DataFrame, strata: list[str]) -> DataFrame:
    """(strata, duration, n_a, d_a, n_b, d_b): of both sides, who was still there after ``duration`` quarters and who left then.

    Spells are counted by stratum and duration first, so windows run over calendar quarters, not over clients. Who has been censored
    at a duration was still there.
    """
    both = a.select(*strata, "duration", "died", F.lit(True).alias("_a")).unionByName(b.select(*strata, "duration", "died", F.lit(False).alias("_a")))
    a_, died = F.col("_a"), F.col("died")
    counts = both.groupBy(*strata, "duration").agg(F.count_if(a_).alias("_n_a"), F.count_if(a_ & died).alias("d_a"),
                                                  F.count_if(~a_).alias("_n_b"), F.count_if(~a_ & died).alias("d_b"))
    later = Window.partitionBy(*strata).orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(*strata, "duration", F.sum("_n_a").over(later).alias("n_a"), "d_a", F.sum("_n_b").over(later).alias("n_b"), "d_b")


def survival_gap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(age_quarters, payroll_at_risk, official_at_risk, payroll_survival, official_survival, gap): Kaplan-Meier curves of all cohorts together."""
    t = follow_up(a, b, [])
    w = Window.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)  # one row for each age, bounded by the calendar

    def survival(n: str, d: str) -> Column:
        share = F.when(F.col(n) > 0, 1 - F.col(d) / F.when(F.col(n) > 0, F.col(n))).otherwise(1.0)
        return F.when(F.min(share).over(w) <= 0, 0.0).otherwise(F.exp(F.sum(F.log(F.when(share > 0, share))).over(w)))
    out = t.select(F.col("duration").cast("int").alias("age_quarters"), F.col("n_a").alias("payroll_at_risk"), F.col("n_b").alias("official_at_risk"),
                   survival("n_a", "d_a").alias("payroll_survival"), survival("n_b", "d_b").alias("official_survival"))
    return out.withColumn("gap", F.col("payroll_survival") - F.col("official_survival"))


def log_rank(a: DataFrame, b: DataFrame) -> DataFrame:
    """(cohort, observed, expected, variance, chi2): the stratified log-rank comparison; cohort ``all`` adds up the strata.

    Observed and expected are deaths of the first side; ``chi2`` is null where nothing can differ.
    """
    t = follow_up(a, b, ["cohort"])
    n, d = F.col("n_a") + F.col("n_b"), F.col("d_a") + F.col("d_b")
    expected = d * F.col("n_a") / n
    variance = F.when(n > 1, d * (F.col("n_a") / n) * (F.col("n_b") / n) * (n - d) / F.when(n > 1, n - 1)).otherwise(0.0)
    out = t.select("cohort", "d_a", expected.alias("_e"), variance.alias("_v")).groupingSets([["cohort"], []], "cohort").agg(
        F.sum("d_a").alias("observed"), F.sum("_e").alias("expected"), F.sum("_v").alias("variance"), F.grouping("cohort").alias("_all"))
    chi2 = F.when(F.col("variance") > 1e-12, td(F.pow(F.col("observed") - F.col("expected"), F.lit(2)), F.col("variance")))
    return out.select(F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("cohort")).alias("cohort"), "observed", "expected", "variance", chi2.alias("chi2"))


# ---------------------------------------------------------------- worker flows (D11)

def reconcile_flows(flows: DataFrame, grouping_cols: list[str]) -> DataFrame:
    """Official flows (ref_date, groups, employment, hires, separations) made to agree with the change of employment.

    Half of what change and net flow differ by goes to each side; neither gets below zero, and their difference is the change. The first
    month of a group has no change and keeps its flows. Adds ``employment_change``, ``discrepancy``, ``hires_reconciled``, ``separations_reconciled``.
    """
    w = Window.partitionBy(*grouping_cols).orderBy("ref_date")
    change = F.col("employment") - F.lag("employment").over(w)
    out = flows.withColumn("employment_change", change).withColumn("discrepancy", F.col("employment_change") - (F.col("hires") - F.col("separations")))
    hires = F.greatest(F.col("hires") + F.col("discrepancy") / 2, F.col("employment_change"), F.lit(0.0))
    out = out.withColumn("hires_reconciled", F.when(F.col("discrepancy").isNull(), F.col("hires")).otherwise(hires))
    return out.withColumn("separations_reconciled", F.when(F.col("discrepancy").isNull(), F.col("separations")).otherwise(
        F.col("hires_reconciled") - F.col("employment_change")))


def compare_flows_to_worker_survey(flows: DataFrame, official: DataFrame, grouping_cols: list[str]) -> DataFrame:
    """Payroll flow rates against reconciled official ones by month and group: gaps, and the correlation over time in each group."""
    o = reconcile_flows(official, grouping_cols).select(
        "ref_date", *grouping_cols, "discrepancy", td("hires_reconciled", "employment").alias("official_hire_rate"),
        td("separations_reconciled", "employment").alias("official_separation_rate"))
    m = flows.select("ref_date", *grouping_cols, "hire_rate", "separation_rate").join(o, ["ref_date", *grouping_cols])
    w = Window.partitionBy(*grouping_cols)
    return m.withColumns({"hire_gap": F.col("hire_rate") - F.col("official_hire_rate"), "separation_gap": F.col("separation_rate") - F.col("official_separation_rate"),
                          "hire_corr": safe_corr("hire_rate", "official_hire_rate", w), "separation_corr": safe_corr("separation_rate", "official_separation_rate", w)})


# ---------------------------------------------------------------- trends (D10)

def theil_sen(df: DataFrame, groups: list[str], at: Column, values: dict[str, str]) -> DataFrame:
    """(groups, names): for each value the median of the slopes between all pairs of its points, which single outliers do not move.

    ``at`` is the place in time; pairs are made within a group's series of periods, bounded by the calendar. Fewer than two points give null.
    """
    def slopes(v: str) -> Column:
        s = F.sort_array(F.collect_list(F.when(F.col(v).isNotNull(), F.struct(at.cast("double").alias("x"), F.col(v).cast("double").alias("y")))))
        pairs = F.flatten(F.transform(s, lambda p: F.transform(F.filter(s, lambda q: q["x"] > p["x"]), lambda q: (q["y"] - p["y"]) / (q["x"] - p["x"]))))
        m = F.sort_array(pairs)
        n = F.size(m)
        return F.when(n > 0, (F.get(m, ((n - 1) / 2).cast("int")) + F.get(m, (n / 2).cast("int"))) / 2)

    return df.groupBy(*groups).agg(*[slopes(v).alias(name) for v, name in values.items()])


# ---------------------------------------------------------------- freshness (D4)

def filing_freshness(payroll: DataFrame, as_of_days: tuple[int, ...] = (-30, -15, 0, 15, 30, 45)) -> DataFrame:
    """The reporting triangle: for each month and each number of days after it, the employment and rows filed by then and their share of the final ones.

    Rows without a filing date are in the final figures only.
    """
    lag, e = F.datediff("filing_date", "ref_date"), F.col("qualified_employment")
    filed = [F.struct(F.lit(k).alias("as_of_days"), F.coalesce(F.sum(F.when(lag <= k, e)), F.lit(0)).cast("long").alias("filed_employment"),
                      F.count_if(lag <= k).alias("filed_rows")) for k in as_of_days]
    t = payroll.groupBy("ref_date").agg(F.array(*filed).alias("_f"), F.coalesce(F.sum(e), F.lit(0)).cast("long").alias("final_employment"), F.count(F.lit(1)).alias("final_rows"))
    out = t.select("ref_date", "final_employment", "final_rows", F.explode("_f").alias("f")).select("ref_date", "f.*", "final_employment", "final_rows")
    return out.withColumns({"employment_share": td("filed_employment", "final_employment"), "row_share": td("filed_rows", "final_rows")})


# ---------------------------------------------------------------- code lists (D3)

def expand_codes(codes: DataFrame, code: str = "code") -> DataFrame:
    """(prefix, listed): every code of a list; a range such as ``31-33`` gives each of its codes."""
    c = F.trim(F.col(code))
    low, high = F.regexp_extract(c, r"^(\d+)-(\d+)$", 1), F.regexp_extract(c, r"^(\d+)-(\d+)$", 2)
    many = F.transform(F.sequence(F.when(low != "", low).cast("int"), F.when(high != "", high).cast("int")), lambda i: F.lpad(i.cast("string"), F.length(low), F.lit("0")))
    return codes.where(c != "").select(F.explode(F.when(low != "", many).otherwise(F.array(c))).alias("prefix"), c.alias("listed")).groupBy("prefix").agg(F.min("listed").alias("listed"))


def naics_against_list(payroll: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """(naics_code, n_rows, listed, n_digits, status): each industry code with the longest listed code that begins it.

    Distinct codes are matched by a join over their prefixes. ``status`` is ``valid``, ``short`` (a code that begins so only without the zeros that
    padded it: it was given with fewer than six digits) or ``unknown``, as a null code is.
    """
    found = payroll.groupBy("naics_code").agg(F.count(F.lit(1)).alias("n_rows"))
    bare = F.regexp_replace("naics_code", "^0+", "")
    starts = found.select("naics_code", F.explode(F.array(F.struct(F.lit(False).alias("short"), F.col("naics_code").alias("c")), F.struct(F.lit(True).alias("short"), bare.alias("c")))).alias("x"))
    starts = starts.where((F.length("x.c") > 0) & (~F.col("x.short") | (F.col("x.c") != F.col("naics_code")))).select("naics_code", "x.*")
    prefixes = starts.select("naics_code", "short", F.explode(F.transform(F.sequence(F.lit(1), F.length("c")), lambda i: F.substring(F.col("c"), F.lit(1), i))).alias("prefix"))
    hits = prefixes.join(expand_codes(codes, code), "prefix").groupBy("naics_code").agg(
        F.max(F.struct((~F.col("short")).alias("whole"), F.length("prefix").alias("n_digits"), "listed")).alias("best"))
    out = found.join(hits.withColumnRenamed("naics_code", "_code"), F.col("naics_code") == F.col("_code"), "left")
    status = F.when(F.col("best").isNull(), "unknown").when(F.col("best.whole"), "valid").otherwise("short")
    return out.select("naics_code", "n_rows", "best.listed", "best.n_digits", status.alias("status"))
