"""Comparisons with official survival and flows, freshness, code lists, raking rounds: hand-computed cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscope.operators import compare as K
from panelscope.operators import reweight as R


def spells(spark, rows):
    return spark.createDataFrame(rows, "cohort string, duration long, died boolean")


def test_log_rank_and_curves_by_hand(spark):
    a = spells(spark, [("2019Q1", 1, True), ("2019Q1", 2, True), ("2019Q1", 3, False)])
    b = spells(spark, [("2019Q1", 2, True), ("2019Q1", 3, True), ("2019Q1", 3, False)])
    got = {r.cohort: r for r in K.log_rank(a, b).collect()}
    # deaths at 1: 1 of 3 + 3; at 2: 1 and 1 of 2 + 3; at 3: one of the second side of 1 + 2
    e = 3 / 6 + 2 * 2 / 5 + 1 / 3
    v = 1 * (3 / 6) * (3 / 6) * 5 / 5 + 2 * (2 / 5) * (3 / 5) * 3 / 4 + 1 * (1 / 3) * (2 / 3) * 2 / 2
    for r in (got["2019Q1"], got["all"]):
        assert (r.observed, r.expected, r.variance, r.chi2) == (2, pytest.approx(e), pytest.approx(v), pytest.approx((2 - e) ** 2 / v))
    curve = {r.age_quarters: (r.payroll_at_risk, r.official_at_risk, r.payroll_survival, r.official_survival) for r in K.survival_gap(a, b).collect()}
    assert curve == {1: (3, 3, pytest.approx(2 / 3), 1.0), 2: (2, 3, pytest.approx(1 / 3), pytest.approx(2 / 3)), 3: (1, 2, pytest.approx(1 / 3), pytest.approx(1 / 3))}
    gone = K.survival_gap(spells(spark, [("x", 1, True), ("x", 1, True)]), b).collect()
    assert [r.payroll_survival for r in sorted(gone, key=lambda r: r.age_quarters)] == [0.0, 0.0, 0.0]
    assert K.log_rank(a.limit(0), b.limit(0)).where("cohort <> 'all'").isEmpty()


def test_quarter_names(spark):
    rows = spark.createDataFrame([("2019-12-31",), ("2020-01-01",), ("2020-10-12",)], "d string").select(K.quarter_name(K.quarter_number(F.col("d").cast("date"))).alias("q"))
    assert [r.q for r in rows.collect()] == ["2019Q4", "2020Q1", "2020Q4"]


def test_reconciled_flows_add_up_to_the_change(spark, dates):
    rows = [(dates(2020, 1), "A", 100.0, 10.0, 5.0), (dates(2020, 2), "A", 110.0, 4.0, 6.0), (dates(2020, 3), "A", 60.0, 1.0, 2.0), (dates(2020, 4), "A", 90.0, 0.0, 9.0)]
    got = K.reconcile_flows(spark.createDataFrame(rows, "ref_date date, g string, employment double, hires double, separations double"), ["g"]).orderBy("ref_date").collect()
    assert (got[0].hires_reconciled, got[0].separations_reconciled, got[0].discrepancy) == (10.0, 5.0, None)
    assert (got[1].discrepancy, got[1].hires_reconciled, got[1].separations_reconciled) == (12.0, 10.0, 0.0)
    for r in got[1:]:
        assert r.hires_reconciled >= 0 and r.separations_reconciled >= 0 and r.hires_reconciled - r.separations_reconciled == r.employment_change


def test_theil_sen_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(g, t, float(v)) for g in "ab" for t, v in enumerate(rng.normal(0, 1, 9 + (g == "a")) + np.arange(9 + (g == "a")))] + [("c", 1, 2.0), ("d", 1, None)]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    got = {r.g: r.trend for r in K.theil_sen(df, ["g"], F.col("t"), {"v": "trend"}).collect()}
    for g in "ab":
        p = [(t, v) for h, t, v in rows if h == g]
        assert got[g] == pytest.approx(np.median([(v2 - v1) / (t2 - t1) for t1, v1 in p for t2, v2 in p if t2 > t1]))
    assert got["c"] is None and got["d"] is None


def test_freshness_triangle(spark, dates):
    rows = [(dates(2020, 1), dates(2020, 1, 20), 10), (dates(2020, 1), dates(2020, 3), 30), (dates(2020, 1), None, 60)]
    got = K.filing_freshness(spark.createDataFrame(rows, "ref_date date, filing_date date, qualified_employment long"), (0, 15, 90)).collect()
    assert [(r.as_of_days, r.filed_employment, r.filed_rows, r.employment_share, r.row_share) for r in sorted(got, key=lambda r: r.as_of_days)] == [
        (0, 0, 0, 0.0, 0.0), (15, 10, 1, 0.1, pytest.approx(1 / 3)), (90, 40, 2, 0.4, pytest.approx(2 / 3))]


def test_codes_against_a_list(spark):
    pay = spark.createDataFrame([("336111",), ("336111",), ("000236",), ("990000",), (None,), ("621111",), ("000000",)], "naics_code string")
    codes = spark.createDataFrame([("31-33",), ("3361",), ("23",), ("62",), ("621111",), (" ",)], "code string")
    got = {r.naics_code: (r.n_rows, r.listed, r.n_digits, r.status) for r in K.naics_against_list(pay, codes).collect()}
    assert got == {"336111": (2, "3361", 4, "valid"), "000236": (1, "23", 2, "short"), "990000": (1, None, None, "unknown"), None: (1, None, None, "unknown"),
                   "621111": (1, "621111", 6, "valid"), "000000": (1, None, None, "unknown")}


def test_margins_dealt_anew_give_the_same_weights(spark, dates, monkeypatch):
    rng = np.random.default_rng(1)
    pay = spark.createDataFrame([(k, dates(2020, 1 + k % 3), "2020Q1", "ABC"[k // 3 % 3], "XY"[k // 9 % 2], int(rng.integers(1, 50))) for k in range(72)],
                                "client_id int, ref_date date, quarter string, supersector string, state_fips string, qualified_employment int")
    off = spark.createDataFrame([(dates(2020, m), "2020Q1", a, b, int(rng.integers(50, 500))) for m in (1, 2, 3) for a in "ABC" for b in "XY"],
                                "ref_date date, quarter string, supersector string, state_fips string, qcew_employment int")
    dims = ["supersector", "state_fips"]
    one = {tuple(r[:4]): r.rake_weight for r in R.rake_cells(pay, off, dims)[0].collect()}
    assert one == pytest.approx({tuple(r[:4]): r.rake_weight for r in R.rake_cells(pay, {d: off for d in dims}, dims)[0].collect()})
    monkeypatch.setattr(R, "TASK_CELLS", 0)
    monkeypatch.setattr(R, "STEPS", 6)
    again = R.rake_cells(pay, off, dims)[0].collect()
    assert {tuple(r[:4]): r.rake_weight for r in again} == pytest.approx(one) and all(r.converged and r.last_change < 1e-6 for r in again)
