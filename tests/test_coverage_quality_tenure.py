import pytest
from pyspark.sql import functions as F

from panelscope.operators.coverage import (compute_cell_reliability, compute_composition_shift_index,
                                           compute_coverage, compute_share_comparison)
from panelscope.operators.quality import flag_data_quality_issues
from panelscope.operators.tenure import (compute_client_entry_exit, compute_client_tenure, compute_vintage_shares,
                                         tenure_summary_by_group)


def test_cell_reliability_classes(spark):
    df = spark.createDataFrame([(10, 0.001), (50, 0.003), (100, 0.05), (100, None)],
                               "payroll_clients bigint, coverage_ratio_employment double")
    got = [r.reliability for r in compute_cell_reliability(df).collect()]
    assert got == ["insufficient", "marginal", "reliable", "insufficient"]


def test_coverage_missing_official_is_null_or_one(spark, dates):
    D = dates
    p = spark.createDataFrame([(D(2020, 1), "2020Q1", "A", 50, 5), (D(2020, 1), "2020Q1", "B", 20, 2)],
                              "ref_date date, quarter string, supersector string, payroll_employment bigint, client_count bigint")
    o = spark.createDataFrame([(D(2020, 1), "2020Q1", "A", 1000, 100)],
                              "ref_date date, quarter string, supersector string, qcew_employment bigint, qcew_establishments bigint")
    r = {x.supersector: x for x in compute_coverage(p, o, ["supersector"]).collect()}
    assert r["A"].coverage_ratio_employment == pytest.approx(0.05) and r["A"].coverage_ratio_estab == pytest.approx(0.05)
    assert r["B"].coverage_ratio_employment is None and r["A"].payroll_clients == 5
    r1 = {x.supersector: x for x in compute_coverage(p, o, ["supersector"], missing="one").collect()}
    assert r1["B"].coverage_ratio_employment == 20.0


def _share_inputs(spark, dates, same):
    D = dates
    p = spark.createDataFrame([(D(2020, 1), "2020Q1", "A", 50), (D(2020, 1), "2020Q1", "B", 30), (D(2020, 1), "2020Q1", "C", 20)],
                              "ref_date date, quarter string, supersector string, payroll_employment bigint")
    ov = [500, 300, 200] if same else [100, 100, 800]
    o = spark.createDataFrame([(D(2020, 1), "2020Q1", s, v) for s, v in zip("ABC", ov)],
                              "ref_date date, quarter string, supersector string, month1_emplvl bigint")
    return compute_share_comparison(p, o, "supersector").collect()


def test_share_comparison(spark, dates):
    rows = _share_inputs(spark, dates, True)
    assert sum(r.payroll_share for r in rows) == pytest.approx(1.0)
    assert sum(r.qcew_share for r in rows) == pytest.approx(1.0)
    assert all(r.misallocation_index == pytest.approx(0.0) for r in rows)
    rows = _share_inputs(spark, dates, False)
    assert rows[0].misallocation_index == pytest.approx((0.4 + 0.2 + 0.6) / 2)


def test_composition_shift_index(spark, dates):
    D = dates
    shifting = [(D(2020, m), s, v) for m, (a, b) in zip((1, 2, 3), ((50, 50), (60, 40), (70, 30))) for s, v in (("A", a), ("B", b))]
    df = spark.createDataFrame(shifting, "ref_date date, supersector string, payroll_employment bigint")
    csi = {r.ref_date: r.csi for r in compute_composition_shift_index(df, "supersector").collect()}
    assert csi[D(2020, 1)] == 0.0 and csi[D(2020, 2)] == pytest.approx(0.2) and 0 <= csi[D(2020, 3)] <= 2
    const = spark.createDataFrame([(D(2020, m), s, 10) for m in (1, 2, 3) for s in "AB"],
                                  "ref_date date, supersector string, payroll_employment bigint")
    assert all(r.csi == pytest.approx(0.0) for r in compute_composition_shift_index(const, "supersector").collect())


def test_quality_flags(spark, dates):
    D = dates
    df = spark.createDataFrame(
        [("c1", D(2020, 1), 100, D(2019, 12), "e1"), ("c1", D(2020, 2), 200, D(2019, 12), "e1"),
         ("c1", D(2020, 3), 210, D(2019, 12), "e2"), ("c2", D(2020, 1), 0, D(2020, 2), "e1"),
         ("c2", D(2020, 2), 140, D(2020, 2), "e3")],
        "client_id string, ref_date date, qualified_employment bigint, filing_date date, employee_id string")
    rows, summary = flag_data_quality_issues(df)
    r = {(x.client_id, x.ref_date): x for x in rows.collect()}
    assert r[("c1", D(2020, 2))].flag_extreme_change and not r[("c1", D(2020, 3))].flag_extreme_change
    assert not r[("c2", D(2020, 2))].flag_extreme_change  # previous is 0
    assert r[("c2", D(2020, 1))].flag_zero_employment
    assert r[("c1", D(2020, 1))].flag_multi_client and r[("c2", D(2020, 1))].flag_multi_client
    assert not r[("c1", D(2020, 2))].flag_multi_client
    assert r[("c2", D(2020, 1))].flag_filing_anomaly and not r[("c1", D(2020, 1))].flag_filing_anomaly
    s = {x.ref_date: x for x in summary.collect()}
    assert s[D(2020, 1)].total_records == 2 and s[D(2020, 1)].total_flagged == 2
    assert "prev_employment" not in rows.columns and "_prev" not in rows.columns


def test_tenure_entry_exit_and_vintage(spark, dates):
    D = dates
    rows = [("a", D(2019, 1), D(2019, 1), None, True, 10, "X"), ("a", D(2019, 2), D(2019, 1), None, True, 12, "X"),
            ("a", D(2019, 3), D(2019, 1), None, True, 14, "X"), ("b", D(2019, 2), D(2019, 2), D(2019, 3), None, 5, "Y"),
            ("b", D(2019, 3), D(2019, 2), D(2019, 3), None, 6, "Y"), ("c", D(2019, 3), D(2019, 3), None, False, 3, "Y")]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, entry_month date, exit_month date, "
                                     "is_birth boolean, qualified_employment bigint, supersector string")
    t = {r.client_id: r for r in compute_client_tenure(df).collect()}
    assert (t["a"].tenure_months, t["b"].tenure_months, t["c"].tenure_months) == (2, 1, 0)
    assert (t["a"].initial_emp, t["a"].final_emp, t["a"].months_observed) == (10, 14, 3)
    assert t["a"].is_likely_birth is True and t["b"].is_likely_birth is None
    ee = {r.ref_date: r for r in compute_client_entry_exit(df, []).collect()}
    assert (ee[D(2019, 3)].entries, ee[D(2019, 3)].exits, ee[D(2019, 3)].active_clients) == (1, 1, 3)
    assert ee[D(2019, 3)].churn_rate == pytest.approx(2 / 3)
    summ = {r.supersector: r for r in tenure_summary_by_group(df, "supersector").collect()}
    assert summ["Y"].client_count == 2 and summ["Y"].median_tenure == pytest.approx(0.5)


def test_vintage_contamination(spark, dates):
    D = dates
    rows = [("old", D(2018, 1), 10), ("old", D(2019, 1), 10), ("new", D(2019, 1), 100), ("new", D(2019, 1), 100)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, qualified_employment bigint")
    vs = {(r.ref_date, r.vintage_year): r for r in compute_vintage_shares(df).collect()}
    new = vs[(D(2019, 1), 2019)]
    assert new.employment_share == pytest.approx(200 / 210) and new.is_contaminated
    assert not vs[(D(2019, 1), 2018)].is_contaminated


def test_dense_csi_counts_cells_that_come_and_go(spark, dates):
    from panelscope.operators.coverage import compute_composition_shift_index
    rows = [(dates(2020, 1), "A", 50), (dates(2020, 1), "B", 50), (dates(2020, 2), "A", 100), (dates(2020, 3), "A", 50), (dates(2020, 3), "C", 50)]
    df = spark.createDataFrame(rows, "ref_date date, supersector string, payroll_employment bigint")
    csi = {r.ref_date.month: r.csi for r in compute_composition_shift_index(df, "supersector", dense=True).collect()}
    assert csi == {1: 0.0, 2: pytest.approx(1.0), 3: pytest.approx(1.0)}
    default = {r.ref_date.month: r.csi for r in compute_composition_shift_index(df, "supersector").collect()}
    assert default == {1: 0.0, 2: pytest.approx(0.5), 3: pytest.approx(0.5)}


def test_flags_with_one_client_holding_most_employee_rows(spark, dates):
    from panelscope.operators.quality import flag_data_quality_issues
    rows = [(f"e{i}", "big", dates(2020, m), 1) for m in (1, 2) for i in range(300 if m == 1 else 120)] + [("x", "small", dates(2020, m), 1) for m in (1, 2)]
    df = spark.createDataFrame(rows, "employee_id string, client_id string, ref_date date, qualified_employment bigint")
    flagged, _ = flag_data_quality_issues(df)
    got = {(r.client_id, r.ref_date.month): r.n for r in flagged.filter("flag_extreme_change").groupBy("client_id", "ref_date").agg(F.count("*").alias("n")).collect()}
    assert got == {("big", 2): 120} and flagged.count() == len(rows)


def test_first_birth_flag_has_no_arbitrary_tie(spark, dates):
    rows = [("a", dates(2020, 1), 5, True), ("a", dates(2020, 1), 7, False), ("a", dates(2020, 2), 7, None)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, qualified_employment bigint, is_birth boolean")
    assert {compute_client_tenure(df.repartition(n)).first().is_likely_birth for n in (1, 2, 3)} == {False}
