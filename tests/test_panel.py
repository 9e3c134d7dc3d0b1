from pyspark.sql import functions as F

from panelscope.operators.panel import build_panel, filter_stable_panel, panel_level
from panelscope.sources.payroll import normalise_payroll

COLS = "client_id string, ref_date date, entry_month date, exit_month date, is_birth boolean, naics_code string, " \
       "state_fips string, qualified_employment bigint"


def _pay(spark, rows):
    return normalise_payroll(spark.createDataFrame(rows, COLS))


def test_panel_national_totals_and_levels(spark, dates):
    D = dates
    rows = [("c1", D(2019, 1), D(2019, 1, 1), None, True, "236220", "26", 10),
            ("c1", D(2019, 2), D(2019, 1, 1), None, True, "236220", "26", 12),
            ("c2", D(2019, 1), D(2019, 1, 1), None, None, "445110", "36", 5),
            ("c2", D(2019, 2), D(2019, 1, 1), None, None, "445110", "36", 6)]
    panel = build_panel(_pay(spark, rows))
    nat = {r.ref_date: r for r in panel_level(panel, "national").collect()}
    assert nat[D(2019, 1)].payroll_employment == 15 and nat[D(2019, 2)].payroll_employment == 18
    assert nat[D(2019, 1)].client_count == 2 and nat[D(2019, 1)].birth_count == 1
    assert nat[D(2019, 1)].birth_determinable_count == 1
    levels = {r.grouping_level for r in panel.select("grouping_level").distinct().collect()}
    assert levels == {"national", "supersector", "state", "size_class", "supersector_state", "supersector_size_class"}
    ss = panel_level(panel, "supersector").filter(F.col("ref_date") == D(2019, 1)).collect()
    assert sorted((r.supersector, r.payroll_employment) for r in ss) == [("Construction", 10), ("Retail trade", 5)]


def test_continuing_employment_after_exit(spark, dates):
    D = dates
    rows = [("c1", D(2019, 1), D(2018, 12), None, False, "236220", "26", 10),
            ("c1", D(2019, 2), D(2018, 12), None, False, "236220", "26", 12),
            ("c2", D(2019, 1), D(2018, 12), D(2019, 2), False, "445110", "36", 5),
            ("c2", D(2019, 2), D(2018, 12), D(2019, 2), False, "445110", "36", 6)]
    nat = {r.ref_date: r for r in panel_level(build_panel(_pay(spark, rows)), "national").collect()}
    assert nat[D(2019, 2)].continuing_employment == 12 and nat[D(2019, 2)].exit_count == 1


def test_continuing_zero_when_all_enter(spark, dates):
    D = dates
    rows = [("c1", D(2019, 1), D(2019, 1), None, False, "236220", "26", 10),
            ("c2", D(2019, 1), D(2019, 1), None, False, "236220", "26", 4),
            ("c1", D(2019, 2), D(2019, 1), None, False, "236220", "26", 12)]
    nat = {r.ref_date: r for r in panel_level(build_panel(_pay(spark, rows)), "national").collect()}
    assert nat[D(2019, 1)].continuing_employment == 0 and nat[D(2019, 1)].entry_count == 2
    assert nat[D(2019, 2)].continuing_employment == 12


def test_stable_panel(spark, dates):
    D = dates
    rows = [("a", D(2019, m), 1) for m in range(1, 13)] + [("a", D(2020, 1), 1), ("b", D(2019, 1), 2), ("b", D(2019, 6), 2)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, qualified_employment bigint")
    assert {r.client_id for r in filter_stable_panel(df, 12).collect()} == {"a"}
    assert filter_stable_panel(df, 0).count() == len(rows)


def test_entry_match_by_month(spark, dates):
    D = dates
    rows = [("c1", D(2019, 1), D(2019, 1, 1), None, False, "236220", "26", 10),
            ("c1", D(2019, 2), D(2019, 1, 1), D(2019, 2, 1), False, "236220", "26", 12)]
    pay = _pay(spark, rows)
    exact = {r.ref_date: r for r in panel_level(build_panel(pay), "national").collect()}
    month = {r.ref_date: r for r in panel_level(build_panel(pay, match="month"), "national").collect()}
    assert exact[D(2019, 1)].entry_count == 0 and month[D(2019, 1)].entry_count == 1
    assert month[D(2019, 2)].exit_count == 1 and month[D(2019, 2)].continuing_employment == 0
