import random
import re

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from panelscope.functions import stats
from panelscope.functions.stats import grouped_quantiles
from panelscope.operators.assess import job_to_job, worker_tenure
from panelscope.operators.earnings import compute_earnings_distribution, compute_earnings_growth
from panelscope.operators.flows import compute_job_flows
from panelscope.operators.growth import (analyze_turning_points, compute_growth_rates, decompose_employment_change,
                                         decompose_growth_divergence)
from panelscope.operators.quality import flag_data_quality_issues


def test_growth_rates(spark, dates):
    D = dates
    rows = [(D(2019 + (m - 1) // 12, (m - 1) % 12 + 1), 100 + m) for m in range(1, 25)]
    df = spark.createDataFrame(rows, "ref_date date, qualified_employment bigint")
    g = sorted(compute_growth_rates(df, "qualified_employment", []).collect())
    assert g[0].mom_growth is None and g[1].mom_growth == pytest.approx(102 / 101 - 1)
    assert all(r.yoy_growth is None for r in g[:12]) and g[12].yoy_growth == pytest.approx(113 / 101 - 1)


def test_shift_share_adds_up(spark):
    p = spark.createDataFrame([(q, s, v) for q, vals in (("2020Q1", (50, 50)), ("2020Q2", (60, 45)), ("2020Q3", (66, 50)))
                               for s, v in zip("AB", vals)], "quarter string, supersector string, payroll_employment bigint")
    o = spark.createDataFrame([(q, s, v) for q, vals in (("2020Q1", (70, 30)), ("2020Q2", (77, 30)), ("2020Q3", (80, 33)))
                               for s, v in zip("AB", vals)], "quarter string, supersector string, employment bigint")
    for r in decompose_growth_divergence(p, o, ["supersector"]).collect():
        assert r.total_divergence == pytest.approx(r.composition_effect + r.within_cell_effect)
    simple = decompose_growth_divergence(p, o, []).orderBy("quarter").collect()
    assert simple[0].total_divergence is None and simple[1].composition_effect == 0.0
    assert simple[1].total_divergence == pytest.approx(105 / 100 - 107 / 100)


def test_employment_change(spark, dates):
    D = dates
    rows = [("c1", D(2020, 1), 10), ("c1", D(2020, 2), 15), ("c1", D(2020, 3), 25),
            ("c2", D(2020, 1), 5), ("c2", D(2020, 2), 5), ("c3", D(2020, 3), 30)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, qualified_employment bigint")
    r = {x.ref_date: x for x in decompose_employment_change(df).collect()}
    assert set(r) == {D(2020, 2), D(2020, 3)}
    assert (r[D(2020, 2)].within_change, r[D(2020, 2)].entry_contribution, r[D(2020, 2)].exit_contribution) == (5, 0, 0)
    m = r[D(2020, 3)]
    assert (m.within_change, m.entry_contribution, m.exit_contribution, m.total_change) == (10, 30, 5, 35)


def test_turning_points(spark, dates):
    D = dates
    months = [D(2019 + i // 12, i % 12 + 1) for i in range(24)]
    p = spark.createDataFrame([(d, 0.05 if i < 8 else -0.02) for i, d in enumerate(months)], "ref_date date, yoy_growth double")
    o = spark.createDataFrame([(d, 0.03 if i < 10 else -0.01) for i, d in enumerate(months)], "ref_date date, yoy_growth double")
    r = analyze_turning_points(p, o).collect()
    assert len(r) == 1 and r[0].payroll_turn_date == months[8] and r[0].official_turn_date == months[10]
    assert r[0].lead_lag_months == pytest.approx(round(-(months[10] - months[8]).days / 30.0, 1))
    flat = spark.createDataFrame([(d, 0.01) for d in months], "ref_date date, yoy_growth double")
    assert analyze_turning_points(flat, o).count() == 0


def test_flows_entry_exit_columns_and_employees(spark, dates):
    D = dates
    rows = [("c1", D(2020, 1), D(2020, 1), None, 10), ("c2", D(2020, 1), D(2019, 6), None, 5),
            ("c2", D(2020, 2), D(2019, 6), D(2020, 2), 6), ("c3", D(2020, 2), D(2020, 2), None, 8),
            ("c1", D(2020, 2), D(2020, 1), None, 11)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, entry_month date, exit_month date, "
                                     "qualified_employment bigint")
    f = {r.ref_date: r for r in compute_job_flows(df, []).collect()}
    assert (f[D(2020, 1)].hires, f[D(2020, 1)].separations) == (10, 0)
    assert (f[D(2020, 2)].hires, f[D(2020, 2)].separations, f[D(2020, 2)].continuing_employment) == (8, 6, 17)
    cols = spark.createDataFrame([(D(2020, 1), "a", 100, 20, 5), (D(2020, 2), "a", 100, 5, 10)],
                                 "ref_date date, client_id string, qualified_employment bigint, hires bigint, separations bigint")
    c = {r.ref_date: r for r in compute_job_flows(cols, []).collect()}
    assert c[D(2020, 1)].continuing_employment == 80 and c[D(2020, 2)].continuing_employment == 95
    emp = spark.createDataFrame([(D(2020, 1), "c1", "e1", 1), (D(2020, 1), "c1", "e2", 1), (D(2020, 2), "c1", "e1", 1),
                                 (D(2020, 2), "c2", "e3", 1), (D(2020, 3), "c2", "e3", 1)],
                                "ref_date date, client_id string, employee_id string, qualified_employment bigint")
    e = {r.ref_date: r for r in compute_job_flows(emp, []).collect()}
    assert (e[D(2020, 1)].hires, e[D(2020, 1)].separations, e[D(2020, 1)].employment) == (2, 0, 2)
    assert (e[D(2020, 2)].hires, e[D(2020, 2)].separations, e[D(2020, 2)].continuing_employment) == (1, 1, 1)
    assert (e[D(2020, 3)].hires, e[D(2020, 3)].separations) == (0, 1)


def test_nearest_quantiles_and_earnings(spark, dates):
    D = dates
    df = spark.createDataFrame([("a", D(2020, 1), 1, 1000.0), ("b", D(2020, 1), 1, 2000.0), ("c", D(2020, 1), 1, 3000.0),
                                ("d", D(2020, 1), 1, 0.0), ("e", D(2020, 1), 1, None)],
                               "client_id string, ref_date date, qualified_employment bigint, gross_pay double")
    r = compute_earnings_distribution(df, []).collect()[0]
    assert r.p10_earnings <= 1000 and r.median_earnings == 2000 and r.mean_earnings == 2000
    assert r.p90_earnings == 3000 and r.std_earnings == pytest.approx(1000.0)
    assert r.cv_earnings == pytest.approx(0.5)
    empty = compute_earnings_distribution(df.drop("gross_pay"), [])
    assert empty.count() == 0 and "p90_earnings" in empty.columns


def test_earnings_growth_first_year_null(spark, dates):
    D = dates
    rows = [("a", D(2019 + i // 12, i % 12 + 1), 1, 1000.0 + 10 * i) for i in range(24)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, qualified_employment bigint, gross_pay double")
    g = sorted(compute_earnings_growth(df, []).collect())
    assert all(r.mean_earnings_yoy is None for r in g[:12])
    assert g[12].mean_earnings_yoy == pytest.approx(1120.0 / 1000.0 - 1)


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_by_selection_with_hot_group_and_hot_value(spark, monkeypatch, accuracy):
    monkeypatch.setattr(stats, "ACCURACY", accuracy)  # 50: brackets narrower than the groups
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)]
    rows += [("one", 7.0 if rnd.random() < 0.9 else rnd.random()) for _ in range(2000)]
    rows += [(f"g{i % 7}", float(rnd.randint(0, 50))) for i in range(1000)] + [(None, 1.0), (None, 3.0), ("g1", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"p01": 0.01, "p10": 0.1, "p90": 0.9}
    got = {r.g: r for r in grouped_quantiles(df, ["g"], "v", wanted, median="med", extra_aggs=[F.count("v").alias("n")]).collect()}
    assert set(got) == {g for g, v in rows if v is not None}
    for g, r in got.items():
        vals = sorted(v for gg, v in rows if gg == g and v is not None)
        assert r.n == len(vals) and r.med == pytest.approx(float(np.median(vals)))
        for name, q in wanted.items():
            assert r[name] == vals[int(np.floor((len(vals) - 1) * q + 0.5))]
    everything = sorted(v for _, v in rows if v is not None)
    r = grouped_quantiles(df, [], "v", wanted).first()
    assert r.p10 == everything[int(np.floor((len(everything) - 1) * 0.1 + 0.5))]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_grouped_flows_keep_separations(spark, dates):
    D = dates
    rows = [("e1", D(2020, 1), "01"), ("e2", D(2020, 1), "02"), ("e2", D(2020, 2), "02"), ("e3", D(2020, 1), None), ("e4", D(2020, 2), None)]
    df = spark.createDataFrame(rows, "employee_id string, ref_date date, state_fips string")
    by = {(r.ref_date, r.state_fips): r for r in compute_job_flows(df, ["state_fips"], "employees").collect()}
    assert by[D(2020, 2), "01"].separations == 1 and by[D(2020, 2), "01"].employment == 0 and by[D(2020, 2), "01"].separation_rate is None
    assert (by[D(2020, 2), None].separations, by[D(2020, 2), None].hires) == (1, 1)
    total = {r.ref_date: r for r in compute_job_flows(df, [], "employees").collect()}
    assert total[D(2020, 2)].separations == 2 == sum(r.separations for (d, _), r in by.items() if d == D(2020, 2))


def test_earnings_without_pay_keep_grouping_columns(spark, dates):
    df = spark.createDataFrame([("a", dates(2020, 1), "A", 1)], "client_id string, ref_date date, supersector string, qualified_employment bigint")
    g = compute_earnings_growth(df, ["supersector"])
    assert g.columns[:2] == ["ref_date", "supersector"] and g.count() == 0


def test_calendar_growth_skips_gaps(spark, dates):
    D = dates
    rows = [(D(2019, 1), 100), (D(2019, 3), 110), (D(2020, 1), 120), (D(2020, 3), 121)]
    df = spark.createDataFrame(rows, "ref_date date, qualified_employment bigint")
    pos = {r.ref_date: r for r in compute_growth_rates(df, "qualified_employment", []).collect()}
    cal = {r.ref_date: r for r in compute_growth_rates(df, "qualified_employment", [], calendar=True).collect()}
    assert pos[D(2019, 3)].mom_growth == pytest.approx(0.1) and cal[D(2019, 3)].mom_growth is None
    assert cal[D(2020, 1)].yoy_growth == pytest.approx(0.2) and cal[D(2020, 3)].yoy_growth == pytest.approx(0.1)
    assert pos[D(2020, 1)].yoy_growth is None


def _employee_rows(dates):
    rng = random.Random(5)
    # nulls, rows that come twice, months without anyone at a client, employees of several clients
    rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, *"uvwxyz"]), dates(2020, rng.choice([1, 2, 4, 5, 6])), rng.choice([0, 1, 1, 3])) for _ in range(300)]
    return rows + rows[:50]


EMPLOYEE_SCHEMA = "employee_id string, client_id string, ref_date date, qualified_employment bigint"


def test_employee_flows_moves_and_tenure_equal_brute_force(spark, dates):
    rows = _employee_rows(dates)
    df = spark.createDataFrame(rows, EMPLOYEE_SCHEMA)
    days = sorted({r[2] for r in rows})
    at = {(r[0], r[1], days.index(r[2])) for r in rows}
    flows = {(r.ref_date, r.client_id): (r.employment, r.hires, r.continuing_employment, r.separations) for r in compute_job_flows(df, ["client_id"]).collect()}
    moves = {r.ref_date: (r.workers, r.job_to_job_moves) for r in job_to_job(df).collect()}
    tenure = {(r.employee_id, r.client_id, r.ref_date): r.tenure_months for r in worker_tenure(df).collect()}
    want_flows, want_moves, want_tenure = {}, {}, {}
    for i, day in enumerate(days):
        for c in {x[1] for x in at}:
            now, was = ({e for e, k, j in at if k == c and j == n} for n in (i, i - 1))
            if now or was:
                want_flows[day, c] = (len(now), len(now - was), len(now & was), len(was - now))
        now, was = ({x[:2] for x in at if x[2] == n} for n in (i, i - 1))
        want_moves[day] = (len({e for e, _ in now}), len({e for e, _ in now - was} & {e for e, _ in was - now}))
        for e, c in now:
            want_tenure[e, c, day] = 1 + want_tenure.get((e, c, days[i - 1]), 0) if i and (e, c) in was else 1
    assert flows == want_flows and moves == want_moves and tenure == want_tenure


def test_quality_flags_of_employee_rows_equal_brute_force(spark, dates):
    rows = _employee_rows(dates)
    got = sorted(map(str, flag_data_quality_issues(spark.createDataFrame(rows, EMPLOYEE_SCHEMA))[0].select(
        "employee_id", "client_id", "ref_date", "flag_extreme_change", "flag_multi_client").collect()))
    emp = {}
    for _, c, d, n in rows:
        emp[c, d] = emp.get((c, d), 0) + n
    want = []
    for e, c, d, _ in rows:
        before = [x for k, x in emp if k == c and x < d]
        prev = emp[c, max(before)] if before else 0
        several = len({x[1] for x in rows if x[0] == e and x[2] == d and x[1] is not None}) > 1
        want.append(str(Row(employee_id=e, client_id=c, ref_date=d, flag_extreme_change=prev > 0 and abs(emp[c, d] - prev) / prev > 0.5,
                            flag_multi_client=e is not None and several)))
    assert got == sorted(want)


@pytest.mark.parametrize("job, dealt", [(lambda df: compute_job_flows(df, ["client_id"]), 1), (job_to_job, 2), (worker_tenure, 1),
                                        (lambda df: flag_data_quality_issues(df)[1], 2)])
def test_employee_steps_run_in_parts_that_are_not_coalesced(spark, dates, job, dealt):
    """Employees come grouped by their keys: without an exchange of its own, a task held three or four hash maps of all its rows."""
    rows = spark.range(4000).selectExpr("id % 900 AS employee_id", "id % 7 AS client_id", "date'2020-01-12' AS ref_date", "1L AS qualified_employment")
    df = job(rows.groupBy("employee_id", "client_id", "ref_date").agg(F.sum("qualified_employment").alias("qualified_employment")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == dealt
    assert all(int(n) >= stats.PARTS for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", plan))
