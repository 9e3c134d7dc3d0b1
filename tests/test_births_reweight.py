import numpy as np
import duckdb
import pytest
from pyspark.sql import functions as F

from panelscope.functions.stats import t_pvalue
from panelscope.operators.births import (birth_lead_models, compare_birth_determinable_composition,
                                         compute_cross_correlation, compute_kaplan_meier, compute_payroll_birth_rates,
                                         compute_survival_curves, test_birth_lead)
from panelscope.operators.reweight import rake_cells, rake_convergence, rake_to_qcew


def _series(spark, n=20):
    qs = [f"{2015 + i // 4}Q{i % 4 + 1}" for i in range(n)]
    x = [0.02 + 0.001 * i + 0.002 * np.sin(i) for i in range(n)]
    y = [0.8 * a + 0.003 * np.cos(3 * i) for i, a in enumerate(x)]
    p = spark.createDataFrame([(q, float(a)) for q, a in zip(qs, x)], "quarter string, birth_rate double")
    o = spark.createDataFrame([(q, float(b)) for q, b in zip(qs, y)], "quarter string, bed_birth_rate double")
    return p, o, np.array(x), np.array(y)


def _ols(y, cols):
    X = np.column_stack([np.ones(len(y))] + cols)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    r2 = 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean()))
    dof = len(y) - X.shape[1]
    se = np.sqrt(np.diag(resid @ resid / dof * np.linalg.inv(X.T @ X)))
    return beta, r2, beta / se, dof


def test_birth_rates(spark, dates):
    D = dates
    panel = spark.createDataFrame([(D(2020, 1), "2020Q1", 1, 10), (D(2020, 1), "2020Q1", 2, 10)],
                                  "ref_date date, quarter string, birth_count bigint, birth_determinable_count bigint")
    r = compute_payroll_birth_rates(panel, []).collect()[0]
    assert (r.births, r.determinable) == (3, 20) and r.birth_rate == pytest.approx(0.15)


def test_lead_models_match_least_squares(spark):
    p, o, x, y = _series(spark)
    got = {r.model: r for r in birth_lead_models(p, o).collect()}
    b, r2, t, dof = _ols(y, [x])
    assert got["concurrent"].coef == pytest.approx(b[1]) and got["concurrent"].r2 == pytest.approx(r2)
    assert got["concurrent"].t == pytest.approx(t[1]) and got["concurrent"].dof == dof
    b, r2, t, dof = _ols(y[1:], [x[1:], x[:-1]])
    assert got["leading"].coef == pytest.approx(b[2]) and got["leading"].r2 == pytest.approx(r2)
    assert got["leading"].t == pytest.approx(t[2]) and got["leading"].dof == dof
    b, r2, t, dof = _ols(y[1:], [y[:-1], x[:-1]])
    assert got["incremental"].coef == pytest.approx(b[2]) and got["incremental"].t == pytest.approx(t[2])
    pv = {r.model: r.pvalue for r in test_birth_lead(p, o).collect()}
    assert all(0 <= v <= 1 for v in pv.values())


def test_pvalue_function_known_values(spark):
    # two-sided Student-t tail probabilities (standard tables), and closed forms for 1, 2 and 4 degrees of freedom
    cases = [(2.228, 10, 0.05), (2.0, 1000, 0.0458), (0.0, 5, 1.0), (63.657, 1, 0.01), (-2.228, 10, 0.05), (12.924, 3, 0.001)]
    df = spark.createDataFrame([(i, float(t), float(n)) for i, (t, n, _) in enumerate(cases)], "i int, t double, dof double")
    got = {r.i: r.p for r in df.select("i", t_pvalue(F.col("t"), F.col("dof")).alias("p")).collect()}
    for i, (_, _, p) in enumerate(cases):
        assert got[i] == pytest.approx(p, abs=2e-4)
    grid = [(t, n) for t in (0.01, 0.4, 1.0, 1.3, 2.5, 9.0, 80.0) for n in (1, 2, 4)]
    df = spark.createDataFrame([(float(t), float(n)) for t, n in grid] + [(None, 3.0), (1.0, 0.0)], "t double, dof double")
    for r in df.select("t", "dof", t_pvalue(F.col("t"), F.col("dof")).alias("p")).collect():
        if r.t is None or r.dof < 1:
            assert r.p is None
            continue
        s = r.t / np.sqrt(r.dof + r.t**2)
        exact = {1: 1 - 2 * np.arctan(r.t) / np.pi, 2: 1 - s, 4: 1 - s * (1 + 0.5 * (1 - s * s))}[int(r.dof)]
        assert r.p == pytest.approx(exact, rel=1e-9, abs=1e-15)


def test_pvalues_match_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    p, o, x, y = _series(spark)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    lr = LinearRegression(featuresCol="f", labelCol="y", solver="normal", regParam=0.0)
    m = lr.fit(VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
    ours = {r.model: r.pvalue for r in test_birth_lead(p, o).collect()}
    assert ours["concurrent"] == pytest.approx(m.summary.pValues[0], rel=1e-6, abs=1e-12)


def test_collinear_lead_is_guarded(spark):
    qs = [f"{2015 + i // 4}Q{i % 4 + 1}" for i in range(20)]
    p = spark.createDataFrame([(q, 0.02 + 0.001 * i) for i, q in enumerate(qs)], "quarter string, birth_rate double")
    o = spark.createDataFrame([(q, 0.015 + 0.0012 * i + 0.0005 * (i % 3)) for i, q in enumerate(qs)],
                              "quarter string, bed_birth_rate double")
    got = {r.model: r for r in birth_lead_models(p, o).collect()}
    assert 0 <= got["leading"].r2 <= 1 and got["leading"].coef is None


def test_lead_and_xcorr_need_enough_quarters(spark):
    p, o, _, _ = _series(spark, 3)
    assert birth_lead_models(p, o).count() == 0
    assert compute_cross_correlation(p, o).count() == 0
    p, o, x, y = _series(spark, 20)
    c = {r.lag: r.correlation for r in compute_cross_correlation(p, o, 4).collect()}
    assert sorted(c) == [0, 1, 2, 3, 4] and c[0] > 0.8
    assert c[2] == pytest.approx(np.corrcoef(x[:-2], y[2:])[0, 1])


def test_survival(spark, dates):
    D = dates
    rows = []
    for cid, months in (("a", 40), ("b", 14), ("c", 3)):
        rows += [(cid, D(2018 + m // 12, m % 12 + 1), D(2018, 1), True) for m in range(months)]
    rows += [("d", D(2018, 2), D(2018, 2), False), ("e", D(2018, 3), D(2018, 3), None)]
    df = spark.createDataFrame(rows, "client_id string, ref_date date, entry_month date, is_birth boolean")
    r = compute_survival_curves(df).collect()
    assert len(r) == 1 and r[0].entry_quarter == "2018Q1" and r[0].birth_cohort_n == 3
    assert r[0].survival_4q == pytest.approx(2 / 3) and r[0].survival_12q == pytest.approx(1 / 3)
    assert r[0].survival_20q == 0.0
    none = df.filter(F.col("is_birth") == False)  # noqa: E712
    assert compute_survival_curves(none).count() == 0


def test_birth_composition(spark):
    a = spark.createDataFrame([("A", "01", "1-4"), ("B", "02", "5-9")], "supersector string, state_fips string, size_class string")
    same = {r.dimension: r.misallocation_index for r in compare_birth_determinable_composition(a, a).collect()}
    assert all(v == pytest.approx(0.0) for v in same.values()) and len(same) == 3
    b = spark.createDataFrame([("C", "03", "10-19")], "supersector string, state_fips string, size_class string")
    diff = {r.dimension: r.misallocation_index for r in compare_birth_determinable_composition(a, b).collect()}
    assert all(v == pytest.approx(1.0) for v in diff.values())


def _rake_inputs(spark, dates):
    D = dates
    pay = spark.createDataFrame([("c1", D(2020, 1), "2020Q1", "A", "01", 100), ("c2", D(2020, 1), "2020Q1", "A", "02", 100),
                                 ("c3", D(2020, 1), "2020Q1", "B", "01", 200), ("c4", D(2020, 1), "2020Q1", "B", "02", 100)],
                                "client_id string, ref_date date, quarter string, supersector string, state_fips string, "
                                "qualified_employment bigint")
    off = spark.createDataFrame([(D(2020, 1), "2020Q1", "A", "01", 400), (D(2020, 1), "2020Q1", "A", "02", 200),
                                 (D(2020, 1), "2020Q1", "B", "01", 300), (D(2020, 1), "2020Q1", "B", "02", 100)],
                                "ref_date date, quarter string, supersector string, state_fips string, qcew_employment bigint")
    return pay, off


def test_rake_one_margin(spark, dates):
    pay, off = _rake_inputs(spark, dates)
    r = rake_to_qcew(pay, off, ["supersector"])
    m = {x.supersector: x.t for x in r.groupBy("supersector").agg(
        F.sum(F.col("qualified_employment") * F.col("rake_weight")).alias("t")).collect()}
    assert m["A"] == pytest.approx(600, abs=1.0) and m["B"] == pytest.approx(400, abs=1.0)


def test_rake_two_margins_and_report(spark, dates):
    pay, off = _rake_inputs(spark, dates)
    dims = ["supersector", "state_fips"]
    r = rake_to_qcew(pay, off, dims, report=True).collect()
    assert all(x.rake_weight > 0 and x.converged and x.last_change < 1e-6 for x in r)
    for dim, want in (("supersector", {"A": 600, "B": 400}), ("state_fips", {"01": 700, "02": 300})):
        for value, total in want.items():
            assert sum(x.qualified_employment * x.rake_weight for x in r if x[dim] == value) == pytest.approx(total, abs=1e-2)
    capped = rake_convergence(pay, off, dims, max_iter=2, tolerance=0.0).collect()
    assert [(x.rounds, x.converged) for x in capped] == [(2, False)]


def test_rake_says_when_margins_cannot_be_met(spark, dates):
    pay, _ = _rake_inputs(spark, dates)
    pay = pay.filter("not (supersector = 'A' and state_fips = '02')").filter("not (supersector = 'B' and state_fips = '01')")
    off = spark.createDataFrame([(dates(2020, 1), "2020Q1", "A", "01", 400), (dates(2020, 1), "2020Q1", "B", "02", 100),
                                 (dates(2020, 1), "2020Q1", "A", "02", 300)],
                                "ref_date date, quarter string, supersector string, state_fips string, qcew_employment bigint")
    got = rake_convergence(pay, off, ["supersector", "state_fips"], max_iter=30).collect()
    assert len(got) == 1 and not got[0].converged and got[0].rounds == 30 and got[0].last_change > 0.1


def test_rake_one_dimension_is_closed_form(spark, dates):
    pay, off = _rake_inputs(spark, dates)
    cells, _ = rake_cells(pay, off, ["supersector"])
    assert "Python" not in cells._jdf.queryExecution().toString() and "Pandas" not in cells._jdf.queryExecution().toString()
    assert {r.supersector: r.rake_weight for r in cells.collect()} == {"A": 3.0, "B": pytest.approx(4 / 3)}


def test_rake_edge_cases(spark, dates):
    pay, off = _rake_inputs(spark, dates)
    assert {x.rake_weight for x in rake_to_qcew(pay, off, []).collect()} == {1.0}
    empty = off.limit(0)
    assert {x.rake_weight for x in rake_to_qcew(pay, empty, ["supersector"]).collect()} == {1.0}
    alt = off.withColumnRenamed("qcew_employment", "month1_emplvl")
    r = rake_to_qcew(pay, alt, ["supersector"])
    t = r.filter(F.col("supersector") == "A").agg(F.sum(F.col("qualified_employment") * F.col("rake_weight"))).first()[0]
    assert t == pytest.approx(600, abs=1.0)


def test_kaplan_meier(spark, dates):
    D = dates
    rows = []
    for cid, months in (("a", 40), ("b", 14), ("c", 3), ("d", 30)):
        rows += [(cid, D(2018 + m // 12, m % 12 + 1), D(2018, 1), True) for m in range(months)]
    rows.append(("e", D(2018 + 39 // 12, 39 % 12 + 1), D(2018 + 36 // 12, 1), True))
    df = spark.createDataFrame(rows, "client_id string, ref_date date, entry_month date, is_birth boolean")
    r = {x.entry_quarter: x for x in compute_kaplan_meier(df).collect()}
    first = r["2018Q1"]  # a is censored at the end of the data, b, c and d fail
    assert (first.birth_cohort_n, first.failures) == (4, 3)
    assert first.survival_4q == pytest.approx(3 / 4) and first.survival_8q == pytest.approx(3 / 4 * 2 / 3)
    assert first.survival_12q == pytest.approx(3 / 4 * 2 / 3 * 1 / 2) and first.survival_16q is None
    late = r["2021Q1"]  # seen for a few months only, then censored
    assert late.failures == 0 and late.survival_4q is None


def test_registered_convergence_reports_the_last_change(spark, dates, tmp_path):
    from panelscope.plans.catalog import REGISTRY

    months = [dates(1996, m) for m in (1, 2, 3)]
    customers = [(c, c % 3, ("BUILDING", "FURNITURE")[c % 2]) for c in range(1, 13)]
    orders = [(100 * c + i, c, m) for c, _, _ in customers for i, m in enumerate(months)]
    lines = [(o, 1, c % 4 + 1, n, float((c * 7 + o * n) % 11 + 1), 100.0, "R" if o % 5 == 0 else "N", months[(m.month + n) % 3]) for o, c, m in orders for n in (1, 2)]
    spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate date").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_orderdate as timestamp_ntz) o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, d date").selectExpr("* except (d)", "cast(d as timestamp_ntz) l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = REGISTRY["rake_convergence"].spark(spark, str(tmp_path)).collect()
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for t in ("supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT 1 AS s_suppkey, 1 AS s_nationkey, 1 AS n_nationkey")
    got = con.sql(REGISTRY["rake_convergence"].oracle())
    want = {r[got.columns.index("ref_date")]: r[got.columns.index("last_change")] for r in got.fetchall()}
    assert len(rows) == 3 and {r.ref_date: r.last_change for r in rows} == pytest.approx(want, rel=1e-6)
    assert all((r.last_change < 1e-6) == r.converged for r in rows) and any(r.last_change > 0 for r in rows)
