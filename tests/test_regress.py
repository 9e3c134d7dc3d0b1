import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscope.functions.regress import least_squares
from panelscope.operators.births import birth_lead_lags

SCHEMA = "g string, y double, terms array<struct<term:string,value:double>>, base int"


def _frame(spark, groups):
    """``groups``: name -> (y, matrix, base)."""
    rows = [(g, None if v is None else float(v), [(f"t{j}", None if np.isnan(x) else float(x)) for j, x in enumerate(row)], base)
            for g, (y, X, base) in groups.items() for v, row in zip(y, X)]
    return spark.createDataFrame(rows, SCHEMA)


def _fit(y, X):
    A = np.column_stack([np.ones(len(y)), X])
    beta, _, rank, _ = np.linalg.lstsq(A, y, rcond=1e-9)
    return beta, rank - 1, float(((y - A @ beta) ** 2).sum())


def test_fits_match_least_squares_for_any_number_of_terms(spark):
    rng = np.random.default_rng(3)
    groups = {}
    for k in (1, 2, 5, 9):
        X = rng.normal(size=(40, k)) * 10.0 ** rng.integers(-3, 3, k) + 5
        groups[f"k{k}"] = (X @ rng.normal(size=k) + rng.normal(size=40), X, k // 2)
    got = {r.g: r for r in least_squares(_frame(spark, groups), ["g"], "y", "terms", "base").collect()}
    for g, (y, X, base) in groups.items():
        r = got[g]
        beta, rank, rss = _fit(y, X)
        assert (r.n, r["rank"], r.dof, r.f_dof) == (40, rank, 39 - rank, X.shape[1] - base)
        assert [r.intercept] + [t.coef for t in r.fit] == pytest.approx(beta.tolist(), rel=1e-6)
        assert r.r2 == pytest.approx(1 - rss / ((y - y.mean()) ** 2).sum(), rel=1e-9)
        rss0 = _fit(y, X[:, :base])[2]
        assert r.f == pytest.approx((rss0 - rss) / r.f_dof / (rss / r.dof), rel=1e-7)
        A = np.column_stack([np.ones(40), X])
        se = np.sqrt(np.diag(np.linalg.inv(A.T @ A)) * rss / r.dof)[1:]
        assert [t.se for t in r.fit] == pytest.approx(se.tolist(), rel=1e-6)


def test_collinear_and_constant_terms_have_the_solution_of_least_norm(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=30), rng.normal(size=30)
    y = 2 * a - b + rng.normal(size=30) + 4
    groups = {"twice": (y, np.column_stack([a, b, 2 * a]), 1), "sum": (y, np.column_stack([a, b, a + b + 1, a - b]), 0),
              "constant": (y, np.column_stack([np.full(30, 3.0), a]), 1), "zero": (y, np.column_stack([a, np.zeros(30)]), 1)}
    got = {r.g: r for r in least_squares(_frame(spark, groups), ["g"], "y", "terms", "base").collect()}
    for g, (y, X, _) in groups.items():
        beta, rank, rss = _fit(y, X)
        assert got[g]["rank"] == rank and got[g].dof == 29 - rank
        assert [got[g].intercept] + [t.coef for t in got[g].fit] == pytest.approx(beta.tolist(), rel=1e-6, abs=1e-9)
        assert got[g].r2 == pytest.approx(1 - rss / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    assert [t.se is None for t in got["twice"].fit] == [True, False, True]
    assert [t.se is None for t in got["sum"].fit] == [True] * 4
    assert [t.se is None for t in got["zero"].fit] == [False, True] and got["zero"].f is None


def test_nulls_few_rows_and_no_rows(spark):
    groups = {"nulls": ([1.0, None, 2.0, 4.0, 3.0], np.array([[1.0], [2.0], [3.0], [np.nan], [7.0]]), 0),
              "one": ([1.0], np.array([[2.0]]), 0), "flat": ([5.0] * 4, np.array([[1.0], [2.0], [3.0], [4.0]]), 0)}
    got = {r.g: r for r in least_squares(_frame(spark, groups), ["g"], "y", "terms", "base").collect()}
    assert got["nulls"].n == 3
    assert got["one"].n == 1 and got["one"]["rank"] == 0 and got["one"].dof is None and got["one"].r2 is None
    assert got["flat"].r2 is None and got["flat"].fit[0].coef == pytest.approx(0.0, abs=1e-12)
    assert least_squares(spark.createDataFrame([], SCHEMA), ["g"], "y", "terms", "base").count() == 0


def test_lag_orders_of_births(spark):
    rng = np.random.default_rng(7)
    n = 24
    x, y = rng.uniform(0.01, 0.03, n), rng.uniform(0.01, 0.03, n)
    qs = [f"{2014 + i // 4}Q{i % 4 + 1}" for i in range(n)]
    p = spark.createDataFrame([(q, float(v)) for q, v in zip(qs, x)], "quarter string, birth_rate double")
    o = spark.createDataFrame([(q, float(v)) for q, v in zip(qs, y)], "quarter string, bed_birth_rate double")
    got = {(r.lag_order, r.model, r.term): r for r in birth_lead_lags(p, o, 3).collect()}
    assert len(got) == sum((k + 1) + 2 * k for k in (1, 2, 3))
    for order in (1, 2, 3):
        lag = lambda v, k: v[order - k:n - k]
        px = [lag(x, k) for k in range(1, order + 1)]
        own = [lag(y, k) for k in range(1, order + 1)]
        for model, before in (("leading", [lag(x, 0)]), ("incremental", own)):
            beta, rank, rss = _fit(lag(y, 0), np.column_stack(before + px))
            rss0 = _fit(lag(y, 0), np.column_stack(before))[2]
            names = (["payroll"] if model == "leading" else [f"official_lag{k}" for k in range(1, order + 1)]) + [f"payroll_lag{k}" for k in range(1, order + 1)]
            for name, b in zip(names, beta[1:]):
                r = got[order, model, name]
                assert (r.n, r["rank"], r.dof, r.f_dof) == (n - order, rank, n - order - 1 - rank, order)
                assert r.coef == pytest.approx(b, rel=1e-6)
                assert r.f == pytest.approx((rss0 - rss) / order / (rss / r.dof), rel=1e-6)
    few = birth_lead_lags(p.filter("quarter < '2016Q3'"), o, 4)
    assert few.filter(F.col("model") == "incremental").agg(F.max("lag_order")).first()[0] == 2  # 10 quarters: order 3 has no degree of freedom
    assert birth_lead_lags(p.filter("quarter < '2016Q2'"), o, 4).count() == 0
