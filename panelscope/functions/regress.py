"""Least squares on any number of regressors, for every group at once.

The Gram matrix of the centred regressors and the outcome is aggregated in long form, a row for each pair of columns, so that neither
the number of regressors nor the number of groups enlarges the plan. Each group's matrix, whose size depends on the model only, is
then solved by sweeping its pivots. Collinear regressors have the solution of least norm, the intercept included.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.functions.cols import td

#: A regressor is collinear with those before it if at most this share of its variation is left.
COLLINEAR = 1e-9
#: A regressor is constant if its variance is at most this share of its squared mean.
CONSTANT = 1e-20

Bound = Callable[[Column], Column]


def _let(value: Column, body: Bound) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _count(n: Column) -> Column:
    """0, 1, ..., n - 1."""
    return F.when(n >= 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _swept(m: Column, pivots: Column, usable: Callable[[Column, Column], Column]) -> Column:
    """Sweep the pivots of a symmetric matrix, leaving out those not usable; struct of the matrix and the pivots swept."""
    def step(acc, k):
        d = acc["m"][k][k]
        rows = F.transform(acc["m"], lambda row, i: F.transform(row, lambda v, j: (
            F.when((i == k) & (j == k), -1 / d).when((i == k) | (j == k), v / d).otherwise(v - row[k] * acc["m"][k][j] / d))))
        return F.when(usable(d, k), F.struct(rows.alias("m"), F.array_append(acc["done"], k).alias("done"))).otherwise(acc)
    return F.aggregate(pivots, F.struct(m.alias("m"), F.array().cast("array<int>").alias("done")), step)


def _least_norm(m: Column, done: Column, means: Column, p: Column) -> Column:
    """Intercept and slopes of least norm, from the swept matrix; the outcome is the last row."""
    left = F.filter(_count(p), lambda j: ~F.array_contains(done, j))
    slopes = F.transform(_count(p), lambda j: F.when(F.array_contains(done, j), m[j][p]).otherwise(F.lit(0.0)))

    def with_intercept(v, start):
        return F.concat(F.array(start - _dot(v, F.slice(means, F.lit(1), p))), v)

    # Directions that change no fitted value: a left-out regressor against the swept ones that give it.
    def null_vector(d):
        v = F.transform(_count(p), lambda j: F.when(F.array_contains(done, j), m[j][d]).when(j == d, F.lit(-1.0)).otherwise(F.lit(0.0)))
        return with_intercept(v, F.lit(0.0))

    def shortened(full, nulls):
        k = F.size(nulls)
        rows = F.concat(nulls, F.array(full))
        products = F.transform(rows, lambda a: F.transform(rows, lambda b: _dot(a, b)))
        solved = _swept(products, _count(k), lambda d, _: d > 0)["m"]
        return F.transform(full, lambda b, j: b - F.aggregate(_count(k), F.lit(0.0), lambda s, i: s + solved[i][k] * nulls[i][j]))

    return _let(with_intercept(slopes, means[p]), lambda full: F.when(F.size(left) == 0, full).otherwise(
        _let(F.transform(left, null_vector), lambda nulls: shortened(full, nulls))))


def least_squares(df: DataFrame, groups: list[str], y: str, terms: str, base: str | None = None) -> DataFrame:
    """Fit ``y`` on an intercept and the regressors of each row, group by group.

    ``terms`` is an array of (term, value) structs, the same terms in the same order for all rows of a group; ``base`` counts the
    first terms that the restricted model has (none without it). Returns the groups with n, rank (intercept left out), r2, dof, f and
    f_dof (joint test of the terms after the base), intercept, and fit: an array of (term, coef, se). Rows with a NULL in the outcome
    or a term are left out. ``se`` is NULL for terms that others of the model can replace; r2 and f without variation or degrees of
    freedom are NULL; a group without usable rows has no row, a term list without entries fits the mean.
    """
    keys = list(groups)
    usable = df.filter(F.col(y).isNotNull() & F.forall(terms, lambda t: t["value"].isNotNull()))
    z = usable.select(*keys, F.transform(terms, lambda t: t["term"]).alias("_names"), (F.col(base) if base else F.lit(0)).cast("int").alias("_base"),
                      F.concat(F.transform(terms, lambda t: t["value"].cast("double")), F.array(F.col(y).cast("double"))).alias("_z"))
    last = F.size("_z") - 1
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: F.transform(F.sequence(i, last), lambda j: F.struct(
        i.alias("i"), j.alias("j"), F.col("_z")[i].alias("a"), F.col("_z")[j].alias("b")))))
    model = keys + ["_names", "_base"]
    cells = z.select(*model, F.explode(pairs).alias("_c")).groupBy(*model, "_c.i", "_c.j").agg(
        F.count(F.lit(1)).alias("n"), (F.covar_pop("_c.a", "_c.b") * F.count(F.lit(1))).alias("s"), F.avg("_c.a").alias("mean"))
    g = cells.groupBy(*model).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "j", "s", "mean"))).alias("_cells"))
    size = F.size("_names") + 1
    at = lambda i, j: (i * size - i * (i - 1) / 2 + (j - i)).cast("int")
    g = g.select(
        *model, "n",
        F.transform(_count(size), lambda i: F.transform(_count(size), lambda j: F.col("_cells")[at(F.least(i, j), F.greatest(i, j))]["s"])).alias("_m"),
        F.transform(F.filter("_cells", lambda c: c["i"] == c["j"]), lambda c: c["mean"]).alias("_means"))
    p = F.size("_names")

    def solution(m, means):
        def alone(d, k):
            return (d > COLLINEAR * m[k][k]) & (m[k][k] > CONSTANT * means[k] * means[k] * F.col("n"))
        first = _swept(m, _count(F.col("_base")), alone)
        rest = F.when(p > F.col("_base"), F.sequence(F.col("_base"), p - 1)).otherwise(F.array().cast("array<int>"))

        def both(a):
            return _let(_swept(a["m"], rest, alone), lambda b: F.struct(
                m[p][p].alias("tss"), a["m"][p][p].alias("rss0"), F.size(a["done"]).alias("rank0"),
                b["m"].alias("m"), b["m"][p][p].alias("rss"), F.concat(a["done"], b["done"]).alias("done")))
        return _let(first, both)

    g = g.withColumn("_s", _let(F.col("_m"), lambda m: _let(F.col("_means"), lambda means: solution(m, means))))
    rank, dof = F.size("_s.done"), F.col("n") - 1 - F.size("_s.done")
    rss = F.greatest(F.col("_s.rss"), F.lit(0.0))
    f_dof = rank - F.col("_s.rank0")
    variance = td(rss, dof)

    def standard_error(s, j):
        replaced = F.exists(_count(p), lambda d: ~F.array_contains(s["done"], d) & (F.abs(s["m"][j][d]) > COLLINEAR))
        return F.when(F.array_contains(s["done"], j) & ~replaced, F.sqrt(-s["m"][j][j] * variance))

    fit = _let(F.col("_s"), lambda s: _let(_least_norm(s["m"], s["done"], F.col("_means"), p), lambda full: F.struct(
        full[0].alias("intercept"), F.transform("_names", lambda t, j: F.struct(
            t.alias("term"), full[j + 1].alias("coef"), standard_error(s, j).alias("se"))).alias("terms"))))
    return g.select(
        *keys, "n", rank.alias("rank"), (1 - td(rss, F.col("_s.tss"))).alias("r2"), F.when(dof > 0, dof).alias("dof"),
        F.when((f_dof > 0) & (dof > 0), td((F.col("_s.rss0") - rss) * dof, rss * f_dof)).alias("f"), f_dof.alias("f_dof"),
        fit.alias("_fit")).select("*", F.col("_fit.intercept").alias("intercept"), F.col("_fit.terms").alias("fit")).drop("_fit")
