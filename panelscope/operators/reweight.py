"""Raking (iterative proportional fitting) of payroll weights to official margins.

Weights are constant inside a cell (period x dimension values), and margins never cross periods. Payroll is
aggregated to cells first, so what is fitted is bounded by the dimension domains, not by the payroll.

One dimension needs no iteration: the weight is the ratio of the margins, one group-by and one join. With more, rounds run over the
cell table of all periods together. A round takes one dimension after another: the weighted margin of each of its values in each period, and
the ratio of the official margin to it. Some rounds (``STEPS`` margins) are one job, written to the shared folder with each round's weights and changes; one
aggregate then tells for each period the first round that changed no weight by ``tolerance`` or more. Such periods are done, the others
go on. Where a period has up to ``TASK_CELLS`` cells, periods are dealt to tasks once a job and a round only sorts within them; beyond that, each
margin is dealt anew, so that no task gets a period. Both give the same weights.

A period need not converge: where payroll has no client in a cell, say, a state's and an industry's margins may not be reachable
together, and the fit alternates between two sets of weights. Its rows are then marked ``converged = false``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.sources.shared import shared_table

#: Margins that a job fits one after another (its query text nests as deeply), and cells of a period that one task may go through.
STEPS = 24
TASK_CELLS = 2_000_000
REPORT = ["rounds", "last_change", "converged"]
Official = DataFrame | Mapping[str, DataFrame]


def _of(official: Official, dimension: str) -> DataFrame | None:
    return official.get(dimension) if isinstance(official, Mapping) else official


def _employment(official: DataFrame) -> str | None:
    return next((c for c in ("qcew_employment", "month1_emplvl") if c in official.columns), None)


def _margins(official: Official, period: list[str], dims: list[str]) -> dict[str, DataFrame]:
    """The official margins of each dimension; those of one table come from one pass over it."""
    out = {}
    tables = {id(_of(official, d)): _of(official, d) for d in dims}
    for key, table in tables.items():
        mine = [d for d in dims if id(_of(official, d)) == key]
        total = F.sum(_employment(table)).cast("double").alias("_q")
        if len(mine) == 1:
            out[mine[0]] = table.groupBy(*period, mine[0]).agg(total)
            continue
        sets = table.groupingSets([[*period, d] for d in mine], *period, *mine).agg(total, *[F.grouping(d).alias(f"_g_{d}") for d in mine])
        sets = shared_table(sets)
        for d in mine:
            out[d] = sets.where(F.col(f"_g_{d}") == 0).select(*period, d, "_q")
    return out


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def _fit_rounds(cells: DataFrame, period: list[str], dims: list[str], n: int) -> DataFrame:
    """``cells`` (with weights ``_w``) and the weights and largest changes of each of ``n`` rounds: ``_w1``, ``_c1``, ...

    One query text, which the driver analyses once; rounds as DataFrame steps are analysed one after another.
    """
    steps = [("_w", None)] + [(f"_w{r}" if k == len(dims) else f"_s{r}_{k}", d) for r in range(1, n + 1) for k, d in enumerate(dims, 1)]
    query = "{cells}"
    for (w, _), (to, d) in zip(steps, steps[1:]):
        keys = ", ".join(f"`{c}`" for c in [*period, d])
        # a margin without payroll or without target leaves weights alone
        query = f"(SELECT *, {w} * coalesce(try_divide(`_q_{d}`, sum(_e * {w}) OVER (PARTITION BY {keys})), 1D) AS {to} FROM {query})"
    names = [w for w, _ in steps]
    changes = []
    for r in range(1, n + 1):
        mine = names[(r - 1) * len(dims):r * len(dims) + 1]
        changes.append(f"greatest({', '.join(f'abs({y} - {x})' for x, y in zip(mine, mine[1:]))}) AS _c{r}")
    kept = ", ".join([f"`{c}`" for c in cells.columns] + [f"_w{r}" for r in range(1, n + 1)])
    return cells.sparkSession.sql(f"SELECT {kept}, {', '.join(changes)} FROM {query}", cells=cells)


def rake_cells(payroll: DataFrame, official: Official, dimensions: list[str], max_iter: int = 100,
               tolerance: float = 1e-6, employment_col: str = "qualified_employment") -> tuple[DataFrame, list[str]]:
    """(cells with ``rake_weight``, ``rounds``, ``last_change`` and ``converged``; their key columns).

    ``official`` is one table with all dimensions, or one for each. Dimensions that either side lacks are left out.
    """
    dims = [d for d in dimensions if d in payroll.columns and _of(official, d) is not None and d in _of(official, d).columns and _employment(_of(official, d))]
    period = [c for c in ("ref_date", "quarter") if c in payroll.columns and all(c in _of(official, d).columns for d in dims)]
    keys = [c for c in ("ref_date", "quarter") if c in payroll.columns] + [d for d in dimensions if d in payroll.columns and d in dims]
    cells = payroll.groupBy(*keys).agg(F.sum(employment_col).cast("double").alias("_e"))
    one = F.lit(1.0)
    if not dims:
        return cells.withColumns({"rake_weight": one, "rounds": F.lit(0), "last_change": F.lit(0.0), "converged": F.lit(True)}), keys
    margins = _margins(official, period, dims)
    if len(dims) == 1:
        d = dims[0]
        on = period + [d]
        totals = cells.groupBy(*on).agg(F.sum("_e").alias("_p"))
        ratio = totals.join(margins[d], on, "left").select(*on, F.coalesce(td("_q", "_p"), one).alias("_r"))
        out = cells.join(ratio, on, "left").withColumn("rake_weight", F.coalesce("_r", one)).drop("_r")
        return out.withColumns({"rounds": F.lit(1), "last_change": F.lit(0.0), "converged": F.lit(True)}), keys
    for d in dims:
        cells = cells.join(margins[d].withColumnRenamed("_q", f"_q_{d}"), period + [d], "left")
    at, done, base = shared_table(cells.withColumn("_w", one)), [], 0
    largest = at.groupBy(*period).count().agg(F.max("count")).first()[0] or 0
    while True:
        n = min(max(1, STEPS // len(dims)), max_iter - base)
        wide = shared_table(_fit_rounds(at.repartition(*period) if period and largest <= TASK_CELLS else at, period, dims, n))
        changes = wide.groupBy(*[F.col(c).alias(f"_p_{c}") for c in period]).agg(F.array(*[F.max(f"_c{r}") for r in range(1, n + 1)]).alias("_c"))
        first = F.array_min(F.transform(F.col("_c"), lambda c, i: F.when(c < tolerance, i + 1)))
        stops = changes.withColumn("_stop", first)
        on = _same([F.col(c) for c in period], [F.col(f"_p_{c}") for c in period]) if period else F.lit(True)
        both = wide.join(stops, on)
        ended = F.col("_stop").isNotNull() | F.lit(base + n >= max_iter)
        last = F.coalesce("_stop", F.lit(n))
        weights = F.array(*[f"_w{r}" for r in range(1, n + 1)])
        done.append(both.where(ended).select(*keys, "_e", F.get(weights, last - 1).alias("rake_weight"), (last + base).cast("int").alias("rounds"),
                                             F.get("_c", last - 1).alias("last_change"), F.col("_stop").isNotNull().alias("converged")))
        base += n
        if base >= max_iter or stops.where("_stop is null").isEmpty():
            return reduce(DataFrame.unionByName, done), keys
        at = both.where("_stop is null").select(*keys, "_e", *[f"_q_{d}" for d in dims], F.col(f"_w{n}").alias("_w"))


def rake_convergence(payroll: DataFrame, official: Official, dimensions: list[str], max_iter: int = 100,
                     tolerance: float = 1e-6) -> DataFrame:
    """One row per period: rounds, last_change, converged."""
    cells, keys = rake_cells(payroll, official, dimensions, max_iter, tolerance)
    return cells.select(*[k for k in ("ref_date", "quarter") if k in keys], *REPORT).distinct()


def rake_to_qcew(payroll: DataFrame, official: Official, dimensions: list[str], max_iter: int = 100,
                 tolerance: float = 1e-6, report: bool = False, keep_unconverged: bool = True) -> DataFrame:
    """Payroll rows plus ``rake_weight`` so weighted margins match the official ones.

    ``official`` is one table, or one for each dimension. With two or more dimensions the rounds run when this is called.
    Without ``keep_unconverged`` the weights of periods that did not converge are null: they grow with every round.
    ``report`` adds ``rounds``, ``last_change`` and ``converged`` of the row's period.
    """
    cells, keys = rake_cells(payroll, official, dimensions, max_iter, tolerance)
    renamed = [f"_k{i}" for i in range(len(keys))]
    w = cells.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)], F.col("rake_weight").alias("_w"), *REPORT)
    on = None
    for k, r in zip(keys, renamed):
        e = F.col(k).eqNullSafe(F.col(r))
        on = e if on is None else on & e
    j = payroll.join(w, on, "left")
    weight = F.coalesce(F.col("_w"), F.lit(1.0))
    weight = weight if keep_unconverged else F.when(F.col("converged"), weight)
    return j.select(*payroll.columns, weight.alias("rake_weight"), *(REPORT if report else []))


def reweighting_impact(growth: DataFrame, reweighted: DataFrame) -> DataFrame:
    """National growth joined to the reweighted YoY growth (left join on ref_date)."""
    r = reweighted.select("ref_date", F.col("yoy_growth").alias("reweighted_yoy"))
    return growth.join(r, "ref_date", "left")
