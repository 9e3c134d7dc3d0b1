"""Driver contract: entry(), queries() and oracle_sql() at sf0.001 against DuckDB.

Each oracle becomes a view over views of the tables, as a driver may do it, and doubles are compared with a tolerance.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from panelscope.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
#: Without an oracle; other tests compare these with brute force.
NO_ORACLE: set[str] = set()


def key(row):
    return tuple((v is None, "" if v is None else round(v, 4) if isinstance(v, float) and not math.isnan(v) else v if isinstance(v, (int, bool)) else str(v))
                 for v in row)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) or math.isnan(a) and math.isnan(b))
    return a == b


def compare(columns, rows, oracle_columns, oracle_rows):
    assert sorted(columns) == sorted(oracle_columns)
    exact = [c for c in sorted(columns) if not any(isinstance(r[columns.index(c)], float) for r in rows)]
    order = exact + [c for c in sorted(columns) if c not in exact]
    pick = lambda cols, r: tuple(r[cols.index(c)] for c in order)
    a = sorted((pick(columns, r) for r in rows), key=key)
    b = sorted((pick(oracle_columns, r) for r in oracle_rows), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(same(p, q) for p, q in zip(x, y)), (order, x, y)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert {"supersector", "coverage_ratio_employment", "reliability"} <= set(df.columns)
    assert df.count() > 0


def test_contract_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(REGISTRY) >= 60 and set(REGISTRY) <= set(q)
    assert {n for n in REGISTRY if n not in o} == NO_ORACLE


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql is not None))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name].spark(spark, SF)
    con.execute(f"CREATE OR REPLACE VIEW result AS {REGISTRY[name].oracle()}")
    rel = con.sql("SELECT * FROM result")
    compare(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
