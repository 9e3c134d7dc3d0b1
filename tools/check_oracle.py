"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Compares row counts, column names and sorted row values (doubles to 1e-6).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from panelscope.plans.catalog import REGISTRY  # noqa: E402
from panelscope.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 5))
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name in names:
        q = REGISTRY[name]
        t0 = time.time()
        try:
            sdf = q.spark(spark, sf)
            scols = sdf.columns
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # report and continue
            print(f"FAIL {name}: spark error {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = q.oracle()
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql)
            ocols = rel.columns
            otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
            orows = rel.fetchall()
        except Exception as exc:
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(ocols):
            print(f"FAIL {name}: columns differ\n  spark {scols}\n  duck  {ocols}")
            bad += 1
            continue
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                "boolean": "BOOLEAN"}
        tdiff = [(c, stypes[c], otypes[c]) for c in scols if tmap.get(stypes[c], stypes[c]) != otypes[c]]
        if tdiff:
            print(f"TYPE {name}: {tdiff}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        oi = [ocols.index(c) for c in order]
        s = sorted(tuple(norm(r[i]) for i in si) for r in srows)
        o = sorted(tuple(norm(r[i]) for i in oi) for r in orows)
        if len(s) != len(o):
            print(f"FAIL {name}: rows spark={len(s)} duck={len(o)}")
            bad += 1
            continue
        diff = [(a, b) for a, b in zip(s, o) if a != b]
        if diff:
            print(f"FAIL {name}: {len(diff)} differing rows, e.g.\n  {diff[0][0]}\n  {diff[0][1]}")
            bad += 1
            continue
        print(f"OK   {name}: {len(s)} rows {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
