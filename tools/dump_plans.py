"""Run headline queries and write the plans that were executed to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelscope.plans.catalog import REGISTRY  # noqa: E402
from panelscope.session import get_spark  # noqa: E402

DEFAULT = ["coverage_all_levels", "reweighting_series", "rake_two_dims", "birth_lead", "job_to_job", "tenure_summary", "earnings_dist",
           "csi_by_dimension", "panel_all_levels", "flows_employee"]
WIDTH = 110
SHOWN = re.compile(r"AdaptiveSparkPlan|Exchange|Scan|Join|Aggregate|Window|Expand|Generate|Pandas|Arrow|Union")


def executed(df) -> str:
    """The final plan of a run: AQE keeps it above the initial one."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    lines = query.executedPlan().toString().splitlines()
    end = next((i for i, ln in enumerate(lines) if "== Initial Plan ==" in ln), len(lines))
    plan = [re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", ln) for ln in lines[:end] if SHOWN.search(ln[:80 + len(ln) - len(ln.lstrip(" :+-"))])]
    scans = sorted({m[0] for ln in plan for m in [re.findall(r"FileScan parquet \[[^\]]*\].*", ln)] if m})
    plan = [re.sub(r"^[ :+*-]*", lambda m: " " * (len(m[0]) // 3), ln) for ln in plan]
    return "\n".join([ln[:WIDTH] for ln in plan] + ["", *[re.sub(r"Location: \S+ \S+ ?", "", x)[:400] for x in scans]])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark("local[8]", shuffle_partitions=16, extra={"spark.sql.maxMetadataStringLength": "400"})
    out = ["# Executed plans of headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (local[8], 16 shuffle partitions, AQE on): the final plan of each run without projections, filters,",
           f"sorts and shuffle reads, lines cut at {WIDTH} characters, and below it the scans with pushed filters and read schemas.", ""]
    for n in names:
        out += [f"## {n}", "", "```", executed(REGISTRY[n].spark(spark, sf)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
