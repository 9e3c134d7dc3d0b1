import os
import tempfile

from pyspark.sql import functions as F

from panelscope.operators.panel import build_panel
from panelscope.plans.inputs import bed, ces, official_long
from panelscope.plans.pipeline import OfficialInputs, run_pipeline, write_outputs
from panelscope.sources import synth
from panelscope.streaming import start_panel_refresh

SF = "/root/testdata/sf0.001"


def test_run_pipeline_all_outputs(spark):
    pay = synth.payroll(spark, SF)
    out = run_pipeline(pay, OfficialInputs(official_long(spark, SF), ces(spark, SF), bed(spark, SF)))
    for name in ("dq_summary", "panel", "coverage_national", "cell_reliability", "growth_comparison",
                 "turning_points", "divergence", "flows", "earnings", "birth_comparison", "birth_lead",
                 "survival", "reweighted_growth", "reweighting_impact"):
        assert name in out, name
    assert out["panel"].count() > 0
    assert out["coverage_national"].filter(F.col("coverage_ratio_employment").isNotNull()).count() > 0
    d = tempfile.mkdtemp(prefix="panelscope-out-")
    write_outputs({"dq_summary": out["dq_summary"]}, d, "csv")
    assert any(f.endswith(".csv") for f in os.listdir(f"{d}/dq_summary"))
    read = spark.read.csv(f"{d}/dq_summary", header=True, schema=out["dq_summary"].schema)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, out["dq_summary"].collect()))
    write_outputs({"coverage_national": out["coverage_national"]}, d, "parquet")
    back = spark.read.parquet(f"{d}/coverage_national")
    assert back.exceptAll(out["coverage_national"]).count() == 0 and back.count() == out["coverage_national"].count()
    out.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_streaming_panel_refresh_matches_batch(spark):
    raw = synth.payroll_raw(spark, SF)
    src = tempfile.mkdtemp(prefix="panelscope-src-")
    raw.write.mode("overwrite").parquet(f"{src}/drop1")
    schema = spark.read.parquet(f"{src}/drop1").schema
    out = tempfile.mkdtemp(prefix="panelscope-panel-")
    q = start_panel_refresh(spark, f"{src}/drop1", schema, f"{out}/panel", f"{out}/_ckpt")
    q.awaitTermination(300)
    streamed = spark.read.parquet(f"{out}/panel").drop("month")
    batch = build_panel(synth.payroll(spark, SF))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_split_and_late_months_equal_the_batch(spark):
    raw = synth.payroll_raw(spark, SF)
    src, out = tempfile.mkdtemp(prefix="panelscope-src-"), tempfile.mkdtemp(prefix="panelscope-panel-")
    # clients of a month over three files, and a second row of some client months; the first month comes last
    first = raw.agg(F.min("ref_date")).first()[0]
    twice = raw.where("client_id % 5 = 0").withColumn("qualified_employment", F.lit(3).cast("bigint"))
    parts = [raw.where((F.col("client_id") % 2 == 0) & (F.col("ref_date") > first)), raw.where((F.col("client_id") % 2 == 1) & (F.col("ref_date") > first)), twice,
             raw.where(F.col("ref_date") == first)]
    for k, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{src}/part{k}")
        start_panel_refresh(spark, f"{src}/part{k}", raw.schema, f"{out}/panel", f"{out}/_ckpt{k}").awaitTermination(300) if k == 0 else None
    from panelscope.sources.payroll import normalise_payroll
    from panelscope.streaming import fold_drop
    for k in (1, 2, 3, 2):  # the last is a replay
        fold_drop(spark.read.parquet(f"{src}/part{k}"), k, f"{out}/panel", f"{out}/panel-state")
    got = spark.read.parquet(f"{out}/panel").drop("month")
    want = build_panel(normalise_payroll(raw.unionByName(twice)))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).isEmpty()
