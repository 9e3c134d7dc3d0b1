import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from panelscope.operators.panel import build_panel
from panelscope.operators.quality import flag_data_quality_issues
from panelscope.operators.tenure import compute_client_tenure
from panelscope.sources import load_bed, load_panel, load_qcew, read_by_year, save_panel, synth, write_by_year

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def panel_table(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('tables')}/panel"
    save_panel(synth.payroll(spark, SF), "panel_by_client", 6, path=path)
    yield "panel_by_client", path
    spark.sql("DROP TABLE panel_by_client")


def test_panel_round_trip_and_year_range(spark, panel_table):
    name, path = panel_table
    want, got = synth.payroll(spark, SF), load_panel(spark, name)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    some = load_panel(spark, name, (1996, 1997))
    assert some.exceptAll(want.filter("year(ref_date) between 1996 and 1997")).count() == 0
    assert some.count() == want.filter("year(ref_date) between 1996 and 1997").count() > 0
    assert {re.search(r"ref_year=(\d+)", f)[1] for f in some.inputFiles()} == {"1996", "1997"}
    for year in glob.glob(f"{path}/ref_year=*"):
        files = glob.glob(f"{year}/*.parquet")
        assert len(files) == len({re.search(r"_(\d+)\.c\d+", f)[1] for f in files}) <= 6  # one file a bucket and year


def test_client_windows_and_aggregates_need_no_shuffle(spark, panel_table):
    rows = load_panel(spark, panel_table[0], (1996, 1998))
    plan = _plan(compute_client_tenure(rows))
    assert "SelectedBucketsCount: 6 out of 6" in plan and "Exchange hashpartitioning" not in plan
    assert "PartitionFilters: [isnotnull(ref_year" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_data_quality_issues(rows.drop("employee_id"))[0]
        # Neither the months nor their windows are shuffled; the join back is, because null-safe keys are other keys than the buckets'.
        assert not re.search(r"Exchange hashpartitioning\(client", _plan(flagged)) and "Window [" in _plan(flagged)
        before = flag_data_quality_issues(synth.payroll(spark, SF).filter("year(ref_date) between 1996 and 1998").drop("employee_id"))[0]
        assert flagged.exceptAll(before).count() == 0 and flagged.count() == before.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert build_panel(rows).count() > 0


def test_appended_month_stays_in_its_bucket(spark, tmp_path):
    rows = synth.payroll(spark, SF)
    save_panel(rows.filter("ref_date < '1997-01-01'"), "panel_grown", 4, path=f"{tmp_path}/grown")
    try:
        save_panel(rows.filter("ref_date >= '1997-01-01'"), "panel_grown", 4, path=f"{tmp_path}/grown", mode="append")
        got = load_panel(spark, "panel_grown")
        assert got.exceptAll(rows).count() == 0 and got.count() == rows.count()
        assert compute_client_tenure(got).exceptAll(compute_client_tenure(rows)).count() == 0
    finally:
        spark.sql("DROP TABLE panel_grown")


def test_official_tables_by_year(spark, tmp_path):
    raw = synth.qcew_raw(spark, SF).filter("slice = 'national'").drop("slice")
    write_by_year(raw, f"{tmp_path}/qcew")
    all_years = load_qcew(spark, national=f"{tmp_path}/qcew")
    some = load_qcew(spark, national=f"{tmp_path}/qcew", years=(1996, 1996))
    assert all_years.count() == 3 * raw.count() and some.count() == 3 * raw.filter("year = 1996").count() > 0
    assert re.search(r"PartitionFilters: \[isnotnull\(ref_year#\d+\), \(ref_year#\d+ >= 1996\), \(ref_year#\d+ <= 1996\)\]", _plan(some))
    bed = synth.bed_raw(spark, SF)
    write_by_year(bed, f"{tmp_path}/bed")
    got = load_bed(spark, f"{tmp_path}/bed", (1996, 1997))
    assert {r.year for r in got.select("year").distinct().collect()} == {1996, 1997}
    # one year written again replaces that year alone
    write_by_year(bed.filter("year(date) = 1996").limit(5), f"{tmp_path}/bed")
    left = read_by_year(spark, f"{tmp_path}/bed").groupBy(F.year("date").alias("y")).count()
    want = {r.y: r["count"] for r in bed.groupBy(F.year("date").alias("y")).count().collect()} | {1996: 5}
    assert {r.y: r["count"] for r in left.collect()} == want


def test_null_dates_and_a_clashing_column(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 12)), (2, None)], "client_id long, ref_date date")
    write_by_year(df, f"{tmp_path}/t", "ref_date")
    assert read_by_year(spark, f"{tmp_path}/t").count() == 2
    assert [r.client_id for r in read_by_year(spark, f"{tmp_path}/t", (1900, 2100)).collect()] == [1]
    with pytest.raises(ValueError, match="ref_year"):
        write_by_year(df.withColumn("ref_year", F.lit(1)), f"{tmp_path}/u", "ref_date")
