import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelscope.functions.cols import naics2, naics3, pad6, size_class, supersector_of
from panelscope.sources.official import normalise_bed, normalise_ces, unpivot_qcew_months
from panelscope.sources.payroll import normalise_employees, normalise_payroll

ROWS = [("c1", "2019-01-12", "2019-01-01", None, True, "236220", "26", 10, 100.0),
        ("c1", "2019-02-12", "2019-01-01", None, True, "236220", "26", 12, 110.0),
        ("c2", "2019-01-12", "2019-01-01", "2019-02-12", None, "4451", "36", 700, None)]
COLS = ["client_id", "ref_date", "entry_month", "exit_month", "is_birth", "naics_code", "state_fips",
        "qualified_employment", "gross_pay"]


def test_normalise_payroll_derives_columns(spark):
    df = normalise_payroll(spark.createDataFrame(ROWS, COLS))
    assert df.columns[:8] == COLS[:8]
    assert df.columns[-5:] == ["naics2", "naics3", "supersector", "size_class", "quarter"]
    r = {(x.client_id, x.ref_date): x for x in df.collect()}
    a = r[("c1", dt.date(2019, 1, 12))]
    assert (a.naics2, a.naics3, a.supersector, a.size_class, a.quarter) == ("23", "236", "Construction", "10-19", "2019Q1")
    b = r[("c2", dt.date(2019, 1, 12))]
    assert b.naics_code == "004451" and b.supersector == "Other services" and b.size_class == "500+"
    assert df.schema["ref_date"].dataType.simpleString() == "date"


def test_missing_required_column_raises(spark):
    df = spark.createDataFrame(ROWS, COLS).drop("qualified_employment")
    with pytest.raises(ValueError, match="qualified_employment"):
        normalise_payroll(df)
    with pytest.raises(ValueError):
        normalise_employees(spark.createDataFrame([("e1", "2019-01-12")], ["employee_id", "ref_date"]))


def test_size_class_bounds(spark):
    vals = [(-3,), (0,), (4,), (5,), (9,), (10,), (49,), (99,), (100,), (499,), (500,), (None,)]
    got = [r[0] for r in spark.createDataFrame(vals, "e bigint").select(size_class("e")).collect()]
    assert got == ["1-4", "1-4", "1-4", "5-9", "5-9", "10-19", "20-49", "50-99", "100-249", "250-499", "500+", "500+"]


def test_industry_codes(spark):
    df = spark.createDataFrame([(" 311111 ",), ("4451",), ("1234567",), ("99",)], "c string")
    got = df.select(pad6("c").alias("p"), naics2("c").alias("n2"), naics3("c").alias("n3"),
                    supersector_of(naics2("c")).alias("s")).collect()
    assert [tuple(r) for r in got] == [("311111", "31", "311", "Manufacturing"),
                                       ("004451", "00", "004", "Other services"),
                                       ("1234567", "12", "123", "Other services"),
                                       ("000099", "00", "000", "Other services")]


def test_unpivot_qcew_uses_column_name_position(spark):
    df = spark.createDataFrame([("US000", "5", "23", 2024, "2", 100, 300, 7)],
                               "area_fips string, own_code string, industry_code string, year int, qtr string, "
                               "month1_emplvl bigint, month3_emplvl bigint, qtrly_estabs_count bigint")
    out = {r.ref_date: r for r in unpivot_qcew_months(df).collect()}
    assert set(out) == {dt.date(2024, 4, 12), dt.date(2024, 6, 12)}
    assert out[dt.date(2024, 6, 12)].qcew_employment == 300
    assert out[dt.date(2024, 4, 12)].quarter == "2024Q2" and out[dt.date(2024, 4, 12)].qcew_establishments == 7


def test_ces_and_bed_normalisers(spark):
    ces = spark.createDataFrame([("CES2000000001", dt.date(2020, 1, 12), 10.0), ("CEU2000000001", dt.date(2020, 1, 12), 11.0),
                                 ("CES9900000001", dt.date(2020, 1, 12), 3.0)], "series_id string, date date, value double")
    got = sorted(tuple(r) for r in normalise_ces(ces).collect())
    assert got == [(dt.date(2020, 1, 12), "99", 3.0, "SA"), (dt.date(2020, 1, 12), "Manufacturing", 10.0, "SA")]
    prefix = "BDU0000000000000"
    bed = spark.createDataFrame([(prefix + "011LQ5", dt.date(2020, 4, 1), 200.0), (prefix + "021LQ5", dt.date(2020, 4, 1), 10.0),
                                 (prefix + "031LQ5", dt.date(2020, 4, 1), 4.0), (prefix + "021LQ5", dt.date(2020, 7, 1), 5.0)],
                                "series_id string, date date, value double")
    rows = {(r.year, r.quarter): r for r in normalise_bed(bed).collect()}
    assert rows[(2020, 2)].birth_rate == pytest.approx(0.05) and rows[(2020, 2)].death_rate == pytest.approx(0.02)
    assert rows[(2020, 3)].births == 5.0 and rows[(2020, 3)].birth_rate is None  # right-only key kept


SF = "/root/testdata/sf0.001"


def test_path_readers_with_year_range(spark, tmp_path):
    from panelscope.sources import load_bed, load_ces, load_employees, load_payroll, load_qcew, synth
    from panelscope.sources.official import load_official

    def put(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    pay = load_payroll(spark, put("payroll", synth.payroll_raw(spark, SF)))
    assert pay.exceptAll(synth.payroll(spark, SF)).count() == 0 and pay.count() == synth.payroll(spark, SF).count()
    emp = load_employees(spark, put("employees", synth.employees(spark, SF)))
    assert emp.count() == synth.employees(spark, SF).count()
    raw = synth.qcew_raw(spark, SF)
    paths = {s: put(f"qcew_{s}", raw.filter(F.col("slice") == s).drop("slice")) for s in ("national", "state", "size")}
    q = load_qcew(spark, **paths, years=(1994, 1995))
    got = {r.slice: r.n for r in q.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {r.slice: 3 * r.n for r in raw.filter("year between 1994 and 1995").groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and len(want) == 3
    assert {r.quarter[-2:] for r in q.filter("slice = 'size'").select("quarter").distinct().collect()} == {"Q1"}
    assert q.filter("slice = 'size' and size_class is null").count() == 0
    assert {r.y for r in load_ces(spark, put("ces", synth.ces_raw(spark, SF)), (1996, 1996)).select(F.year("ref_date").alias("y")).distinct().collect()} == {1996}
    assert {r.year for r in load_bed(spark, put("bed", synth.bed_raw(spark, SF)), (1996, 1997)).select("year").distinct().collect()} == {1996, 1997}
    with pytest.raises(FileNotFoundError):
        load_official(spark, f"{tmp_path}/nothing")
