"""Payroll and official inputs derived from the driver's TPC-H-like tables.

The driver supplies orders/lineitem/customer/supplier only. These views turn
them into the inputs the operators expect; the same recipe is written as SQL
CTEs in :mod:`panelscope.plans.oracle` for the DuckDB cross-check. Every view
is a plain Spark plan over the whole tables (nothing is sampled or capped).

Recipe (client = customer, month = order month):
* payroll: one row per (customer, order month); employment = 2 x ordered
  quantity (0 when (client + year*12 + month) % 37 = 0); pay = extended price;
  entry = first month, exit = last month when before ``EXIT_CUTOFF``; birth flag
  by client_id % 4 (0 -> unknown, 1 -> birth, else not); industry by market
  segment; state = nation key + 1.
* employees: (ship month, part = employee, supplier = client).
* QCEW: ship quarter x nation x segment, monthly employment = 10 x quantity,
  establishments = 5 x distinct suppliers; a national slice, a decoy
  non-private copy, and first-quarter rows by size class of the supplier.
* CES: monthly ship quantity by segment supersector plus 'Total private'.
* BED: quarterly customer births (first ship quarter), deaths (last ship
  quarter), establishments (customers active in the quarter).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import supersector_of
from panelscope.operators.compare import quarter_number, spells
from panelscope.sources.official import combine_qcew
from panelscope.sources.payroll import normalise_employees, normalise_payroll

# Fixed values of the derivation (must match the oracle SQL).
EXIT_CUTOFF = "2001-02-12"
ZERO_MODULUS = 37
#: Upper bounds of QCEW size codes 1 to 8; code 9 is above.
SIZE_CODE_UPPERS = (4, 9, 19, 49, 99, 249, 499, 999)
SEGMENT_NAICS = {
    "AUTOMOBILE": "336111",
    "BUILDING": "236220",
    "FURNITURE": "442110",
    "HOUSEHOLD": "621111",
    "MACHINERY": "99",
}
SEGMENT_QCEW_INDUSTRY = {
    "AUTOMOBILE": "31-33",
    "BUILDING": "23",
    "FURNITURE": "44-45",
    "HOUSEHOLD": "62",
    "MACHINERY": "81",
}
SEGMENT_CES_CODE = {
    "AUTOMOBILE": "20",
    "BUILDING": "15",
    "FURNITURE": "32",
    "HOUSEHOLD": "45",
    "MACHINERY": "55",
}


def _map(d):
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month12(ts) -> F.Column:
    return F.make_date(F.year(ts), F.month(ts), F.lit(12))


def _client_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, ref_date) sums; lineitem is pre-aggregated per order before the join."""
    li = table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("price"),
        F.count_if(F.col("l_linenumber") == 1).alias("n_first"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _month12(F.col("o_orderdate")).alias("ref_date"))
    return (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
            .groupBy("o_custkey", "ref_date")
            .agg(F.sum("qty").alias("qty"), F.sum("price").alias("price"),
                 F.sum("n_first").alias("n_first"), F.sum("n_returned").alias("n_returned")))


def payroll_raw(spark: SparkSession, sf_dir: str, with_flows: bool = False) -> DataFrame:
    cm = _client_months(spark, sf_dir)
    by_client = Window.partitionBy("o_custkey")
    first = F.min("ref_date").over(by_client)
    last = F.max("ref_date").over(by_client)
    cid = F.col("o_custkey")
    month_no = F.year("ref_date") * 12 + F.month("ref_date")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    cm = cm.select("*", first.alias("_first"), last.alias("_last"))
    j = cm.join(cust, cm.o_custkey == cust.c_custkey)
    cols = [
        cid.alias("client_id"),
        F.col("ref_date"),
        F.col("_first").alias("entry_month"),
        F.when(F.col("_last") < F.lit(EXIT_CUTOFF).cast("date"), F.col("_last")).alias("exit_month"),
        F.when(cid % 4 == 1, F.lit(True)).when(cid % 4 >= 2, F.lit(False)).alias("is_birth"),
        F.element_at(_map(SEGMENT_NAICS), F.col("c_mktsegment")).alias("naics_code"),
        F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("state_fips"),
        F.when((cid + month_no) % ZERO_MODULUS == 0, F.lit(0).cast("bigint"))
         .otherwise((F.col("qty") * 2).cast("bigint")).alias("qualified_employment"),
        F.round(F.col("price"), 2).alias("gross_pay"),
        F.date_add(F.col("_first"), (cid % 90 - 45).cast("int")).alias("filing_date"),
    ]
    if with_flows:
        cols += [F.col("n_first").alias("hires"), F.col("n_returned").alias("separations")]
    return j.select(*cols)


def payroll(spark: SparkSession, sf_dir: str, with_flows: bool = False) -> DataFrame:
    """Loaded (validated, cast, derived) client-month payroll panel."""
    return normalise_payroll(payroll_raw(spark, sf_dir, with_flows))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee-month rows: part = employee, supplier = client, ship month = ref_date."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    em = (li.groupBy(_month12(F.col("l_shipdate")).alias("ref_date"),
                     F.col("l_partkey").alias("employee_id"), F.col("l_suppkey").alias("client_id"))
          .agg(F.round(F.sum("l_extendedprice"), 2).alias("gross_pay")))
    em = em.join(sup, em.client_id == sup.s_suppkey).select(
        "employee_id", "client_id", "ref_date", "gross_pay",
        F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0").alias("state_fips"),
        F.lit(1).cast("bigint").alias("qualified_employment"),
    )
    return normalise_employees(em)


def _ship_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                                 "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(cust, F.col("o_custkey") == cust.c_custkey))


def qcew_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide quarterly QCEW-like table: state slice, national slice and a non-private decoy."""
    sl = _ship_lines(spark, sf_dir)
    pos = F.month("l_shipdate") - (F.quarter("l_shipdate") - 1) * 3
    base = sl.select(
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").cast("string").alias("qtr"),
        F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("st"),
        F.element_at(_map(SEGMENT_QCEW_INDUSTRY), F.col("c_mktsegment")).alias("industry_code"),
        pos.alias("pos"), "l_quantity", "l_suppkey", "l_extendedprice",
    )

    def month(i):
        return (F.coalesce(F.sum(F.when(F.col("pos") == i, F.col("l_quantity"))), F.lit(0.0)) * 10).cast("bigint")

    aggs = [month(1).alias("month1_emplvl"), month(2).alias("month2_emplvl"), month(3).alias("month3_emplvl"),
            (F.count_distinct("l_suppkey") * 5).cast("bigint").alias("qtrly_estabs_count"),
            F.round(F.sum("l_extendedprice"), 2).alias("total_qtrly_wages")]
    wide = ["month1_emplvl", "month2_emplvl", "month3_emplvl", "qtrly_estabs_count", "total_qtrly_wages"]

    def rows(df, area, own, agglvl, size):
        return df.select(area.alias("area_fips"), F.lit(own).alias("own_code"), "industry_code", F.lit(agglvl).alias("agglvl_code"),
                         size.alias("size_code"), "year", "qtr", *wide)

    zero, us = F.lit("0"), F.lit("US000")
    # One pass for both slices: the national rows are the grouping set without the state.
    both = base.groupingSets([["year", "qtr", "industry_code", "st"], ["year", "qtr", "industry_code"]],
                             "year", "qtr", "industry_code", "st").agg(*aggs, F.grouping("st").alias("_national"))
    state = rows(both.filter("_national = 0"), F.concat(F.col("st"), F.lit("000")), "5", "58", zero)
    national = rows(both.filter("_national = 1"), us, "5", "14", zero)
    # Size classes are published for the first quarter only; a supplier's class follows its mean monthly quantity.
    by_supplier = base.filter("qtr = '1'").groupBy("year", "qtr", "industry_code", "l_suppkey").agg(
        month(1).alias("month1_emplvl"), month(2).alias("month2_emplvl"), month(3).alias("month3_emplvl"),
        F.sum("l_quantity").alias("_q"), F.sum("l_extendedprice").alias("_pay"))
    code = F.lit("9")
    for upper, value in reversed(list(zip(SIZE_CODE_UPPERS, "12345678"))):
        code = F.when(F.col("_q") / 3 <= upper, F.lit(value)).otherwise(code)
    by_size = by_supplier.groupBy("year", "qtr", "industry_code", code.alias("_code")).agg(
        *[F.sum(c).alias(c) for c in wide[:3]], (F.count(F.lit(1)) * 5).cast("bigint").alias("qtrly_estabs_count"),
        F.round(F.sum("_pay"), 2).alias("total_qtrly_wages"))
    size = rows(by_size, us, "5", "24", F.col("_code"))
    decoy = national.withColumns({"own_code": F.lit("1"), "agglvl_code": F.lit("11"), **{c: F.col(c) * 3 for c in wide[:3]},
                                  "total_qtrly_wages": F.col("total_qtrly_wages") * 3})
    return combine_qcew(national=national.unionByName(decoy), state=state, size=size)


def ces_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly CES-like series (SA 'CES' and NSA 'CEU'), one per segment plus total private."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sl = li.join(orders, li.l_orderkey == orders.o_orderkey).join(cust, F.col("o_custkey") == cust.c_custkey)
    base = sl.select(_month12(F.col("l_shipdate")).alias("date"),
                     F.element_at(_map(SEGMENT_CES_CODE), F.col("c_mktsegment")).alias("code"), "l_quantity")
    # Segments and the total in one pass; each value stands as a seasonally adjusted and an unadjusted series.
    series = base.groupingSets([["date", "code"], ["date"]], "date", "code").agg(F.sum("l_quantity").alias("value"), F.grouping("code").alias("_all"))
    code = F.when(F.col("_all") == 1, F.lit("05")).otherwise(F.col("code"))
    kinds = F.array(F.struct(F.lit("CES").alias("kind"), F.col("value").alias("value")), F.struct(F.lit("CEU").alias("kind"), (F.col("value") * 1.02).alias("value")))
    out = series.select("date", code.alias("code"), F.explode(kinds).alias("s")).select(
        F.concat(F.col("s.kind"), F.col("code"), F.lit("00000001")).alias("series_id"), "date", "s.value")
    return out.select("series_id", "date", F.year("date").alias("year"),
                      F.concat(F.lit("M"), F.lpad(F.month("date").cast("string"), 2, "0")).alias("period"),
                      "value")


def _active_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cust, qdate): the quarters in which something was shipped to a customer."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    qdate = F.make_date(F.year("l_shipdate"), (F.quarter("l_shipdate") - 1) * 3 + 1, F.lit(1))
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(F.col("o_custkey").alias("cust"), qdate.alias("qdate")).distinct()


def official_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official life spells (cohort, duration, died): customers from their first to their last active quarter."""
    active = _active_quarters(spark, sf_dir)
    life = active.groupBy("cust").agg(quarter_number(F.min("qdate")).alias("first_q"), quarter_number(F.max("qdate")).alias("last_q"))
    return spells(life, active.agg(quarter_number(F.max("qdate"))))


def worker_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly worker flows by supersector, as a survey gives them: what is shipped is employment, first lines are hires, returned lines separations."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.element_at(_map(SEGMENT_QCEW_INDUSTRY), F.col("c_mktsegment")).alias("_ind"))
    rows = li.join(orders, li.l_orderkey == orders.o_orderkey).join(cust, F.col("o_custkey") == cust.c_custkey)
    q = F.col("l_quantity")
    of = lambda c: F.coalesce(F.sum(F.when(c, q)), F.lit(0.0)).cast("double")
    return rows.groupBy(_month12(F.col("l_shipdate")).alias("ref_date"), supersector_of(F.substring("_ind", 1, 2)).alias("supersector")).agg(
        F.sum(q).cast("double").alias("employment"), of(F.col("l_linenumber") == 1).alias("hires"), of(F.col("l_returnflag") == "R").alias("separations"))


def bed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly BED-like series: national and by segment industry, elements 01/02/03."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    active = _active_quarters(spark, sf_dir)
    by_client = Window.partitionBy("cust")  # at most one row a quarter
    rows = active.select("cust", "qdate", (F.col("qdate") == F.min("qdate").over(by_client)).cast("int").alias("b"),
                         (F.col("qdate") == F.max("qdate").over(by_client)).cast("int").alias("d"))
    seg = cust.select(F.col("c_custkey").alias("cust"), F.element_at(_map(SEGMENT_NAICS), F.col("c_mktsegment")).alias("ind"))
    counts = rows.join(seg, "cust").groupingSets([["qdate", "ind"], ["qdate"]], "qdate", "ind").agg(
        F.sum("b").alias("b"), F.sum("d").alias("d"), F.count(F.lit(1)).alias("e"), F.grouping("ind").alias("_all"))
    ind = F.when(F.col("_all") == 1, F.lit("000000")).otherwise(F.lpad(F.col("ind"), 6, "0"))
    elements = F.array(*[F.struct(F.lit(code).alias("code"), F.col(c).cast("double").alias("value")) for code, c in (("01", "e"), ("02", "b"), ("03", "d"))])
    return counts.select(F.col("qdate").alias("date"), ind.alias("ind"), F.explode(elements).alias("x")).select(
        F.concat(F.lit("BDU0000000"), F.col("ind"), F.col("x.code"), F.lit("1LQ5")).alias("series_id"), "date", "x.value")
