"""Client-month data-quality flags and their monthly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.functions.cols import td
from panelscope.functions.stats import spread

FLAGS = ["flag_extreme_change", "flag_zero_employment", "flag_multi_client", "flag_filing_anomaly"]


def flag_data_quality_issues(payroll: DataFrame, extreme_threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Return (rows with five flag columns, monthly summary)."""
    cols = payroll.columns
    e = F.col("qualified_employment")
    # Client months first: a client has one row a month here, however many rows it has in the payroll.
    # Rows by employee are dealt out first, so that a task's partial sums cover a part of the client months; a client's rows stay spread.
    rows = spread(payroll.select("client_id", "ref_date", "employee_id", "qualified_employment"), "employee_id", "client_id") if "employee_id" in cols else payroll
    months = rows.groupBy("client_id", "ref_date").agg(F.sum(e).alias("_emp"))
    by_client = Window.partitionBy("client_id")
    months = months.select("client_id", "ref_date", "_emp", F.lag("_emp").over(by_client.orderBy("ref_date")).alias("_prev"),
                           F.min("ref_date").over(by_client).alias("_first_obs"))
    extreme = ((F.col("_prev") > 0) & (td(F.abs(F.col("_emp") - F.col("_prev")), F.col("_prev")) > extreme_threshold))
    months = months.select(F.col("client_id").alias("_client"), F.col("ref_date").alias("_month"), "_first_obs",
                           F.coalesce(extreme, F.lit(False)).alias("flag_extreme_change"))
    df = payroll.join(months, payroll["client_id"].eqNullSafe(months["_client"]) & payroll["ref_date"].eqNullSafe(months["_month"]), "left")
    df = df.withColumn("flag_zero_employment", e == 0)

    if "employee_id" in cols:
        # an employee has several clients in a month if the smallest and the largest differ; the rows of an employee's month are few
        multi = (spread(payroll.filter(F.col("employee_id").isNotNull()).select("ref_date", "employee_id", "client_id"), "ref_date", "employee_id")
                 .groupBy("ref_date", "employee_id").agg(F.min("client_id").alias("_low"), F.max("client_id").alias("_high"))
                 .filter(F.col("_low") < F.col("_high")).select("ref_date", "employee_id", F.lit(True).alias("_multi")))
        df = df.join(multi, ["ref_date", "employee_id"], "left") \
            .withColumn("flag_multi_client", F.coalesce("_multi", F.lit(False))).drop("_multi")
    else:
        df = df.withColumn("flag_multi_client", F.lit(False))

    if "filing_date" in cols:
        anomaly = F.col("filing_date").isNotNull() & (F.col("filing_date").cast("date") > F.col("_first_obs"))
        df = df.withColumn("flag_filing_anomaly", F.coalesce(anomaly, F.lit(False)))
    else:
        df = df.withColumn("flag_filing_anomaly", F.lit(False))

    any_flag = F.col(FLAGS[0]) | F.col(FLAGS[1]) | F.col(FLAGS[2]) | F.col(FLAGS[3])
    rows = df.withColumn("has_any_flag", any_flag).select(*cols, *FLAGS, "has_any_flag")
    return rows, flag_summary(rows)


def flag_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ref_date").agg(
        F.count_if("flag_extreme_change").alias("extreme_change_count"),
        F.count_if("flag_zero_employment").alias("zero_employment_count"),
        F.count_if("flag_multi_client").alias("multi_client_count"),
        F.count_if("flag_filing_anomaly").alias("filing_anomaly_count"),
        F.count_if("has_any_flag").alias("total_flagged"),
        F.count(F.lit(1)).alias("total_records"),
    )
