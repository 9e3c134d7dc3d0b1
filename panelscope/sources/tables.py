"""Panel and official tables laid out for what is done with them: partitioned by year, the panel also bucketed by client.

A year range then skips the folders of other years, and group-bys, windows and joins over a client read its rows from one bucket
without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder column of written tables.
YEAR = "ref_year"


def _with_year(df: DataFrame, date_col: str) -> DataFrame:
    if YEAR in df.columns:
        raise ValueError(f"the column {YEAR} is already there; it is to name the folders")
    year = F.col("year").cast("int") if date_col not in df.columns and "year" in df.columns else F.year(F.col(date_col).cast("date"))
    return df.withColumn(YEAR, year)


def write_by_year(df: DataFrame, path: str, date_col: str = "date") -> None:
    """Write a table under ``path``, a folder a year: that of ``date_col``, else the column ``year``.

    Rows are not shuffled; each task adds a file to the years it holds. Rows without a date go to the folder of no year, which no
    year range reads. Years already written are kept, those in ``df`` are replaced.
    """
    _with_year(df, date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)


def read_by_year(spark: SparkSession, path: str, years: tuple[int, int] | None = None) -> DataFrame:
    """A table of :func:`write_by_year` without its folder column; ``years`` (both included) lists only those folders."""
    df = spark.read.parquet(path)
    return (df if years is None else df.filter(F.col(YEAR).between(*years))).drop(YEAR)


def save_panel(payroll: DataFrame, table: str, buckets: int, path: str | None = None, key: str = "client_id", mode: str = "errorifexists") -> None:
    """Save a normalised panel as a catalog table in folders by year and ``buckets`` buckets by client, each sorted by client and month.

    The rows are shuffled once, by year and bucket, so that a bucket of a year is one file; a hot client is one bucket's file in each
    year. Choose buckets so that the files of one bucket over the years read fit a task (100 TB over 20 years: about 100,000 buckets of
    1 GB, or fewer with larger tasks). ``path`` places an external table; without it the table is in the session's warehouse.
    """
    rows = _with_year(payroll, "ref_date")
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # the bucket a row is written to
    writer = rows.repartition(YEAR, bucket).write.mode(mode).format("parquet").partitionBy(YEAR).bucketBy(buckets, key).sortBy(key, "ref_date")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def load_panel(spark: SparkSession, table: str, years: tuple[int, int] | None = None) -> DataFrame:
    """A panel of :func:`save_panel`; ``years`` (both included) reads only their folders, client by client operators do not shuffle it."""
    df = spark.table(table)
    return (df if years is None else df.filter(F.col(YEAR).between(*years))).drop(YEAR)
