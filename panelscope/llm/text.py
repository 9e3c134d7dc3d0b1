"""Column expressions shared by the text operators (JVM-side only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; empty for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` also folds other alphabets)."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once per row (a lambda variable, not an inlined copy)."""
    return F.transform(F.array(value), body)[0]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
