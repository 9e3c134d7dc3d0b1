"""Intermediate tables in the session's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from panelscope.session import ensure_checkpoint_dir


def shared_table(df: DataFrame) -> DataFrame:
    """``df``, written as Parquet under ``spark.checkpoint.dir`` and read back: cuts the lineage and outlives executors.

    The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
