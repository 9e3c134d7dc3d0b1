"""Intermediate tables in the session's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from panelscope.session import ensure_checkpoint_dir


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage, and outlives the executors that wrote it. The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
