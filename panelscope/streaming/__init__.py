"""Incremental panel refresh with Structured Streaming.

The analyses themselves are batch (the payroll extract is a bounded table). What a Spark deployment does incrementally is fold each new payroll
drop into the multi-level panel. A drop may hold part of a month, or rows of months that are there already: distinct clients of two parts cannot
be added, so each drop is kept as mergeable state, one row for each (month, cell, client) with the sums of the panel's measures. The panel of
the months that a drop touches is made anew from the state of all drops; other months are not read.

State and panel are partitioned by month. A drop has a state folder of its own, which a replay of the drop overwrites, and a month of the panel is
overwritten as a whole, so a restarted job gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelscope.operators.panel import KEY_COLUMNS, PANEL_MEASURES, level_names, panel_measures
from panelscope.sources.payroll import normalise_payroll

ADDED = [m for m in PANEL_MEASURES if m != "client_count"]


def client_state(payroll: DataFrame, match: str = "date") -> DataFrame:
    """(ref_date, quarter, cell, client_id, present, added measures): what two drops can be merged from.

    ``present`` tells whether the client has employment in the cell.
    """
    measures = dict(zip(PANEL_MEASURES, panel_measures(match)))
    return payroll.groupBy("ref_date", "quarter", *KEY_COLUMNS, "client_id").agg(
        F.coalesce(F.max(F.col("qualified_employment") > 0), F.lit(False)).alias("present"), *[measures[m].alias(m) for m in ADDED])


def panel_of_state(state: DataFrame) -> DataFrame:
    """The panel of all levels from the state of any number of drops; a client counts once in a cell, whatever drops it is in."""
    sets, level = level_names()
    sums = {m: F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in ADDED}
    clients = F.count_distinct(F.when(F.col("present"), F.col("client_id"))).alias("client_count")
    agg = state.groupingSets(sets, "ref_date", "quarter", *KEY_COLUMNS).agg(*[sums.get(m, clients) for m in PANEL_MEASURES], F.grouping_id().alias("_gid"))
    return agg.select(level.alias("grouping_level"), "ref_date", "quarter", *KEY_COLUMNS, *PANEL_MEASURES)


def _month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("ref_date", "'m'yyyy-MM"))


def fold_drop(drop: DataFrame, epoch: int, panel_path: str, state_path: str) -> None:
    """Keep a drop's state as that of ``epoch``, and write the panel of its months anew."""
    spark = drop.sparkSession
    # month folders that an earlier try of the drop wrote go with the overwritten folder
    _month(client_state(normalise_payroll(drop))).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(f"{state_path}/epoch={epoch}")
    mine = spark.read.parquet(f"{state_path}/epoch={epoch}")
    months = [r[0] for r in mine.select("month").distinct().collect()]  # bounded by the calendar
    if not months:
        return
    state = spark.read.option("basePath", state_path).parquet(state_path).where(F.col("month").isin(months))
    _month(panel_of_state(state)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(panel_path)


def start_panel_refresh(spark: SparkSession, source_dir: str, schema, panel_path: str, checkpoint: str,
                        trigger_once: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Watch ``source_dir`` for payroll parquet files and keep the panel at ``panel_path`` (a folder for each ``month``).

    The drops' state is at ``panel_path`` + ``-state``. A month may be split over files and files may come late. Progress is tracked in ``checkpoint``, so a
    restarted job resumes without reprocessing files. ``max_files`` bounds the files of a drop.
    """
    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(source_dir)

    def fold(batch: DataFrame, epoch: int) -> None:
        fold_drop(batch, epoch, panel_path, f"{panel_path}-state")

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()
