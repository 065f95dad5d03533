"""Streaming ingestion of raw events: watermarks, duplicates, windowed counts and upserts by micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import item_key
from ..sources.sinks import Table

RAW = "source_id string, source_url string, item_url string, title_raw string, datetime_raw string, location_raw string, description_raw string, extra string, fetched_at timestamp"


def raw_stream(spark: SparkSession, path: str, schema: str = RAW) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def first_seen(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Each item once within the watermark; state is dropped when its time has passed."""
    key = item_key(F.col("item_url"), F.col("source_id"), F.col("title_raw"), F.col("datetime_raw"))
    return events.withColumn("item_key", key).withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["source_id", "item_key"])


def counts(events: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows by source and window; a window is emitted once the watermark has passed it."""
    w = F.window("fetched_at", window)
    return events.withWatermark("fetched_at", late).groupBy(w, "source_id").agg(F.count(F.lit(1)).alias("rows")).select(F.col("window.start").alias("start"), "source_id", "rows")


def upsert_stream(events: DataFrame, table: Table, keys: list[str], newest: list[Column], checkpoint: str):
    """Starts a query that upserts each micro-batch; a batch that is run again gives the same table.

    Rows with a null key go to a folder of their batch beside the table, which a repeated batch replaces.
    """
    bad = F.lit(False)
    for k in keys:
        bad |= F.col(k).isNull()

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        lost = held.filter(bad)
        if not lost.isEmpty():
            lost.write.mode("overwrite").json(f"{table.path}-quarantine/batch={number}")
        table.upsert(held.filter(~bad), keys, newest)
        held.unpersist()

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
