"""Incremental loads: files that arrive are upserted into a version history, each batch once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.scd2 import scd2_upsert
from cohortloom.sinks.writers import TableStore


def upsert_stream(spark: SparkSession, folder: str, schema: str, store: TableStore, checkpoint: str, key: str, tracked: Sequence[str], now: Callable[[int], Column], order: str | Sequence[str] = ()):
    """Process all files that are new since the last run and stop; ``now`` gives the batch's moment."""

    def apply(batch: DataFrame, number: int) -> None:
        store.replace(scd2_upsert(store.read(), batch, key, tracked, now(number), order).history)

    stream = spark.readStream.schema(schema).parquet(folder)
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, at: str, length: str, late: str, *keys: str) -> DataFrame:
    """Events per window and key with a watermark; works on a stream as on a table."""
    e = events.withWatermark(at, late) if events.isStreaming else events
    return e.groupBy(F.window(at, length), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")
