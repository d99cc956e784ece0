"""Incremental ingestion and event windows with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.functions.text import text_hash


def arriving(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of ``folder`` as a stream with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def ingest(stream: DataFrame, known: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], checkpoint: str, text: str = "text") -> StreamingQuery:
    """Documents that arrive are written once per content: each batch drops texts that ``known()`` has or that stand
    earlier in it. ``write`` gets (rows, batch number) and must replace what an earlier try of the same number left."""

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("content", text_hash(F.col(text)))
        fresh = rows.groupBy("content").agg(F.min_by(F.struct(*batch.columns), "doc_id").alias("r")).select("r.*", "content")
        before = known()
        if before is not None:
            fresh = fresh.join(before.select("content").distinct(), "content", "left_anti")
        write(fresh, number)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, ts: str, width: str, *keys: Column | str, late: str | None = None) -> DataFrame:
    """Counts and sums of ``value`` per window; with ``late`` a watermark for streams."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    rows = rows.withWatermark("_ts", late) if late else rows
    out = rows.groupBy(F.window("_ts", width), *keys).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("window.start").alias("begin"), *[k for k in keys], "events", "value")


def sessions(events: DataFrame, ts: str, gap: str, key: str, late: str | None = None) -> DataFrame:
    """(key, begin, events): runs of events of a key that lie less than ``gap`` apart."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    rows = rows.withWatermark("_ts", late) if late else rows
    out = rows.groupBy(F.session_window("_ts", gap), key).agg(F.count(F.lit(1)).alias("events"))
    return out.select(key, F.col("session_window.start").alias("begin"), "events")
