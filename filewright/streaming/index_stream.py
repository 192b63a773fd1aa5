"""Daily indexes as a stream (L4) and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from filewright.operators.specs import TABLES
from filewright.operators.store import Store
from filewright.sources.files import index_rows


def follow_daily_indexes(spark: SparkSession, folder: str, store: Store, checkpoint: str, once: bool = True) -> StreamingQuery:
    """New index files under ``folder`` (yyyy-MM-dd.master.idx) upsert the last update of their ids.

    A batch that is replayed after a failure writes the same rows again: the latest date of an id wins, so the upsert
    is idempotent.
    """
    lines = spark.readStream.format("text").option("pathGlobFilter", "*.master.idx").option("recursiveFileLookup", "true").load(folder)
    rows = index_rows(lines.select("value", F.col("_metadata.file_path").alias("path")))
    dated = rows.select("cik", F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})\.master\.idx", 1).alias("last_update"))

    def put(batch: DataFrame, _: int) -> None:
        spec = TABLES["cik_last_update"]
        latest = batch.union(store.read(spec)).groupBy("cik").agg(F.max("last_update").alias("last_update"))
        store.put(spec, latest)

    writer = dated.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 day", slide: str | None = None) -> DataFrame:
    """x: events and the sum of their values by type and window; late ones beyond the watermark go. Batch or stream."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """x: sessions of a user, split where nothing happens for the gap."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")
