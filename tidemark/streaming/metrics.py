"""Counters and means of a running feed, a row per closed window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.metrics import COUNTERS, MEANS, SCOPES, bulk_figures, with_durations
from tidemark.session import configure
from tidemark.streaming.documents import STATE

DURATIONS = ["batching_ms", "waiting_ms", "processing_ms", "sink_wait_ms", "total_ms"]


def windowed_metrics(changes: DataFrame, scope: str, delay: str = "1 minute") -> DataFrame:
    """`scope_metrics` over a stream of changes.

    Three aggregations in a row over windows of the time a bulk was done:
    changes to bulks, bulks to flushes, flushes to the window. Only sums, counts,
    minima and maxima are kept, so each is combined before its shuffle, and a
    window of many changes is one row per flush when it reaches its one key. A
    window is handed on once, when a change is seen that was done more than
    `delay` after its end; its state is dropped then, and changes that come later
    still are not counted. Changes without a done time belong to no window.
    """
    width = SCOPES[scope]
    if width is None:
        raise ValueError("a scope without an end is never closed; add up its windows instead")
    span = f"{width} milliseconds"
    timed = changes.withColumn("_done", F.timestamp_millis("done_ms")).withWatermark("_done", delay)
    bulk_rows = with_durations(
        timed.groupBy(F.window("_done", span).alias("_w"), "flush_id", "bulk_id").agg(*bulk_figures())
    )
    summed = ["events", "event_ms", *COUNTERS[2:], *DURATIONS]
    flushes = bulk_rows.groupBy(F.window(F.window_time("_w"), span).alias("_w"), "flush_id").agg(
        (F.max("done_ms") - F.min("request_ms")).alias("request_ms"),
        F.count(F.lit(1)).alias("bulks"),
        *[F.sum(c).alias(c) for c in summed],
    )
    totals = flushes.groupBy(F.window(F.window_time("_w"), span).alias("_w")).agg(
        F.avg("request_ms").alias("request_ms"),
        *[F.sum(c).alias(c) for c in ("bulks", *summed)],
    )
    per_bulk = [F.col(c) / F.col("bulks") for c in DURATIONS]
    # In the order of MEANS: three durations, the request, two more, the mean of the events.
    means = [*per_bulk[:3], F.col("request_ms"), *per_bulk[3:], F.col("event_ms") / F.col("events")]
    return totals.select(
        F.lit(scope).alias("scope"),
        F.unix_millis("_w.start").alias("window_start_ms"),
        F.col("bulks").alias(COUNTERS[0]),
        F.col("events").alias(COUNTERS[1]),
        *COUNTERS[2:],
        *[value.alias(name) for value, name in zip(means, MEANS)],
    )


class MetricsTable:
    """The closed windows of a feed, appended to a folder exactly once."""

    def __init__(self, spark, path: str):
        self.path = path.rstrip("/")
        self.spark = configure(spark.newSession())
        for name, value in STATE.items():
            self.spark.conf.set(name, value)

    def changes(self, path: str, schema: StructType, files: int) -> DataFrame:
        """A folder of changes as a stream, at most `files` files a batch."""
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)

    def follow(self, metrics: DataFrame, trigger: dict | None = None):
        """Start the query that appends; by default it ends with what the feed has."""
        return (
            metrics.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{self.path}/windows")
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def rows(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/windows")
