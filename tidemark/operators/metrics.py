"""Pipeline metrics from one row per processed change.

Input columns: `bulk_id`, `flush_id`, `arrival_ms`, `start_ms`, `end_ms` (of
the bulk), `request_ms` (start of the sink request), `done_ms` (its end),
`event_type` and `asset_type` (null when the change counts for neither), and
`log_type`. Everything is a partial aggregate; no group is collected.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric names.
MEANS = [
    "avg_batching_time_milliseconds",
    "avg_waiting_time_before_processing_milliseconds",
    "avg_ndb_processing_time_milliseconds",
    "avg_elastic_bulk_req_time_milliseconds",
    "avg_elastic_batching_time_milliseconds",
    "avg_total_time_per_batch_milliseconds",
    "avg_total_time_per_event_milliseconds",
]
COUNTERS = [
    "num_processed_batches",
    "num_processed_events",
    "num_added_inodes",
    "num_added_datasets",
    "num_added_projects",
    "num_deleted_inodes",
    "num_deleted_datasets",
    "num_deleted_projects",
]
SCOPES = {"last_minute": 60_000, "last_hour": 3_600_000, "all_time": None}


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def bulk_figures() -> list[Column]:
    """Aggregates over the changes of a bulk; partial ones can be merged."""
    return [
        F.min("arrival_ms").alias("first_arrival_ms"),
        F.max("arrival_ms").alias("last_arrival_ms"),
        F.max("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.max("request_ms").alias("request_ms"),
        F.max("done_ms").alias("done_ms"),
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("done_ms") - F.col("arrival_ms")).alias("event_ms"),
        *[
            _count(
                F.col("event_type").isin(*kinds) & (F.col("asset_type") == asset)
            ).alias(f"num_{verb}_{asset}")
            for verb, kinds in (("added", ["add", "update"]), ("deleted", ["delete"]))
            for asset in ("inodes", "datasets", "projects")
        ],
    ]


def with_durations(bulk_rows: DataFrame) -> DataFrame:
    """The five durations of each bulk."""
    return bulk_rows.withColumns(
        {
            "batching_ms": F.col("last_arrival_ms") - F.col("first_arrival_ms"),
            "waiting_ms": F.col("start_ms") - F.col("last_arrival_ms"),
            "processing_ms": F.col("end_ms") - F.col("start_ms"),
            "sink_wait_ms": F.col("done_ms") - F.col("end_ms"),
            "total_ms": F.col("done_ms") - F.col("first_arrival_ms"),
        }
    )


def bulks(changes: DataFrame) -> DataFrame:
    """One row per bulk with its durations and counts."""
    flush = F.max("flush_id").alias("flush_id")
    return with_durations(changes.groupBy("bulk_id").agg(flush, *bulk_figures()))


def log_type_counts(changes: DataFrame) -> DataFrame:
    """Changes per bulk and log."""
    return changes.groupBy("bulk_id", "log_type").agg(F.count(F.lit(1)).alias("n"))


def scope_metrics(bulk_rows: DataFrame, scope: str) -> DataFrame:
    """A3-A5: counters and means of a scope, one row per scope window.

    Windows are aligned to the clock and a bulk belongs to the window in which
    its request ended. A flush is one request however many bulks it holds, so
    requests are counted once per flush.
    """
    width = SCOPES[scope]
    start = F.lit(0) if width is None else F.floor(F.col("done_ms") / width) * F.lit(width)
    rows = bulk_rows.withColumn("window_start_ms", start.cast("long"))
    requests = (
        rows.groupBy("window_start_ms", "flush_id")
        .agg((F.max("done_ms") - F.min("request_ms")).alias("request_time"))
        .groupBy("window_start_ms")
        .agg(F.avg("request_time").alias(MEANS[3]))
    )
    totals = rows.groupBy("window_start_ms").agg(
        F.count(F.lit(1)).alias("num_processed_batches"),
        F.sum("events").alias("num_processed_events"),
        *[F.sum(c).alias(c) for c in COUNTERS[2:]],
        F.avg("batching_ms").alias(MEANS[0]),
        F.avg("waiting_ms").alias(MEANS[1]),
        F.avg("processing_ms").alias(MEANS[2]),
        F.avg("sink_wait_ms").alias(MEANS[4]),
        F.avg("total_ms").alias(MEANS[5]),
        (F.sum("event_ms") / F.sum("events")).alias(MEANS[6]),
    )
    return totals.join(requests, "window_start_ms").select(
        F.lit(scope).alias("scope"), "window_start_ms", *COUNTERS, *MEANS
    )


def throughput(bulk_rows: DataFrame) -> DataFrame:
    """Events per second of every flush, from its first arrival to its end."""
    flushes = bulk_rows.groupBy("flush_id").agg(
        F.sum("events").alias("events"),
        F.count(F.lit(1)).alias("bulks"),
        (F.max("done_ms") - F.min("first_arrival_ms")).alias("total_ms"),
    )
    rate = F.col("events") * F.lit(1000.0) / F.col("total_ms")
    return flushes.withColumn("events_per_second", F.when(F.col("total_ms") > 0, rate))


def long_form(metrics: DataFrame) -> DataFrame:
    """One row per metric; a counter that never counted is left out."""
    names = COUNTERS + MEANS
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    rows = metrics.select("scope", "window_start_ms", F.explode(pairs).alias("_m")).select(
        "scope", "window_start_ms", "_m.name", "_m.value"
    )
    silent = F.col("name").isin(*COUNTERS) & (F.col("value") == 0)
    return rows.filter(F.col("value").isNotNull() & ~silent)


def general_number(value: Column) -> Column:
    """Six significant digits without trailing zeros, exponents where shorter.

    Only the finished report lines pass through here, a few per scope window.
    The function is local so that executors need no copy of this package.
    """

    def render(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda x: f"{x:g}", na_action="ignore")

    return F.pandas_udf(render, T.StringType())(value)


def text_lines(metrics: DataFrame, prefix: str) -> DataFrame:
    """A10: `prefix_name{scope="…"} value`; without a scope no braces."""
    head = F.concat(F.lit(f"{prefix}_"), F.col("name"))
    scope = F.when(F.coalesce(F.col("scope"), F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit('{scope="'), F.col("scope"), F.lit('"}'))
    )
    number = F.when(
        F.col("name").isin(*COUNTERS), F.col("value").cast("long").cast("string")
    ).otherwise(general_number(F.col("value")))
    return metrics.withColumn("line", F.concat(head, scope, F.lit(" "), number))


def gauges(progress: list[dict], spark) -> DataFrame:
    """Gauges of a streaming query from its progress reports.

    `progress` is the bounded list a query keeps (`query.recentProgress`).
    """
    rows = []
    for p in progress:
        sources = p.get("sources") or []
        backlog = sum(int((s.get("metrics") or {}).get("numFilesOutstanding", 0)) for s in sources)
        rows.append(
            (int(p["batchId"]), int(p["numInputRows"]), backlog, int(p["durationMs"].get("triggerExecution", 0)))
        )
    return spark.createDataFrame(rows, "batch_id long, input_rows long, backlog long, trigger_ms long")
