"""Windows of a running feed against the batch report over the same changes."""

import random
from pathlib import Path

import pytest
from conftest import rows
from test_metrics import CHANGES

from tidemark.operators import metrics
from tidemark.streaming.metrics import MetricsTable, windowed_metrics

COLUMNS = ["scope", "window_start_ms", *metrics.COUNTERS, *metrics.MEANS]
END = 10_000_000


def feed(n, seed=3):
    """Changes of bulks of up to five and flushes of three bulks, in time order."""
    rng, found, clock = random.Random(seed), [], 0
    for bulk in range(n):
        clock += rng.randrange(1, 9_000)
        done = clock + 400 - clock % 400
        for _ in range(rng.randrange(1, 6)):
            kind = rng.choice([("add", "inodes"), ("delete", "datasets"), ("update", "projects"), (None, None)])
            arrival = clock - rng.randrange(0, 300)
            found.append((bulk, bulk // 3, arrival, clock + 5, clock + 9, clock + 10, done, *kind, "mutation"))
    return found


def closing(done):
    return (None, None, None, None, None, None, done, None, None, None)


def streamed(spark, path, batches, scope="last_minute", delay="1 minute"):
    (Path(path) / "changes").mkdir()
    table = MetricsTable(spark, f"{path}/state")
    schema = spark.createDataFrame([], CHANGES).schema
    windows = windowed_metrics(table.changes(f"{path}/changes", schema, 1), scope, delay)
    for batch in batches:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(f"{path}/changes")
        table.follow(windows).awaitTermination()
    return rounded(table.rows(windows.schema))


def rounded(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(df.select(COLUMNS))]


def reported(spark, changes, scope="last_minute"):
    df = spark.createDataFrame(changes, CHANGES)
    return rounded(metrics.scope_metrics(metrics.bulks(df), scope))


def test_windows_equal_the_report_however_batches_are_cut(spark, tmp_path):
    changes = feed(60)
    mixed = changes[:]
    # Disorder well within the delay.
    for i in range(0, len(mixed) - 8, 8):
        part = mixed[i : i + 8]
        random.Random(i).shuffle(part)
        mixed[i : i + 8] = part
    cut = [mixed[:37], mixed[37:38], mixed[38:], [closing(END)]]
    assert streamed(spark, str(tmp_path), cut, delay="3 minutes") == reported(spark, changes)


def test_open_windows_wait_and_late_changes_are_left_out(spark, tmp_path):
    early, later = feed(4), [(90, 30, 199_000, 199_100, 199_200, 199_300, 200_000, "add", "inodes", "admin")]
    late = [(91, 31, 900, 950, 960, 970, 1_000, "add", "inodes", "admin")]
    no_time = [(92, 32, 1, 2, 3, 4, None, "add", "inodes", "admin")]
    got = streamed(spark, str(tmp_path), [early + no_time, later, late])
    assert got == reported(spark, early)


def test_a_scope_without_an_end(spark):
    with pytest.raises(ValueError):
        windowed_metrics(spark.createDataFrame([], CHANGES), "all_time")
