import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import metrics, sink

CHANGES = (
    "bulk_id long, flush_id long, arrival_ms long, start_ms long, end_ms long, request_ms long, "
    "done_ms long, event_type string, asset_type string, log_type string"
)


def changes(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1000, 1100, 1150, 1200, 1300, "add", "inodes", "mutation"),
            (1, 1, 1040, 1100, 1150, 1200, 1300, "delete", "inodes", "mutation"),
            (2, 1, 1010, 1120, 1140, 1200, 1300, "update", "projects", "admin"),
            (3, 2, 61000, 61100, 61200, 61300, 61500, None, None, "admin"),
        ],
        CHANGES,
    )


def test_minute_scope(spark):
    got = {r["window_start_ms"]: r for r in metrics.scope_metrics(metrics.bulks(changes(spark)), "last_minute").collect()}
    first = got[0]
    assert first["num_processed_batches"] == 2 and first["num_processed_events"] == 3
    assert first["num_added_inodes"] == 1 and first["num_deleted_inodes"] == 1
    assert first["num_added_projects"] == 1
    assert first["avg_batching_time_milliseconds"] == 20
    assert first["avg_waiting_time_before_processing_milliseconds"] == 85
    assert first["avg_elastic_bulk_req_time_milliseconds"] == 100
    assert got[60000]["avg_total_time_per_event_milliseconds"] == 500


def test_throughput_and_log_types(spark):
    got = rows(metrics.throughput(metrics.bulks(changes(spark))))
    assert got == [(1, 3, 2, 300, 10.0), (2, 1, 1, 500, 2.0)]
    assert rows(metrics.log_type_counts(changes(spark))) == [
        (1, "mutation", 2),
        (2, "admin", 1),
        (3, "admin", 1),
    ]


def test_text_lines(spark):
    all_time = metrics.scope_metrics(metrics.bulks(changes(spark)), "all_time")
    lines = {r["line"] for r in metrics.text_lines(metrics.long_form(all_time), "fs").collect()}
    assert 'fs_num_processed_events{scope="all_time"} 4' in lines
    assert 'fs_avg_batching_time_milliseconds{scope="all_time"} 13.3333' in lines
    assert not any("num_deleted_projects" in line for line in lines)
    gauge = spark.createDataFrame([("", "up_seconds", 12.0)], "scope string, name string, value double")
    assert metrics.text_lines(gauge, "fs").first()["line"] == "fs_up_seconds 12"


def test_general_number_matches_printf(spark):
    rng = random.Random(2)
    numbers = [0.0, 1.0, 12.5, 99999.95, 100000.0, 123456.0, 1234567.0, 999999.5, 0.0001, 0.00001234]
    numbers += [rng.uniform(0, 1) * 10 ** rng.randrange(-6, 12) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for r in df.select("x", metrics.general_number(F.col("x")).alias("s")).collect():
        assert r["s"] == f"{r['x']:g}", r["x"]


@pytest.mark.parametrize(
    "response, success, retryable, errors",
    [
        ('{"errors": false, "items": []}', True, False, []),
        ('{"took": 1}', True, False, []),
        (sink.NOT_READY, False, True, []),
        ("{", False, False, []),
        ('{"error": "busy"}', False, False, ["busy"]),
        ('{"error": {"type": "t", "reason": "r"}}', False, False, ["t:r"]),
        (
            '{"errors": true, "items": [{"update": {"error": {"type": "t", "reason": "r"}}}, '
            '{"delete": {"status": 200}}, {"update": {"error": "plain"}}]}',
            False,
            False,
            ["t:r", "plain"],
        ),
    ],
)
def test_responses(spark, response, success, retryable, errors):
    df = spark.createDataFrame([(response,)], "response string")
    got = sink.parse_responses(df).first()
    assert (got["success"], got["retryable"], got["item_errors"]) == (success, retryable, errors)
