"""How the tasks, files and batches of the queries grow with their input."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from tidemark import queries
from tidemark.bindings import Tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def test_a_larger_feed_has_more_files_and_still_two_batches(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_A_FILE", 50)
    feed = spark.range(1000).withColumnRenamed("id", "commit_epoch")
    stream, folder = queries._stream(Tables(spark, DATA), feed, ["commit_epoch"])
    assert len(list(Path(folder, "feed").glob("*.parquet"))) == 20
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True)
    query = query.start()
    query.awaitTermination()
    taken = [p["numInputRows"] for p in query.recentProgress]
    assert sum(taken) == 1000 and len([n for n in taken if n]) == 2


@pytest.mark.parametrize("name", ["provenance_inodes", "xattr_buffer"])
def test_tables_read_several_times_are_derived_once(spark, name):
    files = getattr(Tables(spark, DATA), name).inputFiles()
    assert files and not any(DATA in f for f in files)


class Stop(Exception):
    pass


def test_a_batch_of_metrics_takes_a_slice_of_any_number_of_files(spark, monkeypatch):
    taken = []

    class Table(queries.MetricsTable):
        def changes(self, path, schema, files):
            taken.extend([files, len(list(Path(path).glob("*.parquet")))])
            raise Stop

    monkeypatch.setattr(queries, "MetricsTable", Table)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 20)
    try:
        with pytest.raises(Stop):
            queries.stream_metrics(Tables(spark, DATA))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert taken[0] == taken[1] // 4 > 2


def test_blocks_of_a_long_log_stay_few(spark, monkeypatch):
    widths = []

    def opened(spark, path, schema, key, width=64):
        widths.append(width)
        raise Stop

    monkeypatch.setattr(queries, "PrunedLog", opened)
    log = spark.range(100_000).withColumnRenamed("id", "commit_epoch")
    with pytest.raises(Stop):
        queries.stream_retention_log(SimpleNamespace(spark=spark, provenance=log))
    assert 100_000 / widths[0] < 130
