import random
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_fold import OPS, random_ops
from test_mutations import frame, log, tables

from tidemark.operators import fold, metrics, ordering
from tidemark.plans import mutations
from tidemark.sources import schemas
from tidemark.streaming import documents
from tidemark.streaming.documents import StreamedDocuments
from tidemark.streaming.pipeline import EpochBarrier, apply_stream, drain


def batches(df, n):
    return [df.filter(F.col("seq.epoch") % n == i) for i in range(n)]


def whole(df):
    return rows(fold.fold(df)), rows(fold.fold_entries(df))


def folded(store):
    query = store.follow()
    query.awaitTermination()
    return query


def test_streamed_state_equals_one_fold(spark, tmp_path):
    df = spark.createDataFrame(random_ops(21), OPS)
    store = StreamedDocuments(spark, str(tmp_path / "state"))
    for i, part in enumerate(batches(df, 5)):
        store.add(part, i)
        if i % 2:
            folded(store)
    store.add(batches(df, 5)[2], 2)  # a repeated batch
    folded(store)
    assert (rows(store.documents()), rows(store.entries())) == whole(df)


def test_a_batch_touches_the_keys_it_holds(spark, tmp_path):
    df = spark.createDataFrame(random_ops(22), OPS)
    store = StreamedDocuments(spark, str(tmp_path / "state"))
    store.add(df, 0)
    first = folded(store).lastProgress["stateOperators"][0]
    key = df.first()
    one = df.filter((F.col("index") == key["index"]) & (F.col("doc_id") == key["doc_id"]))
    store.add(one, 1)
    after = folded(store).lastProgress["stateOperators"][0]
    keys = fold.change_state(one).count()
    assert after["numRowsUpdated"] == keys < first["numRowsUpdated"] == first["numRowsTotal"] == after["numRowsTotal"]
    assert (rows(store.documents()), rows(store.entries())) == whole(df)


def _left(spark, name):
    """Files in Spark's local folders of a name; the last are removed in the background."""
    top = Path(spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark._jsc.sc().conf())).parent
    return {f for d in ("blockmgr-*", "spark-*") for f in top.glob(f"{d}/**/*{name}*") if f.exists()}


def _gone(spark, name, before):
    for _ in range(50):
        if _left(spark, name) <= before:
            return True
        time.sleep(0.2)
    return False


def test_a_fold_leaves_one_copy_of_the_state_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "FOLD_BYTES", 1, raising=False)
    df = spark.createDataFrame(random_ops(25), OPS)
    store = StreamedDocuments(spark, str(tmp_path / "state"))
    for i, part in enumerate(batches(df, 8)):
        store.add(part.coalesce(1), i)
    spark._jvm.System.gc()
    before = {name: _left(spark, name) for name in ("shuffle_", ".sst", "StateStoreId")}
    query = folded(store)
    assert 3 < len([p for p in query.recentProgress if p["numInputRows"]]) < 8
    # Folded operations go while others wait; shuffle files and local copies of the state go with their batch.
    assert len(list(Path(store.path, "ops").rglob("*.parquet"))) < 4
    assert all(_gone(spark, name, files) for name, files in before.items())
    assert (rows(store.documents()), rows(store.entries())) == whole(df)


def test_change_state_is_both_states(spark):
    df = spark.createDataFrame(random_ops(23), OPS)
    state = fold.change_state(df)
    assert rows(fold.documents(state.filter("entry_key is null"))) == whole(df)[0]
    assert rows(fold.entries(state.select(*fold.ENTRY_KEY, "entry").filter("entry is not null"))) == whole(df)[1]


@pytest.fixture
def feed_folder(spark, tmp_path):
    """Ops as a feed of four files, in epoch order, with one epoch across files."""
    ops = random_ops(24)
    df = spark.createDataFrame(ops, OPS).withColumn("commit_epoch", F.expr("seq.epoch div 30"))
    path = str(tmp_path / "feed")
    for i in range(4):
        df.filter(F.expr(f"seq.epoch div 100 = {i}")).coalesce(1).write.mode("append").parquet(path)
    return df, path


def stream(spark, df, path):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_with_barrier_equals_batch(spark, tmp_path, feed_folder):
    df, path = feed_folder
    released = []

    def to_ops(rows_):
        released.append(sorted(r[0] for r in rows_.select("commit_epoch").distinct().collect()))
        return rows_.drop("commit_epoch")

    table = StreamedDocuments(spark, str(tmp_path / "state"))
    barrier = EpochBarrier(spark, str(tmp_path / "open"))
    docs = drain(stream(spark, df, path), to_ops, table, str(tmp_path / "ckpt"), barrier)
    assert (rows(docs), rows(table.entries())) == whole(df.drop("commit_epoch"))
    seen = [e for batch in released for e in batch]
    assert seen == sorted(set(seen)), "an epoch is released once, whole"


def test_restart_continues_where_it_stopped(spark, tmp_path, feed_folder):
    df, path = feed_folder
    table = StreamedDocuments(spark, str(tmp_path / "state"))

    def start():
        query = apply_stream(
            stream(spark, df, path), lambda b: b.drop("commit_epoch"), table, str(tmp_path / "ckpt")
        )
        query.awaitTermination()
        return query

    first = start()
    gauges = metrics.gauges([dict(p) if isinstance(p, dict) else p for p in first.recentProgress], spark)
    assert gauges.agg(F.sum("input_rows")).first()[0] == df.count()
    folded(table)
    applied = table.last_batch()
    start()
    assert table.last_batch() == applied
    folded(table)
    assert rows(table.documents()) == whole(df.drop("commit_epoch"))[0]


def test_repeated_batch_releases_the_same_rows(spark, tmp_path):
    barrier = EpochBarrier(spark, str(tmp_path / "open"))
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id long, commit_epoch long")
    late = spark.createDataFrame([(4, 2), (5, 3)], "id long, commit_epoch long")
    assert rows(barrier.release(df, 0)) == [(1, 1), (2, 1)]
    for _ in range(2):
        assert rows(barrier.release(late, 1)) == [(3, 2), (4, 2)]
    assert rows(barrier.remaining(late.schema)) == [(5, 3)]


def test_held_rows_come_again_with_the_next_batch(spark, tmp_path):
    barrier = EpochBarrier(spark, str(tmp_path / "open"), hold=lambda df: df.filter("id = 2"))
    schema = "id long, commit_epoch long"
    assert rows(barrier.release(spark.createDataFrame([(1, 1), (2, 1), (3, 2)], schema), 0)) == [(1, 1), (2, 1)]
    assert rows(barrier.release(spark.createDataFrame([(4, 3)], schema), 1)) == [(2, 1), (3, 2)]
    assert rows(barrier.release(spark.createDataFrame([(5, 4)], schema), 2)) == [(2, 1), (4, 3)]
    assert len(barrier.files.names()) == 2


def test_a_missing_part_that_comes_one_batch_later(spark, tmp_path):
    inodes, users, groups, _, _, _ = tables(spark)
    half = [(101, 5, "half", 0, "he", 2)]
    parts = [frame(spark, schemas.XATTRS, rows_) for rows_ in (half, [*half, (101, 5, "half", 1, "y!", 2)])]
    feed = [
        [(1, 10, 101, 1, 2, 5, "half", 10, 10, 10, "b"), (2, 10, 103, 2, 0, 0, "", 1, 10, 10, "c")],
        [(3, 10, 103, 3, 0, 0, "", 1, 10, 10, "c")],
    ]

    def run(batches, name):
        state = StreamedDocuments(spark, str(tmp_path / name))
        barrier = EpochBarrier(spark, str(tmp_path / f"{name}-open"))
        for i, (rows_, xattrs) in enumerate(batches):
            barrier.hold = lambda df, x=xattrs: mutations.incomplete_xattr_changes(df, x)
            closed = barrier.release(log(spark, rows_), i)
            state.add(mutations.mutation_ops(closed, inodes, users, groups, xattrs), i)
        folded(state)
        return [(r["doc_id"], r["xattr_key"], r["xattr_raw"]) for r in state.entries().collect()]

    assert run(zip(feed, parts), "late") == [("101", "half", "hey!")]
    assert run(zip(feed, [parts[0], parts[0]]), "never") == []


def test_stream_dedup(spark, tmp_path):
    rng = random.Random(1)
    data = [(i % 20, f"2024-01-01 00:{rng.randrange(10):02d}:00") for i in range(100)]
    spark.createDataFrame(data, "id long, t string").select("id", F.to_timestamp("t").alias("t")).write.parquet(
        str(tmp_path / "in")
    )
    source = spark.readStream.schema("id long, t timestamp").parquet(str(tmp_path / "in"))
    query = (
        ordering.stream_dedup(source, ["id"], "t", "1 hour")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .option("path", str(tmp_path / "out"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
