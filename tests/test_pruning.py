"""Pruning in a stream and the streamed bootstrap against plain loops."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.streaming.bootstrap import Bootstrap
from tidemark.streaming.pipeline import Outputs
from tidemark.streaming.pruning import PrunedBuffer, PrunedLog

LOG = "id long, commit_epoch long, text string"
PARTS = "inode_id long, namespace int, name string, inode_logical_time int, index int, value string"
COMPANION = "struct<inode_id:long,namespace:int,name:string,inode_logical_time:int,num_parts:int>"


def files(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_log_against_a_loop(spark, tmp_path):
    rng = random.Random(5)
    data = [(i, rng.randrange(60), f"t{i}") for i in range(200)]
    df = spark.createDataFrame(data, LOG)
    log = PrunedLog(spark, str(tmp_path / "log"), df.schema, ["id"], width=8)
    log.add(df)
    held = {3, 77, 120}
    left = {r[0]: r for r in data}
    by_epoch = sorted((r for r in data if r[0] not in held), key=lambda r: r[1])
    cuts = [by_epoch[i : i + 45] for i in range(0, len(by_epoch), 45)]
    for batch in [cuts[0], cuts[0], *cuts[1:], [r for r in data if r[0] == 77]]:
        log.prune(spark.createDataFrame(batch, LOG))
        for r in batch:
            left.pop(r[0], None)
        assert rows(log.rows()) == sorted(left.values(), key=repr)
        assert log.blocks() == sorted({r[1] // 8 for r in left.values()})
        assert log.low_watermark() <= min(r[1] for r in left.values())
    log.prune(spark.createDataFrame(list(left.values()), LOG))
    assert rows(log.rows()) == [] and log.low_watermark() is None


def test_log_blocks_without_acknowledgements_stay_untouched(spark, tmp_path):
    df = spark.createDataFrame([(i, i, "t") for i in range(40)], LOG)
    log = PrunedLog(spark, str(tmp_path / "log"), df.schema, ["id"], width=10)
    log.add(df)
    before = {f for f in files(tmp_path / "log") if "epoch_block=1" not in f}
    log.prune(df.filter("id = 15"))
    assert before <= files(tmp_path / "log")
    assert log.rows().count() == 39
    log.prune(df.limit(0))
    assert log.rows().count() == 39


def part(inode, time, index):
    return (inode, 0, "n", time, index, f"{inode}.{time}.{index}")


def acked(spark, keys):
    rows_ = [((i, 0, "n", t, 2) if i is not None else None,) for i, t in keys]
    return spark.createDataFrame(rows_, f"companion {COMPANION}")


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_buffer_against_a_loop(spark, tmp_path, share):
    keys = [(i, t) for i in range(6) for t in range(3)]
    parts = [part(i, t, x) for i, t in keys for x in (0, 1)]
    schema = spark.createDataFrame([], PARTS).schema
    buffer = PrunedBuffer(spark, str(tmp_path / "buffer"), schema, share)
    buffer.add(spark.createDataFrame(parts, schema), 0)
    rng = random.Random(share)
    rng.shuffle(keys)
    # Changes of an upsert without a companion, a repeated batch and parts that come later.
    batches = [(0, keys[:5]), (0, keys[:5]), (1, [*keys[5:9], (None, None)]), (2, [(99, 1)]), (3, keys[9:11])]
    left = set(parts)
    for batch_id, gone in batches:
        if batch_id == 2:
            more = [part(50, 1, 0), part(50, 1, 1)]
            buffer.add(spark.createDataFrame(more, schema), 2)
            left |= set(more)
        buffer.prune(acked(spark, gone), batch_id)
        left -= {p for p in left if (p[0], p[3]) in gone}
        assert rows(buffer.parts()) == sorted(left, key=repr)
    # The share decides whether parts were written anew; at most two generations stay.
    assert len(buffer._numbers("parts")) == {1: 0, 3: 1, 1000: 2}[share]


def test_acknowledgements_are_pruned_by_a_later_batch(spark, tmp_path):
    seen = []
    outputs = Outputs(str(tmp_path / "out"), acked=lambda df: df, prune=lambda df, n: seen.append((n, rows(df))))
    for n in (0, 0, 1, 1, 2):
        outputs.write(spark.createDataFrame([(n,)], "id long"), n)
    outputs.settle(spark, 3)
    assert seen == [(0, [(0,)]), (0, [(0,)]), (1, [(1,)]), (2, [(2,)])]


@pytest.mark.parametrize("ahead", ["snapshot", "live"])
def test_bootstrap_is_the_same_however_batches_are_cut(spark, tmp_path, ahead):
    rng = random.Random(9)
    snapshot = [(i, rng.randrange(50), "s") for i in range(60)]
    live = [(rng.randrange(40, 90), rng.randrange(50, 80), "l") for _ in range(80)] + [(None, 55, "l"), (None, 51, "l")]
    frames = {"snapshot": spark.createDataFrame(snapshot, LOG), "live": spark.createDataFrame(live, LOG)}
    for name, df in frames.items():
        df.repartition(6).write.parquet(str(tmp_path / name))

    def feed(session, name):
        source = session.readStream.schema(frames[name].schema)
        source = source.option("maxFilesPerTrigger", 5 if name == ahead else 1)
        return source.parquet(str(tmp_path / name))

    start = Bootstrap(spark, str(tmp_path / "state"), ["id"], lambda s: (feed(s, "snapshot"), feed(s, "live")))
    start.follow().awaitTermination()
    expected = ordering.bootstrap(frames["snapshot"], frames["live"], ["id"])
    assert rows(start.rows()) == rows(expected)
    best = {}
    for source, data in ((0, live), (1, snapshot)):
        for i, epoch, text in data:
            best[i] = min(best.get(i, (2, 0, "")), (source, epoch, text))
    assert rows(expected) == sorted(((i, e, x) for i, (_, e, x) in best.items()), key=repr)
    start.follow().awaitTermination()
    assert start.rows().count() == len(best)


def test_empty_log_and_buffer(spark, tmp_path):
    none = spark.createDataFrame([], LOG)
    log = PrunedLog(spark, str(tmp_path / "log"), none.schema, ["id"])
    log.add(none)
    log.prune(none)
    assert log.rows().count() == 0
    schema = spark.createDataFrame([], PARTS).schema
    buffer = PrunedBuffer(spark, str(tmp_path / "buffer"), schema)
    buffer.prune(acked(spark, [(1, 1)]), 0)
    assert buffer.parts().count() == 0
    assert buffer.parts().select(F.count(F.lit(1))).first()[0] == 0
