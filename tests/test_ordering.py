import random

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators.scans import running_total


def feed(spark, n=500, seed=1):
    rng = random.Random(seed)
    # Epoch 3 holds most of the feed, and inode 1 most of the epoch.
    data = [
        (3 if rng.random() < 0.7 else rng.randrange(8), 1 if rng.random() < 0.6 else rng.randrange(40), i, 9)
        for i in range(n)
    ]
    rng.shuffle(data)
    return data, spark.createDataFrame(
        data, "commit_epoch long, inode_id long, logical_time long, dataset_id long"
    ).repartition(5)


def test_positions_with_hot_epoch(spark):
    data, df = feed(spark)
    got = ordering.positions(df, ordering.MUTATION_ORDER).orderBy("position").collect()
    assert [tuple(r)[:4] for r in got] == sorted(data)
    assert [r["position"] for r in got] == list(range(1, len(data) + 1))


def test_count_batches(spark):
    _, df = feed(spark)
    batches = ordering.count_batches(ordering.positions(df, ordering.MUTATION_ORDER), 64)
    sizes = [r["count"] for r in batches.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [64] * 7 + [52]


def test_barrier_releases_complete_epochs(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id long, commit_epoch long")
    assert rows(ordering.closed_epochs(df)) == [(1, 1)]
    assert rows(ordering.open_epoch(df)) == [(2, 2), (3, 2)]
    wide = spark.createDataFrame([(1, 1 << 32), (2, (1 << 32) + 5), (3, 2 << 32)], "id long, commit_epoch long")
    level = ordering.global_checkpoint(F.col("commit_epoch"))
    assert [r[0] for r in rows(ordering.closed_epochs(wide, level))] == [1, 2]


def test_bootstrap_keeps_live_copy(spark):
    snapshot = spark.createDataFrame([(1, 10, "s"), (2, 10, "s")], "id long, commit_epoch long, who string")
    live = spark.createDataFrame([(2, 10, "l"), (3, 11, "l")], "id long, commit_epoch long, who string")
    assert rows(ordering.bootstrap(snapshot, live, ["id"])) == [(1, 10, "s"), (2, 10, "l"), (3, 11, "l")]


def test_first_by_with_many_copies(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "a")] * 50 + [(2, 1, "c")], "k long, o long, v string")
    assert rows(ordering.first_by(df, ["k"], ["o"])) == [(1, 4, "a"), (2, 1, "c")]


def test_running_total_over_chunks(spark):
    data = [("hot", i, i % 7) for i in range(300)] + [("cold", 5, 2), ("cold", 250, 3)]
    df = spark.createDataFrame(data, "k string, t long, v long")
    got = {(r["k"], r["t"]): r["total"] for r in running_total(df, ["k"], "t", "v", "total", chunk=16).collect()}
    total = 0
    for k, t, v in data[:300]:
        total += v
        assert got[(k, t)] == total
    assert got[("cold", 5)] == 2 and got[("cold", 250)] == 5


def test_byte_bundles(spark):
    df = spark.createDataFrame([("p", i, 40) for i in range(10)], "index string, bulk long, bytes long")
    got = ordering.byte_bundles(df, ["index"], "bulk", "bytes", 100).orderBy("bulk").collect()
    assert [r["bundle_id"] for r in got] == [0, 0, 0, 1, 1, 2, 2, 2, 3, 3]


def test_provenance_phase_orders_mode_change_first_and_delete_last(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 1, "DELETE", "", 5, 1, "a"),
            (1, 7, 1, "CREATE", "", 5, 2, "b"),
            (1, 1, 1, "XATTR_ADD", "core", 5, 3, "c"),
        ],
        "commit_epoch long, inode_id long, dataset_i_id long, inode_operation string, "
        "i_xattr_name string, ds_logical_time long, io_logical_time long, tb string",
    ).withColumn("phase", ordering.provenance_phase())
    got = ordering.in_commit_order(df, ordering.PROVENANCE_ORDER).collect()
    assert [r["tb"] for r in got] == ["c", "b", "a"]
