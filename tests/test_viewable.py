from pyspark.sql import functions as F
from test_provenance import INODES, change

from tidemark.operators.enrich import viewable_inodes
from tidemark.plans.provenance import with_asset
from tidemark.sources import schemas
from tidemark.streaming.viewable import ViewableBarrier

# Epoch, logical time, inode, whether the row carries the inode's present name.
ROWS = [(1, 1, 60, False), (1, 2, 99, False), (2, 3, 60, True), (3, 4, 60, False), (3, 5, 70, False), (4, 6, 60, True)]


def logged(spark, chosen):
    changes = []
    for _, clock, inode, named in chosen:
        row = list(change("CREATE", clock, inode=inode))
        row[11] = row[11] if named else "application_9_9_9"
        changes.append(tuple(row))
    rows = spark.createDataFrame(changes, schemas.struct(schemas.FILE_PROV))
    epochs = F.create_map(*[F.lit(x) for r in chosen for x in (r[1], r[0])])
    return rows.withColumn("commit_epoch", epochs[F.col("io_logical_time").cast("int")].cast("long"))


def test_viewable_does_not_depend_on_where_batches_are_cut(spark, tmp_path):
    inodes = spark.createDataFrame([(50, "application_1_2_3", 50, 60), (50, "other", 50, 70)], INODES)
    feed = logged(spark, ROWS)
    whole = {r[0] for r in viewable_inodes(with_asset(feed), inodes).collect()}
    assert whole == {60}
    barrier, released = ViewableBarrier(spark, str(tmp_path / "open"), inodes), []
    for batch_id, clocks in enumerate([[1, 2], [3], [4, 5], [6]]):
        batch = logged(spark, [r for r in ROWS if r[1] in clocks])
        closed = barrier.release(batch, batch_id)
        released.append(sorted(r["io_logical_time"] for r in closed.collect()))
    # 99 is gone; the first change of 60 waits for the row that names it, the last finds it named.
    assert released == [[], [2], [1, 3], [4]]
    assert {r[0] for r in barrier.seen().collect()} == whole
    # 70 exists, and no row has named it: its change waits until the feed ends.
    assert sorted(r["io_logical_time"] for r in barrier.remaining(feed.schema).collect()) == [5, 6]
