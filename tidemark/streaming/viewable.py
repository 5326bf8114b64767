"""Which inodes count as viewable on a stream (J11), whatever the batches are."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import viewable_inodes
from tidemark.operators.joins import keep_missing, lookup
from tidemark.plans.provenance import may_write, with_asset
from tidemark.session import materialize
from tidemark.streaming.pipeline import EpochBarrier

SEEN = re.compile(r"seen-(\d+)$")


class ViewableBarrier(EpochBarrier):
    """Also holds changes whose inode exists, but under no name seen so far.

    Any row of an inode may carry the name it is found under, in an earlier or a
    later batch. The ids found are kept, each batch writing those that are new;
    a change that waits for its inode is released with the first row that names
    it, so the documents are those of one fold over the whole log. Changes of
    inodes that are gone cannot become viewable and do not wait. A change that
    waits is neither acknowledged nor checked for problems before its release.
    """

    def __init__(self, spark: SparkSession, path: str, inodes: DataFrame):
        super().__init__(spark, path, self._waiting)
        self.inodes, self.batch_id = inodes, -1

    def seen(self, upto: int | None = None) -> DataFrame:
        """Ids found by the batches before and including `upto`, by default the last released."""
        found = [SEEN.search(n) for n in self.files.names()]
        upto = self.batch_id if upto is None else upto
        paths = [f"{self.path}/{m[0]}" for m in found if m and int(m[1]) <= upto]
        if not paths:
            return self.spark.createDataFrame([], "inode_id long")
        return self.spark.read.schema("inode_id long").parquet(*paths)

    def _flagged(self, rows: DataFrame) -> DataFrame:
        here = self.inodes.select(F.col("id").alias("inode_id")).distinct()
        rows = lookup(with_asset(rows), self.seen().withColumn("_seen", F.lit(True)), ["inode_id"])
        rows = lookup(rows, here.withColumn("_here", F.lit(True)), ["inode_id"])
        waits = F.col("_here") & F.col("_seen").isNull() & may_write()
        return rows.withColumn("_waits", F.coalesce(waits, F.lit(False)))

    def _waiting(self, closed: DataFrame) -> DataFrame:
        new = keep_missing(
            viewable_inodes(with_asset(closed), self.inodes), self.seen(self.batch_id - 1), ["inode_id"]
        )
        new.write.mode("overwrite").parquet(f"{self.path}/seen-{self.batch_id}")
        self.flagged = materialize(self._flagged(closed), "viewable")
        return self.flagged.filter("_waits").select(*closed.columns)

    def release(self, batch: DataFrame, batch_id: int) -> DataFrame:
        self.batch_id = batch_id
        closed = super().release(batch, batch_id)
        return self.flagged.filter("not _waits").select(*closed.columns)
