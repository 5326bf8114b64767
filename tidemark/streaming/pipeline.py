"""Change feeds applied as streams."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import union_feeds
from tidemark.session import collect_shuffles, configure
from tidemark.streaming.documents import StreamedDocuments
from tidemark.streaming.files import Files

OPEN = re.compile(r"open-(\d+)$")
ACKED = re.compile(r"batch=(\d+)$")
Rows = Callable[[DataFrame], DataFrame]


class EpochBarrier:
    """O1 on a stream: releases an epoch once a later one has been seen.

    The rows of the newest epoch are written after every batch and join the
    next one, and so do the rows that `hold` picks, which cannot be applied yet.
    What batch n keeps back depends only on batch n and the rows kept before
    it, so a repeated batch keeps and releases the same rows. The folders of
    batches that cannot be repeated are removed.
    """

    def __init__(self, spark: SparkSession, path: str, hold: Rows | None = None):
        self.spark, self.path, self.hold = spark, path.rstrip("/"), hold
        self.files = Files(spark, self.path)

    def _kept(self) -> list[int]:
        found = [OPEN.search(n) for n in self.files.names()]
        return sorted(int(m[1]) for m in found if m)

    def _before(self, batch_id: int, schema) -> DataFrame | None:
        earlier = [n for n in self._kept() if n < batch_id]
        if not earlier:
            return None
        return self.spark.read.schema(schema).parquet(f"{self.path}/open-{earlier[-1]}")

    def release(self, batch: DataFrame, batch_id: int) -> DataFrame:
        before = self._before(batch_id, batch.schema)
        rows = batch if before is None else union_feeds(batch, before)
        newest = rows.agg(F.max("commit_epoch")).scalar()
        closed = rows.filter(F.col("commit_epoch") < newest)
        kept = rows.filter(F.col("commit_epoch") == newest)
        if self.hold:
            kept = union_feeds(kept, self.hold(closed))
        kept.write.mode("overwrite").parquet(f"{self.path}/open-{batch_id}")
        for old in [n for n in self._kept() if n < batch_id][:-1]:
            self.files.remove(f"open-{old}")
        return closed

    def remaining(self, schema) -> DataFrame | None:
        """Rows still kept back, for a feed that has ended."""
        return self._before(1 << 62, schema)


@dataclass
class Outputs:
    """What a stream writes besides documents, a folder per batch.

    `problems` picks the rows that cannot be applied (X5); `acked` the keys of
    those that were. `prune` gets the acknowledgements of a batch once a later
    one runs, when no repetition can ask for the pruned rows again (X4).
    """

    path: str
    problems: Rows | None = None
    acked: Rows | None = None
    prune: Callable[[DataFrame, int], None] | None = None

    def settle(self, spark: SparkSession, before: int) -> None:
        """Prune what the last batch before this one acknowledged."""
        found = [ACKED.search(n) for n in Files(spark, f"{self.path}/acked").names()]
        last = max((int(m[1]) for m in found if m and int(m[1]) < before), default=None)
        if self.prune and last is not None:
            self.prune(spark.read.parquet(f"{self.path}/acked/batch={last}"), last)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.settle(rows.sparkSession, batch_id)
        for name in ("problems", "acked"):
            pick = getattr(self, name)
            if pick is not None:
                pick(rows).write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}").drop("batch")


def apply_stream(
    feed: DataFrame,
    to_ops: Rows,
    store: StreamedDocuments,
    checkpoint: str,
    barrier: EpochBarrier | None = None,
    outputs: Outputs | None = None,
    trigger: dict | None = None,
):
    """Start a query that adds the operations of a feed to a store of documents.

    `to_ops` is the same function the batch job uses. The checkpoint is the
    acknowledgement (X4): a batch that it does not name is added again, with the
    same result. `store.follow` is the query that folds what is added. `trigger`
    is that of the stream, by default all that is available; the source's own
    rate limit bounds a batch (O10).
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        # Streams run in a session of their own, with adaptive execution off.
        configure(batch.sparkSession)
        batch = batch.persist()
        try:
            rows = barrier.release(batch, batch_id) if barrier else batch
            store.add(to_ops(rows), batch_id)
            if outputs:
                outputs.write(rows, batch_id)
        finally:
            batch.unpersist()

    return (
        feed.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(
    feed: DataFrame,
    to_ops: Rows,
    store: StreamedDocuments,
    checkpoint: str,
    barrier: EpochBarrier | None = None,
    outputs: Outputs | None = None,
) -> DataFrame:
    """Apply everything available, close the last epoch, fold, return the documents."""
    query = apply_stream(feed, to_ops, store, checkpoint, barrier, outputs)
    query.awaitTermination()
    if barrier:
        rest = barrier.remaining(feed.schema)
        if rest is not None:
            batch_id = store.last_batch() + 1
            store.add(to_ops(rest), batch_id)
            if outputs:
                outputs.write(rest, batch_id)
    if outputs:
        outputs.settle(feed.sparkSession, store.last_batch() + 1)
    # What wrote the feed and its operations is not needed beside the fold.
    collect_shuffles(feed.sparkSession)
    store.follow().awaitTermination()
    return store.documents()
