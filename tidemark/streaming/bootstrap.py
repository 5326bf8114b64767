"""Start of a feed from a snapshot while its live changes come in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ordering import union_feeds
from tidemark.session import configure
from tidemark.streaming.documents import STATE


class Bootstrap:
    """Rows of a snapshot and of the live feed, deferred until the snapshot has been read.

    One row per key is kept in Spark's streaming state: the live copy before
    that of the snapshot, then the one of the smallest epoch. The choice is a
    minimum, so it does not depend on how the feeds are cut into batches, on
    which of them runs ahead or on batches that are repeated; rows whose whole
    content is equal count once. `feeds` gives (snapshot, live) as streams of
    the session it is called with; both have `commit_epoch`, and columns that
    can be ordered. After the snapshot the live feed is read on without this.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: list[str],
        feeds: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
    ):
        self.path, self.key = path.rstrip("/"), key
        self.spark = configure(spark.newSession())
        for name, value in STATE.items():
            self.spark.conf.set(name, value)
        snapshot, live = feeds(self.spark)
        both = union_feeds(live.withColumn("_source", F.lit(0)), snapshot.withColumn("_source", F.lit(1)))
        self.columns = [c for c in both.columns if c != "_source"]
        rest = [c for c in self.columns if c not in key and c != "commit_epoch"]
        first = F.min(F.struct("_source", "commit_epoch", *rest)).alias("first")
        self.folded = both.groupBy(*key).agg(first)

    def follow(self, trigger: dict | None = None):
        """Start the query that defers; by default it ends with what both feeds have."""
        return (
            self.folded.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", self.path)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def rows(self) -> DataFrame:
        """What was deferred, to be handed on when the snapshot has ended."""
        fields = self.folded.schema.fields
        keys, values = StructType(fields[: len(self.key)]), StructType(fields[len(self.key) :])
        state = self.spark.read.format("statestore").load(self.path)
        # A struct's members get their names by their place.
        found = state.select(F.col("key").cast(keys), F.col("value").cast(values))
        return found.select("key.*", "value.first.*").select(*self.columns)
