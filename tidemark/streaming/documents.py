"""Documents kept in Spark's own streaming state.

Operations of a feed's batches are written to a folder, and a second query folds
them: a streaming aggregation by document and map entry, whose maxima lie in the
RocksDB state store. A batch reads and writes the keys it touches and nothing
else; the state's changelog, its snapshots and their removal are Spark's. The
documents are read from the state with Spark's state reader.

On disk the state lies once, as its compressed changelog. What waits to be folded
is taken in a few batches, so that the operations and the shuffle files of one
are gone before the next writes its own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import fold
from tidemark.session import configure
from tidemark.streaming.files import Files

STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# The keys of a document and its fields repeat much of each other, so the changelog shrinks to a half.
COMPACT = {"spark.sql.streaming.stateStore.compression.codec": "zstd"}
# Settings of the query that folds: the shuffle files of a batch go when it ends.
FOLDING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A query that ends with what is there has no use for a local copy of each partition
# once its task is over; one that goes on would load it again with every batch.
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
BATCH = re.compile(r"batch-(\d+)$")
# A batch of the fold takes a part of the operations that wait, and so many bytes at least.
FOLD_PARTS, FOLD_BYTES = 4, 32 << 20


def _session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    session = configure(spark.newSession())
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


class StreamedDocuments:
    """Documents of a feed: `add` takes the operations of a batch, `follow` folds them.

    A batch may be added again, in whole or in part: the fold is a maximum, so
    operations that come twice change nothing. Files that are folded are
    removed by the source. `groups` are those of `fold.doc_state`.
    """

    def __init__(self, spark: SparkSession, path: str, groups: list[list[str]] | None = None):
        self.path, self.groups = path.rstrip("/"), groups
        self.spark = _session(spark, STATE | COMPACT)
        self.files = Files(spark, f"{self.path}/ops")

    def last_batch(self) -> int:
        found = [BATCH.search(n) for n in self.files.names()]
        return max((int(m[1]) for m in found if m), default=-1)

    def add(self, ops: DataFrame, batch_id: int) -> None:
        none = ops.sparkSession.createDataFrame([], ops.schema)
        none.write.mode("ignore").parquet(f"{self.path}/schema")
        ops.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/ops/batch-{batch_id}")

    def _schema(self) -> StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def _checkpoint(self) -> str:
        return f"{self.path}/fold"

    def follow(self, trigger: dict | None = None):
        """Start the query that folds what is added, by default all that is there."""
        trigger = trigger or {"availableNow": True}
        ends = bool(trigger.keys() & {"availableNow", "once"})
        spark = _session(self.spark, STATE | COMPACT | FOLDING | {UNLOAD: str(ends).lower()})
        source = spark.readStream.schema(self._schema())
        source = source.option("maxBytesPerTrigger", max(FOLD_BYTES, -(-self.files.size() // FOLD_PARTS)))
        # A batch that is added again replaces its files; their rows are the same.
        source = source.option("ignoreMissingFiles", "true").option("cleanSource", "delete")
        ops = source.parquet(f"{self.path}/ops/*")
        return (
            fold.change_state(ops, self.groups)
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", self._checkpoint())
            .trigger(**trigger)
            .start()
        )

    def _state(self) -> DataFrame:
        """Keys and maxima of the state, under the names of `fold.change_state`.

        In the state all maxima have one name, in the order they were asked
        for; a cast gives a struct's members new names by their place.
        """
        fields = fold.change_state(self.spark.createDataFrame([], self._schema()), self.groups).schema.fields
        keys, values = StructType(fields[: len(fold.ENTRY_KEY)]), StructType(fields[len(fold.ENTRY_KEY) :])
        rows = self.spark.read.format("statestore").load(self._checkpoint())
        return rows.select(F.col("key").cast(keys), F.col("value").cast(values)).select("key.*", "value.*")

    def documents(self) -> DataFrame:
        """The live documents after every folded batch."""
        return fold.documents(self._state().filter("entry_key is null"))

    def entries(self) -> DataFrame:
        """Their map entries."""
        return fold.entries(self._state().select(*fold.ENTRY_KEY, "entry").filter("entry is not null"))
