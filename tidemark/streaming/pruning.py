"""A log and its buffer that lose applied rows while a stream runs.

What batch n acknowledged is pruned with a later batch, when n cannot be
repeated any more. All steps may be done twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.operators.joins import keep_missing
from tidemark.operators.ordering import union_feeds
from tidemark.operators.retention import BUFFER_PART_KEY, companion_parts
from tidemark.session import materialize
from tidemark.streaming.files import Files

BLOCK = "epoch_block"
FOLDER = re.compile(rf"{BLOCK}=(-?\d+)$")
NUMBERED = re.compile(r"(parts|added|freed)-(\d+)$")


class PrunedLog:
    """K3, K4: a log in one folder per `width` epochs.

    Pruning reads the blocks that the acknowledged rows lie in and no other:
    those with no row left are dropped whole, the rest are written again. So
    its cost follows the batch, not the log. `key` must tell rows of a block apart.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: list[str], width: int = 64):
        self.spark, self.path, self.key, self.width = spark, path.rstrip("/"), key, width
        self.schema = StructType(list(schema)).add(BLOCK, LongType())
        self.files = Files(spark, self.path)

    def _blocked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BLOCK, F.floor(F.col("commit_epoch") / self.width).cast("long"))

    def add(self, rows: DataFrame) -> None:
        blocked = self._blocked(rows).repartitionByRange(BLOCK, *self.key)
        blocked.write.mode("append").partitionBy(BLOCK).parquet(self.path)

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._read().drop(BLOCK)

    def blocks(self) -> list[int]:
        return sorted(int(m[1]) for m in map(FOLDER.match, self.files.names()) if m)

    def low_watermark(self) -> int | None:
        """All epochs below are applied; null when nothing is left."""
        left = self.blocks()
        return left[0] * self.width if left else None

    def prune(self, acked: DataFrame) -> None:
        """Drop the acknowledged rows (`commit_epoch` and the key); those already gone are no error."""
        gone = materialize(self._blocked(acked).select(BLOCK, *self.key).distinct(), "acked")
        touched = {r[0] for r in gone.select(BLOCK).distinct().collect()} & set(self.blocks())
        if not touched:
            return
        log = self._read().filter(F.col(BLOCK).isin(sorted(touched)))
        # Written before the blocks it was read from are replaced.
        left = materialize(keep_missing(log, gone, [BLOCK, *self.key]), "open-log")
        kept = {r[0] for r in left.select(BLOCK).distinct().collect()}
        if kept:
            writer = left.repartitionByRange(BLOCK, *self.key).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(BLOCK).parquet(self.path)
        for block in touched - kept:
            self.files.remove(f"{BLOCK}={block}")


class PrunedBuffer:
    """K2: buffered parts; freed ones are noted per batch.

    The parts are written anew without them when the notes reach one in `share`
    of the parts, so that a part is copied a bounded number of times for each
    that goes. A generation counts when its folder is complete; the one before
    it stays for those who still read it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, share: int = 4):
        self.spark, self.path, self.schema, self.share = spark, path.rstrip("/"), schema, share
        self.files = Files(spark, self.path)

    def _numbers(self, kind: str) -> list[int]:
        found = [m for m in map(NUMBERED.match, self.files.names()) if m and m[1] == kind]
        numbers = sorted(int(m[2]) for m in found)
        return [n for n in numbers if "_SUCCESS" in Files(self.spark, f"{self.path}/{kind}-{n}").names()]

    def _read(self, kind: str, numbers: list[int], schema: StructType) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}-{n}" for n in numbers])

    def _since(self, kind: str, first: int) -> list[int]:
        return [n for n in self._numbers(kind) if n >= first]

    def _base(self) -> int:
        """Batches below this number are part of the newest generation."""
        return max(self._numbers("parts"), default=0)

    def _notes(self) -> DataFrame:
        fields = [self.schema[c] for c in BUFFER_PART_KEY]
        return self._read("freed", self._since("freed", self._base()), StructType(fields))

    def _stored(self) -> DataFrame:
        base = self._base()
        old = self._read("parts", [n for n in self._numbers("parts") if n == base], self.schema)
        return union_feeds(old, self._read("added", self._since("added", base), self.schema))

    def add(self, parts: DataFrame, batch_id: int) -> None:
        """Parts that came with a batch."""
        parts.write.mode("overwrite").parquet(f"{self.path}/added-{batch_id}")

    def parts(self) -> DataFrame:
        """The parts that nothing has freed."""
        return keep_missing(self._stored(), self._notes(), BUFFER_PART_KEY, grows=True)

    def prune(self, acked: DataFrame, batch_id: int) -> None:
        """Free the parts of the changes that a batch acknowledged (`companion`)."""
        companion_parts(acked).write.mode("overwrite").parquet(f"{self.path}/freed-{batch_id}")
        if self._notes().count() * self.share >= max(self._stored().count(), 1):
            self._rewrite(batch_id + 1)

    def _rewrite(self, generation: int) -> None:
        before = self._base()
        if generation <= before:
            return
        self.parts().write.mode("overwrite").parquet(f"{self.path}/parts-{generation}")
        for kind in ("parts", "added", "freed"):
            for old in [n for n in self._numbers(kind) if n < before]:
                self.files.remove(f"{kind}-{old}")
