"""Running totals and positions that survive a heavy group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import CHUNK
from tidemark.session import materialize


def commit_position(df: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """The feed in commit order with its 1-based position.

    Rows are range-partitioned and sorted on the whole key, so even one epoch
    or one inode with a third of the feed is cut by the later key columns. The
    number of rows in earlier partitions is the only thing that crosses them:
    one count per partition. Partition and row numbers are written with the
    rows before they are used.
    """
    placed = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    table = materialize(placed, "ordered")
    counts = sorted(
        (r["_part"], r["n"])
        for r in table.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    offsets, before = [], 0
    for part, n in counts:
        offsets.append((part, before))
        before += n
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "_part int, _before long")
    return (
        table.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_before")
    )


def running_total(
    df: DataFrame, key: list[str], clock: str, value: str, out: str, chunk: int = CHUNK
) -> DataFrame:
    """Sum of `value` over the rows of `key` up to and including this clock.

    (key, clock) must be unique. Rows of one key are cut into clock chunks,
    summed inside a chunk, and shifted by the total of the earlier chunks.
    """
    rows = df.withColumn("_b", F.expr(f"(`{clock}` - pmod(`{clock}`, {chunk})) div {chunk}"))
    inside = (
        Window.partitionBy(*key, "_b")
        .orderBy(clock)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = rows.groupBy(*key, "_b").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        *key, "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry")
    )
    return (
        rows.withColumn("_local", F.sum(value).over(inside))
        .join(carry, [*key, "_b"])
        .withColumn(out, F.col("_local") + F.col("_carry"))
        .drop("_b", "_local", "_carry")
    )
