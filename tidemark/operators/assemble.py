"""Values split over several rows (A1, A2, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(parts: DataFrame, key: list[str], counted: bool = True) -> DataFrame:
    """A1: one row per key with the value of its parts in index order.

    The part with the lowest index says how many parts count: parts beyond it
    are cut off, and a value with fewer is flagged `complete = false`. Copies of a
    part are merged before and after the shuffle; of different rows of one
    index the one with the largest count and value stands. An index is a
    16-bit number, so a value has at most 32,768 parts. With `counted` off all
    parts present are taken, as in a consistent read of one inode.
    """
    listed = parts.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.struct("index", "num_parts", "value"))).alias("_all")
    )
    alone = F.filter(
        "_all", lambda p, i: F.coalesce(F.get("_all", i + 1)["index"] != p["index"], F.lit(True))
    )
    listed = listed.select(*key, alone.alias("_parts"))
    wanted = F.col("_parts")[0]["num_parts"].cast("int")
    kept = F.filter("_parts", lambda p: p["index"] < wanted) if counted else F.col("_parts")
    values = F.transform(kept, lambda p: p["value"])
    return listed.select(
        *key,
        F.array_join(values, "", "").alias("value"),
        wanted.alias("num_parts"),
        ((F.size(kept) == wanted) if counted else F.lit(True)).alias("complete"),
    )


def assemble_strict(parts: DataFrame, key: list[str]) -> DataFrame:
    """A2: like A1, but a value with a missing part is null."""
    whole = assemble(parts, key)
    return whole.withColumn("value", F.when(F.col("complete"), F.col("value")))


def part_keys(keys: DataFrame, count: str = "num_parts") -> DataFrame:
    """K2: every key once per part, with the part index."""
    counted = keys.filter(F.col(count) > 0)
    indexes = F.sequence(F.lit(0), F.col(count).cast("int") - 1)
    return counted.withColumn("index", F.explode(indexes.cast("array<short>")))
