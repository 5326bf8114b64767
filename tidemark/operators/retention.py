"""Pruning of applied log rows and their buffered values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.assemble import part_keys
from tidemark.operators.joins import keep_existing, keep_missing

BUFFER_PART_KEY = ["inode_id", "namespace", "name", "inode_logical_time", "index"]


def remaining_log(log: DataFrame, acked: DataFrame, key: list[str]) -> DataFrame:
    """The log without the acknowledged rows.

    Rows that are already gone are not an error, so acknowledging twice
    changes nothing.
    """
    return keep_missing(log, acked, key)


def companion_parts(acked: DataFrame) -> DataFrame:
    """K2: the buffer rows that acknowledged changes free, one per part."""
    keys = acked.filter(F.col("companion").isNotNull()).select("companion.*")
    return part_keys(keys).select(*BUFFER_PART_KEY).distinct()


def remaining_buffer(buffer: DataFrame, acked: DataFrame) -> DataFrame:
    """K2, K4: the buffer without the freed parts."""
    return keep_missing(buffer, companion_parts(acked), BUFFER_PART_KEY, grows=True)


def delete_matching(
    table: DataFrame, keys: DataFrame, on: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The table without the matching rows, and how many those are."""
    gone = keep_existing(table, keys, on).agg(F.count(F.lit(1)).alias("deleted"))
    return keep_missing(table, keys, on), gone
