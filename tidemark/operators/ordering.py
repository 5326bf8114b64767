"""Commit order, release of complete epochs, dedup and batching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import CORE_XATTR
from tidemark.operators.scans import commit_position, running_total

# Order of the rows of one log; the epoch always comes first.
MUTATION_ORDER = ["commit_epoch", "inode_id", "logical_time", "dataset_id"]
PROVENANCE_ORDER = [
    "commit_epoch",
    "dataset_i_id",
    "ds_logical_time",
    "phase",
    "inode_id",
    "io_logical_time",
    "tb",
]
APP_ORDER = ["commit_epoch", "id", "state", "timestamp"]
ADMIN_ORDER = ["commit_epoch", "id"]


def global_checkpoint(epoch: Column) -> Column:
    """O2: the coarse epoch kept in the upper 32 bits."""
    return F.shiftrightunsigned(epoch, 32)


def closed_epochs(feed: DataFrame, barrier: Column | None = None) -> DataFrame:
    """O1: rows whose epoch is complete, i.e. a later epoch has been seen.

    `barrier` replaces the epoch by a coarser one (O2).
    """
    level = F.col("commit_epoch") if barrier is None else barrier
    newest = feed.agg(F.max(level)).scalar()
    return feed.filter(level < newest)


def open_epoch(feed: DataFrame, barrier: Column | None = None) -> DataFrame:
    """O1: the rows held back until a later epoch is seen."""
    level = F.col("commit_epoch") if barrier is None else barrier
    newest = feed.agg(F.max(level)).scalar()
    return feed.filter(level == newest)


def provenance_phase() -> Column:
    """A store-mode change of a dataset first, its deletion last."""
    own = F.col("inode_id") == F.col("dataset_i_id")
    sets_mode = F.col("inode_operation").isin("XATTR_ADD", "XATTR_UPDATE") & (
        F.coalesce(F.col("i_xattr_name"), F.lit("")) == CORE_XATTR
    )
    return (
        F.when(own & sets_mode, 0)
        .when(own & (F.col("inode_operation") == "DELETE"), 2)
        .otherwise(1)
    )


def seq(order: list[str], op_no: Column | None = None) -> Column:
    """The order key as one comparable struct, with the op number last."""
    last = F.lit(0) if op_no is None else op_no
    return F.struct(*[F.col(c) for c in order], last.cast("int").alias("op_no"))


def in_commit_order(feed: DataFrame, order: list[str]) -> DataFrame:
    """The feed sorted on its whole order key."""
    return feed.orderBy(*order)


def positions(feed: DataFrame, order: list[str]) -> DataFrame:
    """O3-O6 with the position of every row in commit order."""
    return commit_position(feed, order)


def first_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in `order`; combined before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    picked = F.min(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(picked).select(*key, "_row.*").select(*df.columns)


def bootstrap(snapshot: DataFrame, live: DataFrame, key: list[str]) -> DataFrame:
    """Snapshot and live rows together, one per key.

    A change seen in both keeps its live copy, which was captured first.
    """
    both = union_feeds(
        live.withColumn("_source", F.lit(0)), snapshot.withColumn("_source", F.lit(1))
    )
    return first_by(both, key, ["_source", "commit_epoch"]).drop("_source")


def stream_dedup(feed: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """O7 on a stream: later copies of a key within the delay are dropped."""
    return feed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def union_feeds(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL of two feeds that share a sink."""
    return first.unionByName(second, allowMissingColumns=True)


def count_batches(positioned: DataFrame, size: int, out: str = "batch_id") -> DataFrame:
    """Rows in commit order grouped by `size`, for reports over slices of a feed.

    Flow control of a running feed is the stream's trigger and its rate limit.
    """
    return positioned.withColumn(out, F.expr(f"(position - 1) div {int(size)}"))


def byte_bundles(
    bulks: DataFrame, key: list[str], clock: str, size: str, limit: int, out: str = "bundle_id"
) -> DataFrame:
    """Whole bulks cut into bundles of about `limit` bytes.

    A bulk belongs to the bundle in which its first byte falls, counted from
    the start of the feed. The boundaries differ from resetting the count at
    every flush by less than one bulk per bundle; they do not depend on
    timing. (key, clock) must be unique.
    """
    total = running_total(bulks, key, clock, size, "_total")
    return total.withColumn(out, F.expr(f"(_total - `{size}`) div {int(limit)}")).drop(
        "_total"
    )
