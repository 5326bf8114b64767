"""Full rebuild of the projects collection from the metadata tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import has_xattrs
from tidemark.functions.keys import PROJECTS_INDEX
from tidemark.operators import docops as D
from tidemark.operators.assemble import assemble
from tidemark.operators.enrich import (
    XATTR_ID,
    with_dataset_inode,
    with_owner_names,
    with_project_inode,
)
from tidemark.operators.joins import keep_existing, lookup
from tidemark.session import materialize


def dataset_roots(projects: DataFrame, datasets: DataFrame, inodes: DataFrame) -> DataFrame:
    """Every dataset with its project directory and its own, null where missing.

    Written once: the rebuild reads this list several times.
    """
    dirs = with_project_inode(projects, inodes)
    return materialize(with_dataset_inode(datasets, dirs, inodes), "dataset-roots")


def resolved_directories(inodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The dataset each directory lies in, for all depths; null on a cycle.

    Only directories take part. Every directory points to an ancestor; in each
    round it adopts the dataset of the directory it points to, or else that
    directory's pointer, so the distance doubles and the number of rounds is
    the logarithm of the depth. Directories outside every dataset drop out;
    those that still wait after log2(n) + 2 rounds lead to a cycle.
    """
    ids = roots.select(F.col("dataset_inode").alias("id")).distinct()
    dirs = inodes.filter(F.col("is_dir") & (F.col("partition_id") == F.col("parent_id"))).select(
        "id", F.col("parent_id").alias("up")
    )
    below = lookup(dirs, ids.withColumn("_root", F.lit(True)), ["id"])
    state = materialize(
        below.filter(F.col("_root").isNull())
        .select("id", "up", F.lit(None).cast("long").alias("root"))
        .unionByName(ids.select("id", F.col("id").alias("up"), F.col("id").alias("root"))),
        "dirs",
    )
    rounds = int(math.log2(max(state.count(), 1))) + 2
    for _ in range(rounds):
        pending = state.filter(F.col("root").isNull())
        if pending.isEmpty():
            break
        ahead = state.select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("root").alias("_root")
        )
        moved = lookup(pending.select("id", "up"), ahead, ["up"], "inner").select(
            "id", F.col("_up").alias("up"), F.col("_root").alias("root")
        )
        state = materialize(state.filter(F.col("root").isNotNull()).unionByName(moved), "dirs")
    return state.select("id", "root")


def directory_roots(inodes: DataFrame, roots: DataFrame) -> DataFrame:
    """The directories that lie in a dataset, with its inode."""
    return resolved_directories(inodes, roots).filter(F.col("root").isNotNull())


def descendants(inodes: DataFrame, roots: DataFrame, dirs: DataFrame | None = None) -> DataFrame:
    """All files and directories below the datasets, roots not included.

    One pass over the inode table: a row belongs to the dataset of the
    directory it lies in. `dirs` names the resolved directories where they are
    known already.
    """
    dirs = resolved_directories(inodes, roots) if dirs is None else dirs
    homes = dirs.filter(F.col("root").isNotNull()).select(
        F.col("id").alias("parent_id"), F.col("root").alias("dataset_id")
    )
    owners = roots.groupBy(F.col("dataset_inode").alias("dataset_id")).agg(
        F.max("projectId").alias("project_id")
    )
    homes = lookup(homes, owners, ["dataset_id"], "inner")
    placed = inodes.filter(F.col("partition_id") == F.col("parent_id"))
    return lookup(placed, homes, ["parent_id"], "inner")


def _ops(rows: DataFrame, one, step: int) -> DataFrame:
    order = F.struct(
        F.lit(0).cast("long").alias("commit_epoch"),
        F.lit(step).cast("long").alias("major"),
        F.lit(0).cast("long").alias("minor"),
        F.lit(0).cast("long").alias("tie"),
    )
    return D.explode_ops(rows, F.array(one), F.lit(PROJECTS_INDEX), order, [])


def rebuild_ops(
    projects: DataFrame,
    datasets: DataFrame,
    inodes: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    xattrs: DataFrame,
) -> DataFrame:
    """The operations that write the whole collection anew.

    Projects and datasets without a directory have no document id and are only
    counted (R6).
    """
    dirs = with_project_inode(projects, inodes).filter(F.col("project_inode").isNotNull())
    project_docs = _ops(
        dirs,
        D.op(
            D.UPSERT,
            F.col("project_inode"),
            D.project_upsert(F.col("id"), F.col("username"), F.col("projectname"), F.col("description")),
        ),
        0,
    )
    roots = dataset_roots(projects, datasets, inodes).filter(F.col("dataset_inode").isNotNull())
    dataset_docs = _ops(
        roots,
        D.op(
            D.UPSERT,
            F.col("dataset_inode"),
            D.dataset_upsert(F.col("id"), F.col("projectId"), F.col("description"), F.col("public_ds")),
        ),
        1,
    )
    below = with_owner_names(descendants(inodes, roots), users, groups)
    rows = below.select(
        F.col("id").alias("inode_id"),
        F.col("parent_id").alias("inode_parent_id"),
        F.col("partition_id").alias("inode_partition_id"),
        F.col("name").alias("inode_name"),
        F.lit(None).cast("int").alias("operation"),
        "logical_time",
        "size",
        "user",
        "group",
        "dataset_id",
        "project_id",
    )
    inode_docs = _ops(
        rows,
        D.op(
            D.UPSERT, F.col("inode_id"), D.inode_upsert(F.col("dataset_id"), F.col("project_id"))
        ),
        2,
    )
    xattr_docs = _ops(
        inode_xattrs(below, xattrs),
        D.xattr_set(F.col("inode_id"), F.col("name"), F.col("value")),
        3,
    )
    return (
        project_docs.unionByName(dataset_docs).unionByName(inode_docs).unionByName(xattr_docs)
    )


def inode_xattrs(below: DataFrame, xattrs: DataFrame) -> DataFrame:
    """Assembled xattrs of the descendants that are said to have some."""
    marked = below.filter(
        has_xattrs(F.col("num_user_xattrs"), F.col("num_sys_xattrs"))
    ).select(F.col("id").alias("inode_id"))
    return assemble(keep_existing(xattrs, marked, ["inode_id"]), XATTR_ID, counted=False)


def dataset_counts(below: DataFrame, roots: DataFrame) -> DataFrame:
    """Number of descendants per dataset, fewest first."""
    counts = below.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("inodes"))
    named = roots.select(
        F.col("dataset_inode").alias("dataset_id"), F.col("inode_name").alias("dataset_name")
    ).distinct()
    return (
        lookup(named, counts, ["dataset_id"])
        .select("dataset_id", "dataset_name", F.coalesce("inodes", F.lit(0)).alias("inodes"))
        .orderBy("inodes", "dataset_id")
    )


def totals(
    projects: DataFrame, datasets: DataFrame, inodes: DataFrame, xattrs: DataFrame
) -> DataFrame:
    """One row of totals of a rebuild.

    A dataset counts once however many rows name its directory. The directories
    and the inodes below the datasets are written once; each total is then a
    conditional sum over one of the tables.
    """
    dirs = with_project_inode(projects, inodes)
    all_roots = dataset_roots(projects, datasets, inodes)
    roots = all_roots.filter(F.col("dataset_inode").isNotNull())
    resolved = resolved_directories(inodes, roots)
    flags = has_xattrs(F.col("num_user_xattrs"), F.col("num_sys_xattrs"))
    below = descendants(inodes, roots, resolved).select("id", "num_user_xattrs", "num_sys_xattrs")
    below = materialize(below, "below")
    values = inode_xattrs(below, xattrs).groupBy("inode_id").agg(F.count(F.lit(1)).alias("_n"))
    marked = lookup(below.filter(flags).select(F.col("id").alias("inode_id")), values, ["inode_id"])

    def sums(df: DataFrame, **columns) -> DataFrame:
        return df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in columns.items()])

    one = F.lit(1)
    parts = [
        sums(dirs, projects=F.count(one), missing_projects=F.count(F.when(F.col("project_inode").isNull(), 1))),
        sums(
            all_roots,
            datasets=F.count_distinct("dataset_inode"),
            missing_datasets=F.count(F.when(F.col("dataset_inode").isNull(), 1)),
        ),
        sums(below, inodes=F.count(one)),
        sums(marked, xattrs=F.sum("_n"), missing_xattrs=F.count(F.when(F.col("_n").isNull(), 1))),
        sums(resolved, cyclic_directories=F.count(F.when(F.col("root").isNull(), 1))),
    ]
    # Five rows with one value in each column become one row.
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns]).withColumn(
        "documents",
        F.col("projects") - F.col("missing_projects") + F.col("datasets") + F.col("inodes"),
    )
