"""File mutations and admin operations to document operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codes import (
    FS_CHANGE_DATASET,
    FS_DELETE,
    MISSING_ID,
    XATTR_ADD,
    XATTR_ADD_ALL,
    XATTR_DELETE,
    XATTR_UPDATE,
    needs_inode,
)
from tidemark.functions.keys import MUTATION_KEY, PROJECTS_INDEX, key_string
from tidemark.functions.values import namespace
from tidemark.operators import docops as D
from tidemark.operators.assemble import assemble
from tidemark.operators.enrich import (
    XATTR_ID,
    resolve_datasets,
    with_admin_target,
    with_current_inode,
    with_owner_names,
)
from tidemark.operators.joins import keep_existing, lookup
from tidemark.session import materialize


def _order(*columns: Column) -> Column:
    epoch, major, minor, tie = columns
    return F.struct(
        epoch.cast("long").alias("commit_epoch"),
        major.cast("long").alias("major"),
        minor.cast("long").alias("minor"),
        tie.cast("long").alias("tie"),
    )


MUTATION_SEQ = ("commit_epoch", "inode_id", "logical_time", "dataset_id")


def _explode(rows: DataFrame, ops: Column, event_type: Column) -> DataFrame:
    rows = rows.withColumns(
        {
            "log_type": F.lit("mutation"),
            "log_pk": key_string(MUTATION_KEY),
            "event_type": event_type,
            "asset_type": F.lit("inodes"),
        }
    )
    order = _order(*[F.col(c) for c in MUTATION_SEQ])
    return D.explode_ops(
        rows, ops, F.lit(PROJECTS_INDEX), order, ["log_type", "log_pk", "event_type", "asset_type"]
    )


def with_named_xattrs(mutations: DataFrame, xattrs: DataFrame) -> DataFrame:
    """J6, J7 in one lookup: `xattrs`, those of the inode that the change names.

    An array of (namespace, name, value, complete): one entry or none for an add
    or update, with the value cut to its counted parts; all, with every part
    there is, for a change of all. Null for other changes. Only the parts of the
    inodes in question are assembled, and these are few per inode.
    """
    code = F.col("operation")
    one, every = code.isin(XATTR_ADD, XATTR_UPDATE), code == XATTR_ADD_ALL
    asked = mutations.filter(one | every).select("inode_id")
    parts = keep_existing(xattrs, asked, ["inode_id"])
    whole = assemble(parts, XATTR_ID, counted=False).select(*XATTR_ID, F.col("value").alias("_all"))
    counted = assemble(parts, XATTR_ID).select(*XATTR_ID, "value", "complete")
    both = counted.join(whole, XATTR_ID)
    kept = F.struct("namespace", "name", "value", "complete", "_all")
    by_inode = both.groupBy("inode_id").agg(F.array_sort(F.collect_list(kept)).alias("_xattrs"))
    # Other changes carry another key, so that they are not heaped on a null.
    joined = lookup(
        mutations.withColumn("_asks", one | every), by_inode.withColumn("_asks", F.lit(True)), ["inode_id", "_asks"]
    )
    space, name = namespace(F.col("pk2")), F.col("pk3")
    listed = F.coalesce("_xattrs", F.array().cast(joined.schema["_xattrs"].dataType))
    hit = F.filter(listed, lambda x: (x["namespace"] == space) & (x["name"] == name))
    entry = lambda x, value: F.struct(
        x["namespace"].alias("namespace"), x["name"].alias("name"), value.alias("value"), x["complete"].alias("complete")
    )
    return joined.withColumn(
        "xattrs",
        F.when(one, F.transform(hit, lambda x: entry(x, x["value"]))).when(
            every, F.transform(listed, lambda x: entry(x, x["_all"]))
        ),
    ).drop("_asks", "_xattrs")


def _waits() -> Column:
    """A change whose xattr is there in part: it waits for the rest."""
    one = F.col("operation").isin(XATTR_ADD, XATTR_UPDATE)
    return one & F.exists("xattrs", lambda x: ~x["complete"])


def mutation_ops(
    mutations: DataFrame,
    inodes: DataFrame,
    users: DataFrame,
    groups: DataFrame,
    xattrs: DataFrame,
    projects: DataFrame | None = None,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """Document operations of file mutations, in one pass over them.

    A lookup's key says whether the change needs it, so others find nothing.
    Operations outside the domain give nothing. Changes that wait for parts of
    their xattr give nothing either; `incomplete_xattr_changes` has them, and a
    stream offers them again with the next batch. Without `projects` and
    `datasets` the documents name no project or dataset.
    """
    code, doc = F.col("operation"), F.col("inode_id")
    named = projects is not None and datasets is not None

    read = needs_inode(code)
    rows = with_current_inode(mutations, inodes, read)
    rows = with_owner_names(rows, users, groups)
    if named:
        asked = mutations.filter(read).select("dataset_id")
        owner = resolve_datasets(asked, inodes, projects, datasets)
        owner = materialize(owner.select("dataset_id", "project_id"), "dataset-owners")
        rows = lookup(rows, owner, ["dataset_id"])
        body = D.inode_upsert(F.col("dataset_id"), F.coalesce("project_id", F.lit(MISSING_ID)))
    else:
        body = D.inode_upsert(F.lit(MISSING_ID), F.lit(MISSING_ID))
    rows = with_named_xattrs(rows, xattrs).filter(~F.coalesce(_waits(), F.lit(False)))

    found = F.col("inode_found")
    first = F.get("xattrs", F.lit(0))
    remove = D.xattr_remove(doc, F.col("pk3"))
    put = D.xattr_set(doc, F.col("pk3"), first["value"])
    single = (
        F.when(first.isNull(), F.array(remove))
        .when(code == XATTR_UPDATE, F.array(remove, put))
        .otherwise(F.array(put))
    )
    every = F.when(F.size("xattrs") == 0, F.array(D.xattr_clear(doc))).otherwise(
        F.transform("xattrs", lambda x: D.xattr_set(doc, x["name"], x["value"]))
    )
    ops = (
        F.when(code == FS_DELETE, F.array(D.delete_doc(doc)))
        .when(code == FS_CHANGE_DATASET, F.array(D.op(D.UPSERT, doc, D.dataset_change())))
        .when(code == XATTR_DELETE, F.array(remove))
        .when(read & found, F.array(D.op(D.UPSERT, doc, body)))
        .when(read, F.array(D.delete_doc(doc)))
        .when(code.isin(XATTR_ADD, XATTR_UPDATE), single)
        .when(code == XATTR_ADD_ALL, every)
    )
    kind = (
        F.when(code.isin(FS_DELETE, XATTR_DELETE) | (read & ~found), "delete")
        .when(code == 0, "add")
        .otherwise("update")
    )
    return _explode(rows.filter(ops.isNotNull()), ops, kind)


def incomplete_xattr_changes(mutations: DataFrame, xattrs: DataFrame) -> DataFrame:
    """Changes whose xattr is still missing parts: held for the next batch."""
    asked = mutations.filter(F.col("operation").isin(XATTR_ADD, XATTR_UPDATE))
    return with_named_xattrs(asked, xattrs).filter(_waits()).select(mutations.columns)


def admin_ops(ops: DataFrame, datasets: DataFrame, projects: DataFrame) -> DataFrame:
    """Document operations of the admin log.

    A dataset document is keyed by `dataset_id` when written and by `inode_id`
    when deleted; a project document always by `inode_id`. A write whose
    dataset or project is gone gives nothing.
    """
    rows = with_admin_target(ops, datasets, projects)
    on_dataset = F.col("op_on") == 0
    deletes = F.col("op_type") == 1
    dataset = D.dataset_upsert(
        F.col("op_id"),
        F.col("target_dataset.projectId"),
        F.col("target_dataset.description"),
        F.col("target_dataset.public_ds"),
    )
    project = D.project_upsert(
        F.col("op_id"),
        F.col("target_project.username"),
        F.col("target_project.projectname"),
        F.col("target_project.description"),
    )
    one = (
        F.when(deletes, D.delete_doc(F.col("inode_id")))
        .when(on_dataset & F.col("target_dataset").isNotNull(), D.op(D.UPSERT, F.col("dataset_id"), dataset))
        .when(~on_dataset & F.col("target_project").isNotNull(), D.op(D.UPSERT, F.col("inode_id"), project))
    )
    rows = rows.withColumns(
        {
            "log_type": F.lit("admin"),
            "log_pk": F.col("id").cast("string"),
            "event_type": F.when(deletes, "delete").when(F.col("op_type") == 0, "add").otherwise("update"),
            "asset_type": F.when(on_dataset, "datasets").otherwise("projects"),
        }
    )
    order = _order(F.col("commit_epoch"), F.lit(-1), F.col("id"), F.lit(0))
    return D.explode_ops(
        rows,
        F.filter(F.array(one), lambda o: o.isNotNull()),
        F.lit(PROJECTS_INDEX),
        order,
        ["log_type", "log_pk", "event_type", "asset_type"],
    )
