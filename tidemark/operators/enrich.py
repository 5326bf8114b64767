"""Enrichment of changes with current metadata rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import FEATURE_SUFFIX
from tidemark.functions.codes import CORE_XATTR, MISSING_ID, MISSING_NAME, USER_NAMESPACE
from tidemark.functions.values import store_mode
from tidemark.operators.assemble import assemble, assemble_strict
from tidemark.operators.joins import as_of, keep_existing, lookup, unique_match
from tidemark.session import materialize

ROOT_PARENT = 1
PROJECTS_DIR = "Projects"


def projects_inode(inodes: DataFrame) -> DataFrame:
    """Id of the directory that holds the projects; one row."""
    found = inodes.filter((F.col("parent_id") == ROOT_PARENT) & (F.col("name") == PROJECTS_DIR))
    return found.agg(F.max("id").alias("projects_id"))


def with_current_inode(
    mutations: DataFrame, inodes: DataFrame, needed: Column | None = None
) -> DataFrame:
    """The current row of the mutated inode.

    Looked up by (parent, name, partition); a row of another inode that now
    carries that name does not count. `inode_found` tells a miss. Rows for
    which `needed` is false keep their key and find nothing.
    """
    needed = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    current = inodes.select(
        F.col("parent_id").alias("inode_parent_id"),
        F.col("name").alias("inode_name"),
        F.col("partition_id").alias("inode_partition_id"),
        F.lit(True).alias("_needed"),
        F.col("id").alias("_found_id"),
        "size",
        "user_id",
        "group_id",
    )
    key = ["inode_parent_id", "inode_name", "inode_partition_id", "_needed"]
    joined = lookup(mutations.withColumn("_needed", needed), current, key)
    found = F.coalesce(F.col("_found_id") == F.col("inode_id"), F.lit(False))
    hit = {c: F.when(F.col("inode_found"), F.col(c)) for c in ("size", "user_id", "group_id")}
    return joined.withColumn("inode_found", found).withColumns(hit).drop("_found_id", "_needed")


def with_owner_names(
    rows: DataFrame, users: DataFrame, groups: DataFrame, user="user", group="group"
) -> DataFrame:
    """Names of owner and group, "-1" where unknown."""
    user_names = users.select(F.col("id").alias("user_id"), F.col("name").alias(user))
    group_names = groups.select(F.col("id").alias("group_id"), F.col("name").alias(group))
    named = lookup(lookup(rows, user_names, ["user_id"]), group_names, ["group_id"])
    return named.withColumns(
        {c: F.coalesce(F.col(c), F.lit(MISSING_NAME)) for c in (user, group)}
    )


def resolve_datasets(
    dataset_ids: DataFrame, inodes: DataFrame, projects: DataFrame, datasets: DataFrame
) -> DataFrame:
    """Project of every dataset inode in `dataset_ids(dataset_id)`.

    By path: the parent of the dataset inode must be a child of the projects
    directory, and its name is the project's. Feature stores lie elsewhere:
    there the unique dataset of that name gives the project, which must have
    its directory. Columns fall back to -1 / "-1". The distinct ids are written
    first, so that the size of every lookup on them is known.
    """
    ids = materialize(dataset_ids.select("dataset_id").distinct(), "dataset-ids")
    root = projects_inode(inodes)
    slim = inodes.select("id", "parent_id", "name", "partition_id")
    own = unique_match(
        keep_existing(slim, ids.withColumnRenamed("dataset_id", "id"), ["id"]), ["id"]
    ).select(
        F.col("id").alias("dataset_id"),
        F.col("parent_id").alias("_parent"),
        F.col("name").alias("dataset_name"),
    )
    project_dirs = (
        lookup(slim, root.withColumnRenamed("projects_id", "parent_id"), ["parent_id"], "inner")
        .select("id", "name", "partition_id", "parent_id")
    )
    named_projects = unique_match(
        projects.select(F.col("projectname").alias("name"), F.col("id").alias("project_id")),
        ["name"],
    )
    by_path = unique_match(project_dirs, ["id"]).select(
        F.col("id").alias("_parent"), F.col("name").alias("_path_project")
    )
    by_path = lookup(
        by_path,
        named_projects.select(
            F.col("name").alias("_path_project"), F.col("project_id").alias("_path_id")
        ),
        ["_path_project"],
    )
    # A project directory is looked up by its full key, where partition = parent.
    keyed_dirs = project_dirs.filter(F.col("partition_id") == F.col("parent_id")).select("name")
    stores = unique_match(
        datasets.filter(F.col("inode_name").endswith(FEATURE_SUFFIX)).select(
            F.col("inode_name").alias("dataset_name"), F.col("projectId").alias("id")
        ),
        ["dataset_name"],
    )
    stores = lookup(stores, projects.select("id", F.col("projectname").alias("name")), ["id"], "inner")
    stores = keep_existing(stores, keyed_dirs, ["name"]).select(
        "dataset_name",
        F.col("id").alias("_store_id"),
        F.col("name").alias("_store_project"),
    )
    # Only feature stores are looked up by name, which many datasets share.
    store_rows = lookup(
        own.filter(F.col("dataset_name").endswith(FEATURE_SUFFIX)), stores, ["dataset_name"], "inner"
    ).select("dataset_id", "_store_id", "_store_project")
    resolved = lookup(lookup(ids, own, ["dataset_id"]), by_path, ["_parent"])
    resolved = lookup(resolved, store_rows, ["dataset_id"])
    is_store = F.coalesce(F.col("dataset_name").endswith(FEATURE_SUFFIX), F.lit(False))
    return resolved.select(
        "dataset_id",
        F.coalesce("dataset_name", F.lit(MISSING_NAME)).alias("dataset_name"),
        F.coalesce(
            F.when(is_store, F.col("_store_id")).otherwise(F.col("_path_id")), F.lit(MISSING_ID)
        ).alias("project_id"),
        F.coalesce(
            F.when(is_store, F.col("_store_project")).otherwise(F.col("_path_project")),
            F.lit(MISSING_NAME),
        ).alias("project_name"),
    )


XATTR_ID = ["inode_id", "namespace", "name"]


def xattrs_of(mutations: DataFrame, xattrs: DataFrame) -> DataFrame:
    """The xattr parts of the inodes that changed; only these are assembled."""
    return keep_existing(xattrs, mutations, ["inode_id"])


def with_current_xattr(mutations: DataFrame, xattrs: DataFrame) -> DataFrame:
    """The assembled xattr a mutation names; `xattr_found` tells a miss.

    A value whose parts are not all there yet counts as incomplete, not as
    removed: `xattr_complete` is false and the caller keeps the change back.
    """
    named = xattrs_of(mutations, xattrs)
    values = assemble(named, XATTR_ID).select(
        "inode_id",
        F.col("namespace").alias("xattr_namespace"),
        F.col("name").alias("xattr_name"),
        F.col("value").alias("xattr_value"),
        F.col("complete").alias("xattr_complete"),
    )
    joined = lookup(mutations, values, ["inode_id", "xattr_namespace", "xattr_name"])
    return joined.withColumn("xattr_found", F.col("xattr_complete").isNotNull())


def xattrs_of_inode(xattrs: DataFrame) -> DataFrame:
    """All assembled xattrs of an inode as one array.

    An inode counts its xattrs in two signed bytes, so the array is bounded.
    """
    values = assemble(xattrs, XATTR_ID, counted=False)
    return values.groupBy("inode_id").agg(
        F.array_sort(F.collect_list(F.struct("namespace", "name", "value"))).alias("xattrs")
    )


def with_all_xattrs(mutations: DataFrame, xattrs: DataFrame) -> DataFrame:
    """Every xattr of the inode, one row each; none gives one row without."""
    joined = lookup(mutations, xattrs_of_inode(xattrs_of(mutations, xattrs)), ["inode_id"])
    return joined.select(*mutations.columns, F.posexplode_outer("xattrs").alias("xattr_no", "_x")).select(
        *mutations.columns,
        "xattr_no",
        F.col("_x.namespace").alias("xattr_namespace"),
        F.col("_x.name").alias("xattr_name"),
        F.col("_x.value").alias("xattr_value"),
    )


BUFFER_ID = ["inode_id", "namespace", "name", "inode_logical_time"]


def store_mode_versions(buffer: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Assembled store-mode values of datasets, parsed.

    With `datasets(dataset_i_id)` only theirs are assembled.
    """
    core = buffer.filter((F.col("namespace") == USER_NAMESPACE) & (F.col("name") == CORE_XATTR))
    if datasets is not None:
        wanted = datasets.select(F.col("dataset_i_id").alias("inode_id"))
        core = keep_existing(core, wanted, ["inode_id"])
    whole = assemble_strict(core, BUFFER_ID)
    return whole.select(
        F.col("inode_id").alias("dataset_i_id"),
        F.col("inode_logical_time").alias("core_time"),
        F.col("num_parts").alias("core_parts"),
        F.col("value").alias("core_value"),
        store_mode(F.col("value")).alias("_core"),
    ).select(
        "dataset_i_id",
        "core_time",
        "core_parts",
        "core_value",
        F.col("_core.mode").alias("core_mode"),
        F.col("_core.project_iid").alias("core_project"),
    )


def with_store_mode(
    rows: DataFrame, buffer: DataFrame, points_of: DataFrame | None = None
) -> DataFrame:
    """The store mode of the dataset at the dataset's clock of the row.

    `core_time` is null when the dataset has no version yet.
    """
    return as_of(
        rows,
        store_mode_versions(buffer, rows if points_of is None else points_of),
        ["dataset_i_id"],
        "ds_logical_time",
        "core_time",
        points_of=points_of,
    )


def with_buffered_xattr(rows: DataFrame, buffer: DataFrame) -> DataFrame:
    """The value an xattr change wrote, null unless all parts are there."""
    buffered = keep_existing(buffer.filter(F.col("namespace") == USER_NAMESPACE), rows, ["inode_id"])
    values = assemble_strict(buffered, BUFFER_ID).select(
        "inode_id",
        F.col("name").alias("i_xattr_name"),
        F.col("inode_logical_time").alias("io_logical_time"),
        F.when(F.col("complete"), F.col("num_parts")).alias("buffer_parts"),
        F.col("value").alias("buffer_value"),
    )
    joined = lookup(rows, values, ["inode_id", "i_xattr_name", "io_logical_time"])
    same = F.col("buffer_parts") == F.col("i_xattr_num_parts")
    return joined.withColumn("buffer_value", F.when(same, F.col("buffer_value"))).drop("buffer_parts")


def existing_projects(inodes: DataFrame, ids: DataFrame) -> DataFrame:
    """(project id, its inode name) of the given ids that have one inode."""
    wanted = ids.select(F.col("project").alias("id")).distinct()
    rows = keep_existing(inodes.select("id", "name"), wanted, ["id"])
    return unique_match(rows, ["id"]).select(
        F.col("id").alias("project"), F.col("name").alias("project_inode_name")
    )


def viewable_inodes(rows: DataFrame, inodes: DataFrame) -> DataFrame:
    """Ids of the inodes found under the names the rows carry."""
    keys = rows.filter(F.col("ml_type") != "NONE").select(
        F.col("parent_i_id").alias("parent_id"),
        F.col("i_name").alias("name"),
        F.col("i_partition_id").alias("partition_id"),
    )
    found = keep_existing(inodes, keys, ["parent_id", "name", "partition_id"])
    return found.select(F.col("id").alias("inode_id")).distinct()


def repair_project(rows: DataFrame) -> DataFrame:
    """Take project id and name from the store mode where there is one.

    Needs the columns of J8 and `core_project_name`, the inode name of the
    store mode's project (null when that project does not exist).
    """
    known = F.col("core_time").isNotNull()
    unknown_before = F.col("project_i_id") == MISSING_ID
    return rows.withColumns(
        {
            "project_name": F.when(
                known & unknown_before & F.col("core_project_name").isNotNull(),
                F.col("core_project_name"),
            ).otherwise(F.col("project_name")),
            "project_i_id": F.when(known, F.col("core_project")).otherwise(F.col("project_i_id")),
        }
    )


def with_admin_target(ops: DataFrame, datasets: DataFrame, projects: DataFrame) -> DataFrame:
    """The dataset or project an admin operation is about."""
    of_dataset = datasets.select(
        F.col("id").alias("op_id"),
        F.lit(0).cast("byte").alias("op_on"),
        F.struct("projectId", "description", "public_ds").alias("target_dataset"),
    )
    of_project = projects.select(
        F.col("id").alias("op_id"),
        F.lit(1).cast("byte").alias("op_on"),
        F.struct("projectname", "username", "description").alias("target_project"),
    )
    targets = of_dataset.unionByName(of_project, allowMissingColumns=True)
    return lookup(ops, targets, ["op_id", "op_on"])


def with_project_inode(projects: DataFrame, inodes: DataFrame) -> DataFrame:
    """Directory of every project, found by (projects directory, name)."""
    root = projects_inode(inodes)
    dirs = lookup(
        inodes.filter(F.col("parent_id") == F.col("partition_id")).select("parent_id", "name", "id"),
        root.withColumnRenamed("projects_id", "parent_id"),
        ["parent_id"],
        "inner",
    ).select(F.col("name").alias("projectname"), F.col("id").alias("project_inode"))
    return lookup(projects, dirs, ["projectname"])


def with_dataset_inode(datasets: DataFrame, project_dirs: DataFrame, inodes: DataFrame) -> DataFrame:
    """Directory of every dataset, found by (project directory, name)."""
    owned = lookup(
        datasets, project_dirs.select(F.col("id").alias("projectId"), "project_inode"), ["projectId"]
    )
    dirs = inodes.filter(F.col("parent_id") == F.col("partition_id")).select(
        F.col("parent_id").alias("project_inode"),
        F.col("name").alias("inode_name"),
        F.col("id").alias("dataset_inode"),
    )
    return lookup(owned, dirs, ["project_inode", "inode_name"])
