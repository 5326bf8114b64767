"""Document operations: row to 0..n operations on a collection.

An operation is one row: where it goes (`index`, `doc_id`), when (`seq`), what
it does (`kind`) and with what (`fields`, `xattr_key`, `xattr_raw`). A null
member of `fields` is not mentioned by the operation.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.codes import APP_RUNNING, APP_SUBMITTED, DOC_DATASET, DOC_PROJECT
from tidemark.functions.keys import APP_INDEX, app_doc_id, doc_type
from tidemark.functions.values import readable_time

UPSERT, DELETE, MAP_REMOVE, MAP_CLEAR = "UPSERT", "DELETE", "MAP_REMOVE", "MAP_CLEAR"

# Fields of the documents in the projects collection.
SEARCH_FIELDS = (
    "doc_type string, parent_id long, partition_id long, dataset_id long, project_id int, "
    "name string, operation int, timestamp long, size long, user string, `group` string, "
    "description string, public_ds boolean"
)
# Fields of the documents in a project's provenance collection.
PROVENANCE_FIELDS = (
    "inode_id long, inode_operation string, logical_time int, timestamp long, "
    "create_timestamp long, app_id string, user_id int, project_i_id long, dataset_i_id long, "
    "parent_i_id long, inode_name string, project_name string, ml_id string, ml_type string, "
    "entry_type string, partition_id long, r_create_timestamp string, r_timestamp string, "
    "xattr_prov_key string"
)
APP_FIELDS = (
    "app_id string, app_state string, timestamp long, readable_timestamp string, "
    "app_name string, app_user string"
)

# Fields that the operations below and in the provenance plan write together.
SEARCH_GROUPS = [
    ["doc_type", "project_id"],
    ["parent_id", "partition_id", "operation", "size", "group"],
    ["name", "user"],
]
PROVENANCE_GROUPS = [
    [
        "inode_id",
        "app_id",
        "user_id",
        "dataset_i_id",
        "parent_i_id",
        "inode_name",
        "project_name",
        "ml_id",
        "ml_type",
        "entry_type",
        "partition_id",
    ],
    ["create_timestamp", "r_create_timestamp"],
    ["inode_operation", "logical_time", "timestamp", "r_timestamp"],
]
APP_GROUPS = [
    ["app_id", "app_state", "timestamp", "readable_timestamp", "app_name", "app_user"],
]


@cache
def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def fields(ddl: str, **values: Column) -> Column:
    """A fields struct with the given members set and all others null."""
    members = []
    for f in _schema(ddl).fields:
        value = values.pop(f.name, None)
        member = F.lit(None) if value is None else value
        members.append(member.cast(f.dataType).alias(f.name))
    if values:
        raise ValueError(f"not a document field: {sorted(values)}")
    return F.struct(*members)


def op(
    kind: str,
    doc_id: Column,
    body: Column,
    key: Column | None = None,
    raw: Column | None = None,
    create_if_absent: bool = True,
) -> Column:
    """One operation as a struct; all operations share this type."""
    text = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("kind"),
        doc_id.cast("string").alias("doc_id"),
        body.alias("fields"),
        (text if key is None else key).alias("xattr_key"),
        (text if raw is None else raw).alias("xattr_raw"),
        F.lit(create_if_absent).alias("create_if_absent"),
    )


def inode_upsert(dataset: Column, project: Column) -> Column:
    """D1."""
    return fields(
        SEARCH_FIELDS,
        doc_type=doc_type(F.col("inode_id"), dataset),
        parent_id=F.col("inode_parent_id"),
        partition_id=F.col("inode_partition_id"),
        dataset_id=dataset,
        project_id=project,
        name=F.col("inode_name"),
        operation=F.col("operation"),
        timestamp=F.col("logical_time"),
        size=F.col("size"),
        user=F.col("user"),
        group=F.col("group"),
    )


def dataset_change() -> Column:
    """D3."""
    return fields(
        SEARCH_FIELDS, dataset_id=F.col("dataset_id"), timestamp=F.col("logical_time")
    )


def dataset_upsert(dataset: Column, project: Column, description: Column, public: Column) -> Column:
    """D4."""
    return fields(
        SEARCH_FIELDS,
        doc_type=F.lit(DOC_DATASET),
        dataset_id=dataset,
        project_id=project,
        description=description,
        public_ds=public,
    )


def project_upsert(project: Column, user: Column, name: Column, description: Column) -> Column:
    """D5."""
    return fields(
        SEARCH_FIELDS,
        doc_type=F.lit(DOC_PROJECT),
        project_id=project,
        user=user,
        name=name,
        description=description,
    )


def no_fields(ddl: str = SEARCH_FIELDS) -> Column:
    """The fields of an operation that mentions none."""
    return F.lit(None).cast(_schema(ddl))


def delete_doc(doc_id: Column, ddl: str = SEARCH_FIELDS) -> Column:
    """D2, D11."""
    return op(DELETE, doc_id, no_fields(ddl))


def xattr_set(doc_id: Column, key: Column, raw: Column, ddl: str = SEARCH_FIELDS) -> Column:
    """D6."""
    return op(UPSERT, doc_id, no_fields(ddl), key, raw)


def xattr_remove(
    doc_id: Column, key: Column, ddl: str = SEARCH_FIELDS, create_if_absent: bool = True
) -> Column:
    """D8, D14."""
    return op(MAP_REMOVE, doc_id, no_fields(ddl), key, None, create_if_absent)


def xattr_clear(doc_id: Column, ddl: str = SEARCH_FIELDS) -> Column:
    """D9."""
    return op(MAP_CLEAR, doc_id, no_fields(ddl))


def explode_ops(
    rows: DataFrame, ops: Column, index: Column, order: Column, keep: list[str]
) -> DataFrame:
    """Rows with an array of operations to one row per operation.

    `order` is the order key struct of the row; the place in the array becomes
    its last member.
    """
    placed = rows.select(
        *keep,
        index.alias("index"),
        order.alias("_order"),
        F.posexplode(ops).alias("_no", "_op"),
    )
    return placed.select(
        "index",
        F.col("_op.doc_id").alias("doc_id"),
        F.struct("_order.*", F.col("_no").alias("op_no")).alias("seq"),
        F.col("_op.kind").alias("kind"),
        F.col("_op.fields").alias("fields"),
        F.col("_op.xattr_key").alias("xattr_key"),
        F.col("_op.xattr_raw").alias("xattr_raw"),
        F.col("_op.create_if_absent").alias("create_if_absent"),
        *keep,
    )


def app_states(apps: DataFrame) -> DataFrame:
    """An application row to its finished, running and submitted states.

    The finished state carries the row's own state name and exists only once
    the application has finished.
    """

    def state(name: Column, millis: Column) -> Column:
        return F.struct(name.alias("app_state"), millis.alias("at"))

    states = F.filter(
        F.array(
            F.when(F.col("finish_time") != 0, state(F.col("state"), F.col("finish_time"))),
            state(F.lit(APP_RUNNING), F.col("start_time")),
            state(F.lit(APP_SUBMITTED), F.col("submit_time")),
        ),
        lambda s: s.isNotNull(),
    )
    rows = apps.withColumn("_s", F.explode(states)).withColumns(
        {"app_state": F.col("_s.app_state"), "at": F.col("_s.at")}
    )
    body = fields(
        APP_FIELDS,
        app_id=F.col("id"),
        app_state=F.col("app_state"),
        timestamp=F.col("at"),
        readable_timestamp=readable_time(F.col("at")),
        app_name=F.col("name"),
        app_user=F.col("user"),
    )
    upsert = F.array(op(UPSERT, app_doc_id(F.col("id"), F.col("app_state"), F.col("at")), body))
    order = F.struct("commit_epoch", "id", "state", "timestamp", "at")
    return explode_ops(rows, upsert, F.lit(APP_INDEX), order, ["id", "state", "timestamp"])
