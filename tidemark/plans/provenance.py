"""File provenance changes to state and operation documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import with_asset
from tidemark.functions.codes import (
    ASSET_TYPES,
    CORE_XATTR,
    MISSING_ID,
    PART_TYPES,
    PROJECT_ID_XATTR,
    USER_NAMESPACE,
    is_known_provenance_op,
)
from tidemark.functions.keys import (
    PROVENANCE_KEY,
    key_string,
    operation_doc_id,
    project_index,
    state_doc_id,
)
from tidemark.functions.values import is_json, readable_time, store_mode
from tidemark.operators import docops as D
from tidemark.operators.enrich import (
    existing_projects,
    repair_project,
    viewable_inodes,
    with_buffered_xattr,
    with_store_mode,
)
from tidemark.operators.joins import lookup
from tidemark.operators.ordering import PROVENANCE_ORDER, provenance_phase
from tidemark.session import materialize

# What an operation writes, by kind of operation, asset or part, and store
# mode. A step names one document operation. Pairs not listed write nothing.
ROUTES = {
    ("CREATE", "asset", "STATE"): ["alive"],
    ("CREATE", "asset", "ALL"): ["alive", "record"],
    ("DELETE", "asset", "STATE"): ["dead"],
    ("DELETE", "asset", "ALL"): ["dead", "record"],
    ("DATA", "asset", "ALL"): ["record"],
    ("XATTR_SET", "asset", "STATE"): ["project_id", "xattr_reset", "xattr_set"],
    ("XATTR_SET", "asset", "ALL"): ["project_id", "xattr_reset", "xattr_set", "xattr_record"],
    ("XATTR_DELETE", "asset", "STATE"): ["xattr_drop"],
    ("XATTR_DELETE", "asset", "ALL"): ["xattr_drop", "xattr_drop_record"],
    ("CREATE", "part", "ALL"): ["record"],
    ("DELETE", "part", "ALL"): ["record"],
    ("DATA", "part", "ALL"): ["record"],
    ("XATTR_SET", "part", "ALL"): ["record"],
    ("XATTR_DELETE", "part", "ALL"): ["record"],
}
# Kind of operation per operation name; METADATA and OTHER have none.
OP_KINDS = {
    "CREATE": "CREATE",
    "DELETE": "DELETE",
    "ACCESS_DATA": "DATA",
    "MODIFY_DATA": "DATA",
    "XATTR_ADD": "XATTR_SET",
    "XATTR_UPDATE": "XATTR_SET",
    "XATTR_DELETE": "XATTR_DELETE",
}
# Before the matrix, a change of the store mode itself writes this, for any type.
MODE_CHANGE = {"NONE": ["dead"], "STATE": ["alive"], "ALL": ["alive"]}

F_PROV = D.PROVENANCE_FIELDS


def _map(entries: dict[str, Column], key: Column) -> Column:
    pairs = [c for name, value in entries.items() for c in (F.lit(name), value)]
    return F.try_element_at(F.create_map(*pairs), key)


def _steps(routes: dict[str, list[str]], key: Column) -> Column:
    """The list of steps filed under `key`, empty when there is none."""
    listed = {k: F.array(*[F.lit(s) for s in steps]) for k, steps in routes.items()}
    return F.coalesce(_map(listed, key), F.array().cast("array<string>"))


def op_kind() -> Column:
    return _map({k: F.lit(v) for k, v in OP_KINDS.items()}, F.col("inode_operation"))


def asset_kind() -> Column:
    return F.when(F.col("ml_type").isin(*ASSET_TYPES), "asset").when(
        F.col("ml_type").isin(*PART_TYPES), "part"
    )


def route_steps(kind: Column, asset: Column, mode: Column) -> Column:
    """D20 as a lookup in the rule table."""
    table = {"/".join(key): steps for key, steps in ROUTES.items()}
    return _steps(table, F.concat(kind, F.lit("/"), asset, F.lit("/"), mode))


# Steps that write a whole state document or a whole operation record.
RECORDS = ["record", "xattr_record", "xattr_drop_record"]
WHOLE = ["alive", *RECORDS]


def step_kind() -> Column:
    """What the operation of a step does."""
    step = F.col("step")
    return (
        F.when(step == "dead", D.DELETE)
        .when(step.isin("xattr_reset", "xattr_drop"), D.MAP_REMOVE)
        .otherwise(D.UPSERT)
    )


def step_fields() -> Column:
    """Fields the operation of a step mentions."""

    def only(steps: list[str], value: Column) -> Column:
        return F.when(F.col("step").isin(*steps), value)

    readable = readable_time(F.col("io_timestamp"))
    return D.fields(
        F_PROV,
        inode_id=only(WHOLE, F.col("inode_id")),
        app_id=only(WHOLE, F.col("io_app_id")),
        user_id=only(WHOLE, F.col("io_user_id")),
        project_i_id=only([*WHOLE, "project_id"], F.col("project_i_id")),
        dataset_i_id=only(WHOLE, F.col("dataset_i_id")),
        parent_i_id=only(WHOLE, F.col("parent_i_id")),
        inode_name=only(WHOLE, F.col("i_name")),
        project_name=only(WHOLE, F.col("project_name")),
        ml_id=only(WHOLE, F.col("ml_id")),
        ml_type=only(WHOLE, F.col("ml_type")),
        partition_id=only(WHOLE, F.col("i_partition_id")),
        entry_type=F.when(F.col("step") == "alive", "state").when(
            F.col("step").isin(*RECORDS), "operation"
        ),
        create_timestamp=only(["alive"], F.col("io_timestamp")),
        r_create_timestamp=only(["alive"], readable),
        inode_operation=only(RECORDS, F.col("inode_operation")),
        logical_time=only(RECORDS, F.col("io_logical_time")),
        timestamp=only(RECORDS, F.col("io_timestamp")),
        r_timestamp=only(RECORDS, readable),
        xattr_prov_key=only(["xattr_drop_record"], F.col("i_xattr_name")),
    )


def enriched(
    rows: DataFrame, inodes: DataFrame, buffer: DataFrame, seen: DataFrame | None = None
) -> DataFrame:
    """Rows with asset, store mode, project, xattr value and view flag.

    `seen` has the ids of inodes that earlier rows of a stream were found under.
    `problem` names what makes a row unprocessable (X5), null for good rows.
    The rows are written once after the as-of and buffer joins: the lookups
    that follow derive their key sets from them. So are the projects: most rows
    name one of a few, and a join that shuffles the rows by project leaves all
    of them to as many tasks. Written, their size is known and they are sent
    around when they are few.
    """
    typed = with_asset(rows).withColumn("phase", provenance_phase())
    moded = with_store_mode(_with_xattr_values(typed, buffer), buffer, points_of=typed)
    valued = materialize(moded, "provenance")
    candidates = valued.select(
        F.explode(F.array("project_i_id", "core_project", "own_project")).alias("project")
    ).filter(F.col("project").isNotNull() & (F.col("project") != MISSING_ID))
    alive = materialize(existing_projects(inodes, candidates), "projects")

    def project(column: str, name: str, flag: str) -> DataFrame:
        return alive.select(
            F.col("project").alias(column),
            F.col("project_inode_name").alias(name),
            F.lit(True).alias(flag),
        )

    named = lookup(valued, project("core_project", "core_project_name", "_c"), ["core_project"])
    repaired = repair_project(named.drop("_c"))
    # A change of the store mode itself decides mode and, if unknown, project.
    sets_mode = F.col("own_mode").isNotNull()
    moded = repaired.withColumns(
        {
            "mode": F.when(sets_mode, F.col("own_mode"))
            .when(F.col("core_time").isNull(), "ALL")
            .otherwise(F.col("core_mode")),
            "project_i_id": F.when(
                sets_mode & (F.col("project_i_id") == MISSING_ID), F.col("own_project")
            ).otherwise(F.col("project_i_id")),
        }
    )
    flagged = lookup(moded, project("project_i_id", "_name", "_exists"), ["project_i_id"])
    views = viewable_inodes(valued, inodes)
    if seen is not None:
        views = views.unionByName(seen).distinct()
    views = views.withColumn("_viewable", F.lit(True))
    flagged = lookup(flagged, views, ["inode_id"])
    return flagged.withColumns(
        {
            "project_exists": F.coalesce("_exists", F.lit(False)),
            "viewable": F.coalesce("_viewable", F.lit(False))
            | (F.col("inode_operation") == "DELETE"),
            "problem": problem(),
        }
    ).drop("_exists", "_viewable", "_name")


def _sets_xattr() -> Column:
    return F.col("inode_operation").isin("XATTR_ADD", "XATTR_UPDATE")


def _with_xattr_values(rows: DataFrame, buffer: DataFrame) -> DataFrame:
    """J9 for the xattr changes only; other rows are not shuffled for it."""
    changes = with_buffered_xattr(rows.filter(_sets_xattr()), buffer)
    own = F.when(F.col("i_xattr_name") == CORE_XATTR, store_mode(F.col("buffer_value")))
    changes = changes.withColumn("_own", own).withColumns(
        {"own_mode": F.col("_own.mode"), "own_project": F.col("_own.project_iid")}
    )
    others = rows.filter(~F.coalesce(_sets_xattr(), F.lit(False)))
    return changes.drop("_own").unionByName(others, allowMissingColumns=True)


def problem() -> Column:
    """Why a row cannot be processed."""
    is_mode_change = _sets_xattr() & (F.col("i_xattr_name") == CORE_XATTR)
    return (
        F.when(~is_known_provenance_op(F.col("inode_operation")), "unknown operation")
        .when(F.col("core_time").isNotNull() & F.col("core_mode").isNull(), "bad store mode")
        .when(
            is_mode_change & F.col("buffer_value").isNotNull() & F.col("own_mode").isNull(),
            "bad store mode change",
        )
    )


def may_write() -> Column:
    """Whether a row can have steps once its inode is viewable; a delete never waits for that."""
    changes_mode = _sets_xattr() & (F.col("i_xattr_name") == CORE_XATTR)
    return (F.col("inode_operation") != "DELETE") & (
        asset_kind().isNotNull() | F.coalesce(changes_mode, F.lit(False))
    )


def planned_steps() -> Column:
    """The steps of a row, empty when it is skipped."""
    kind, asset, mode = op_kind(), asset_kind(), F.col("mode")
    sets = _sets_xattr()
    ready = (
        F.col("viewable")
        & F.col("project_exists")
        & ~(sets & F.col("buffer_value").isNull())
    )
    changes_mode = F.coalesce(sets & (F.col("i_xattr_name") == CORE_XATTR), F.lit(False))
    before = F.when(changes_mode, _steps(MODE_CHANGE, mode)).otherwise(
        F.array().cast("array<string>")
    )
    steps = F.concat(before, route_steps(kind, asset, mode))
    return F.when(ready, steps).otherwise(F.array().cast("array<string>"))


def companion_key() -> Column:
    """K1: the buffered value that may go once the row is applied.

    Deleting a dataset frees its current store mode, changing the store mode
    frees the one before it, any other xattr change frees its own value.
    """

    def key(inode: Column, name: Column, clock: Column, parts: Column) -> Column:
        return F.struct(
            inode.alias("inode_id"),
            F.lit(USER_NAMESPACE).cast("byte").alias("namespace"),
            name.alias("name"),
            clock.cast("long").alias("inode_logical_time"),
            parts.cast("short").alias("num_parts"),
        )

    core = F.when(
        F.col("core_time").isNotNull(),
        key(F.col("dataset_i_id"), F.lit(CORE_XATTR), F.col("core_time"), F.col("core_parts")),
    )
    own = key(
        F.col("inode_id"), F.col("i_xattr_name"), F.col("io_logical_time"), F.col("i_xattr_num_parts")
    )
    name = F.col("inode_operation")
    return (
        F.when((name == "DELETE") & (F.col("inode_id") == F.col("dataset_i_id")), core)
        .when(
            _sets_xattr() & (F.col("i_xattr_name") == CORE_XATTR),
            F.when(F.col("core_time") < F.col("io_logical_time"), core),
        )
        .when(_sets_xattr() | (name == "XATTR_DELETE"), own)
    )


def provenance_ops(good: DataFrame) -> DataFrame:
    """Document operations of enriched rows without a problem.

    A row is first repeated once per step and then rendered, so each field is
    computed once.
    """
    rows = good.withColumn("log_pk", key_string(PROVENANCE_KEY)).select(
        "*", F.posexplode(planned_steps()).alias("op_no", "step")
    )
    rows = rows.filter(
        (F.col("step") != "project_id") | (F.col("i_xattr_name") == PROJECT_ID_XATTR)
    )
    step = F.col("step")
    keyed = ["xattr_reset", "xattr_set", "xattr_drop", "xattr_record"]
    return rows.select(
        project_index(F.col("project_i_id")).alias("index"),
        F.when(step.isin(*RECORDS), operation_doc_id()).otherwise(state_doc_id()).alias("doc_id"),
        F.struct(*[F.col(c) for c in PROVENANCE_ORDER], F.col("op_no")).alias("seq"),
        step_kind().alias("kind"),
        step_fields().alias("fields"),
        F.when(step.isin(*keyed), F.col("i_xattr_name")).alias("xattr_key"),
        F.when(step.isin("xattr_set", "xattr_record"), F.col("buffer_value")).alias("xattr_raw"),
        (step != "xattr_drop").alias("create_if_absent"),
        "log_pk",
    )


def acknowledged(good: DataFrame) -> DataFrame:
    """Every processed log row, applied or skipped, with its companion."""
    return good.select("commit_epoch", *PROVENANCE_KEY, companion_key().alias("companion"))


def with_values(ops: DataFrame) -> DataFrame:
    """The operations whose xattr has a `value` beside its raw text.

    A state document's value is the parsed JSON, or the text where it is none;
    the record of an operation has a value only where it is JSON.
    """
    text_of_record = (F.col("fields.entry_type") == "operation") & ~is_json(F.col("xattr_raw"))
    return ops.filter(F.col("xattr_raw").isNull() | ~F.coalesce(text_of_record, F.lit(False)))
