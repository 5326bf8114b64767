"""One query per operator or pipeline, over the tables of `bindings`.

Results are flat: document structs become columns, maps become rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import Tables
from tidemark.catalog import CATALOG, DELETED
from tidemark.functions import classify, codes, keys, values
from tidemark.operators import (
    assemble,
    docops,
    enrich,
    fold,
    joins,
    metrics,
    nested,
    ordering,
    retention,
    sink,
)
from tidemark.plans import cascade, mutations, provenance, rebuild
from tidemark.session import materialize, shared_root
from tidemark.sources import feeds, schemas
from tidemark.streaming.bootstrap import Bootstrap
from tidemark.streaming.documents import StreamedDocuments
from tidemark.streaming.files import Files
from tidemark.streaming.metrics import MetricsTable, windowed_metrics
from tidemark.streaming.pipeline import EpochBarrier, Outputs, drain
from tidemark.streaming.pruning import PrunedBuffer, PrunedLog
from tidemark.streaming.viewable import ViewableBarrier

Pruned = Callable[[DataFrame, int], None]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


# --- sources ---------------------------------------------------------------


def _change_feed(t: Tables) -> DataFrame:
    """The mutation log as change events: inserts, deletes, updates, others."""
    row = F.struct("inode_id", "logical_time", "inode_name", "operation")
    old = F.struct(
        "inode_id",
        (F.col("logical_time") - 1).alias("logical_time"),
        F.concat("inode_name", F.lit("~")).alias("inode_name"),
        "operation",
    )
    kind = (
        F.when(F.col("operation") == 1, "DELETE")
        .when(F.col("operation") == 0, "INSERT")
        .when(F.col("operation") < 10, "UPDATE")
        .otherwise("GCP_COMPLETE")
    )
    return t.mutations.select(kind.alias("op"), "commit_epoch", old.alias("pre"), row.alias("post"))


@query
def feed_subscribe(t: Tables) -> DataFrame:
    """S1-S5, S10."""
    columns = ["inode_id", "logical_time", "inode_name"]
    return feeds.subscribe(_change_feed(t), ["INSERT", "UPDATE", "GCP_COMPLETE"], columns)


@query
def feed_deletes(t: Tables) -> DataFrame:
    """Pre-images of deleted rows."""
    return feeds.subscribe(_change_feed(t), ["DELETE"], ["inode_id", "logical_time", "inode_name"], "pre")


def _inserted(rows: DataFrame, log: str) -> DataFrame:
    """Rows of a log, offered as inserts of a change feed and read from it again."""
    names = schemas.struct(schemas.LOGS[log]).names
    changes = rows.select(F.lit("INSERT").alias("op"), "commit_epoch", F.struct(*names).alias("post"))
    renamed = {"timestamp": "changed_ms", "user": "user_name", "name": "app_name"}
    return feeds.log_rows(changes, log).withColumnsRenamed(renamed)


@query
def feed_rows_mutations(t: Tables) -> DataFrame:
    """Every column of the file-mutation log."""
    return _inserted(t.mutations, "hdfs_metadata_log")


@query
def feed_rows_admin(t: Tables) -> DataFrame:
    """S3: every column of the admin log."""
    return _inserted(t.admin_log.withColumn("project_id", F.col("op_id")), "ops_log")


@query
def feed_rows_provenance(t: Tables) -> DataFrame:
    """Every column of the file-provenance log."""
    return _inserted(t.provenance, "hdfs_file_provenance_log")


@query
def feed_rows_apps(t: Tables) -> DataFrame:
    """Every column of the application log."""
    return _inserted(t.app_log, "yarn_app_provenance_log")


@query
def feed_deleted_rows(t: Tables) -> DataFrame:
    """The pre-images of deleted rows of a catalog table, here of parts."""
    image = F.struct(
        F.col("p_partkey").alias("PART_ID"),
        (F.col("p_partkey") * 2).alias("SD_ID"),
        F.col("p_size").cast("long").alias("TBL_ID"),
        F.col("p_name").alias("PART_NAME"),
    )
    kind = F.when(F.col("p_size") > 25, "DELETE").otherwise("UPDATE")
    changes = t.part.select(kind.alias("op"), F.col("p_partkey").alias("commit_epoch"), image.alias("pre"))
    return feeds.deleted_rows(changes, "PARTITIONS")


@query
def scan_normalised(t: Tables) -> DataFrame:
    """S7, S12."""
    padded = t.documents.select(
        "doc_id",
        F.rpad("lang", 8, " ").alias("lang"),
        F.encode(F.concat(F.lit("é-"), F.col("source")), "ISO-8859-1").alias("source"),
    )
    return feeds.normalise(padded, char_columns=["lang"], latin1_columns=["source"])


@query
def scan_filtered(t: Tables) -> DataFrame:
    """S9."""
    return feeds.searchable_datasets(t.datasets).select("id", "inode_name", "projectId")


@query
def scan_snapshot(t: Tables) -> DataFrame:
    """The admin log by epoch, with its place in that order."""
    return ordering.positions(t.admin_log, ordering.ADMIN_ORDER).select(
        "id", "commit_epoch", "position"
    )


# --- order, dedup, batching ------------------------------------------------


@query
def feed_order_epoch(t: Tables) -> DataFrame:
    """O1, O3, O8."""
    return ordering.positions(t.mutations, ordering.MUTATION_ORDER).select(
        keys.key_string(keys.MUTATION_KEY).alias("log_pk"), "commit_epoch", "position"
    )


@query
def feed_closed_epochs(t: Tables) -> DataFrame:
    """O1: released rows, and the ones held back."""
    feed = t.feed.select("event_id", "commit_epoch")
    released = ordering.closed_epochs(feed).withColumn("released", F.lit(True))
    held = ordering.open_epoch(feed).withColumn("released", F.lit(False))
    return released.unionByName(held)


@query
def feed_gci(t: Tables) -> DataFrame:
    """O2: the coarse barrier."""
    feed = t.feed.select("event_id", F.col("wide_epoch").alias("commit_epoch"))
    level = ordering.global_checkpoint(F.col("commit_epoch"))
    return ordering.closed_epochs(feed, level).withColumn("gci", level)


@query
def feed_order_phase(t: Tables) -> DataFrame:
    """O4."""
    rows = t.provenance.withColumn("phase", ordering.provenance_phase())
    return ordering.positions(rows, ordering.PROVENANCE_ORDER).select(
        keys.key_string(keys.PROVENANCE_KEY).alias("log_pk"), "phase", "position"
    )


@query
def feed_order_app(t: Tables) -> DataFrame:
    """O5."""
    return ordering.positions(t.app_log, ordering.APP_ORDER).select(
        keys.key_string(keys.APP_KEY).alias("log_pk"), "position"
    )


def _captured(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The feed as a snapshot and as live changes, a part of it in both."""
    feed = t.feed.select("event_id", "commit_epoch", "k")
    snapshot = feed.filter(F.col("k") < 70).withColumn("captured", F.lit("snapshot"))
    return snapshot, feed.filter(F.col("k") >= 30).withColumn("captured", F.lit("live"))


@query
def bootstrap_dedup(t: Tables) -> DataFrame:
    """O7, O12, S11."""
    return ordering.bootstrap(*_captured(t), ["event_id"])


@query
def dedup_pk(t: Tables) -> DataFrame:
    """O9."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return ordering.first_by(
        rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"]
    )


@query
def batch_by_count(t: Tables) -> DataFrame:
    """O10, batch form."""
    placed = ordering.positions(
        t.mutations.select(*ordering.MUTATION_ORDER), ordering.MUTATION_ORDER
    )
    return ordering.count_batches(placed, 64).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("logical_time").alias("first_time"),
        F.max("logical_time").alias("last_time"),
    )


@query
def bundle_bytes(t: Tables) -> DataFrame:
    """O11."""
    bulks = t.documents.select(
        "lang", "doc_id", F.octet_length("text").cast("long").alias("bytes")
    )
    return ordering.byte_bundles(bulks, ["lang"], "doc_id", "bytes", 50_000)


# --- lookups and enrichment ------------------------------------------------


@query
def lookup_equal(t: Tables) -> DataFrame:
    """Typed equalities, pushed to the scan."""
    rows = joins.match_equal(t.lineitem, l_returnflag="R", l_linenumber=1)
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query
def lookup_unique(t: Tables) -> DataFrame:
    """Customers with exactly one order."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return joins.unique_match(orders, ["o_custkey"])


@query
def lookup_exists(t: Tables) -> DataFrame:
    """Customers with an order, and those without."""
    customers = t.customer.select("c_custkey")
    ordered = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    present = joins.keep_existing(customers, ordered, ["c_custkey"])
    absent = joins.keep_missing(customers, ordered, ["c_custkey"])
    return present.withColumn("has_orders", F.lit(True)).unionByName(
        absent.withColumn("has_orders", F.lit(False))
    )


@query
def lookup_skewed(t: Tables) -> DataFrame:
    """Lines joined with a side of which one key meets a third of them.

    The heavy keys are found once in the written lines and salted.
    """
    flag = F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_suppkey"))
    lines = materialize(t.lineitem.select("l_orderkey", "l_linenumber", flag.alias("s_suppkey")), "lines")
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    hot = joins.hot_keys(lines, ["s_suppkey"])
    return joins.salted_join(lines, suppliers, ["s_suppkey"], hot).select(
        "l_orderkey", "l_linenumber", "s_suppkey", "s_name", "s_nationkey"
    )


@query
def lookup_delete(t: Tables) -> DataFrame:
    """Lines of urgent orders deleted; rows left and rows gone."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    left, gone = retention.delete_matching(t.lineitem.select("l_orderkey"), urgent, ["l_orderkey"])
    remaining = left.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("left"))
    return remaining.unionByName(
        gone.select(F.col("deleted").alias("n"), F.lit("deleted").alias("what"))
    )


@query
def enrich_owner(t: Tables) -> DataFrame:
    """J1, J2, L1-L3."""
    reading = t.mutations.filter(codes.needs_inode(F.col("operation")))
    rows = enrich.with_owner_names(
        enrich.with_current_inode(reading, t.inodes), t.users, t.groups
    )
    return rows.select(
        keys.key_string(keys.MUTATION_KEY).alias("log_pk"),
        "inode_found",
        "size",
        F.col("user").alias("owner"),
        F.col("group").alias("owner_group"),
    )


@query
def resolve_project(t: Tables) -> DataFrame:
    """Every inode taken as a dataset."""
    ids = t.inodes.select(F.col("id").alias("dataset_id")).unionByName(
        t.mutations.select("dataset_id")
    )
    return enrich.resolve_datasets(ids, t.inodes, t.projects, t.datasets)


@query
def admin_target(t: Tables) -> DataFrame:
    """J13."""
    rows = enrich.with_admin_target(t.admin_log, t.datasets, t.projects)
    return rows.select(
        "id",
        F.col("target_dataset.projectId").alias("dataset_project"),
        F.col("target_dataset.public_ds").alias("public_ds"),
        F.col("target_project.projectname").alias("project_name"),
    )


@query
def xattr_lookup(t: Tables) -> DataFrame:
    """J6."""
    rows = t.mutations.filter(F.col("operation").isin(codes.XATTR_ADD, codes.XATTR_UPDATE))
    rows = rows.withColumns(
        {"xattr_namespace": values.namespace(F.col("pk2")), "xattr_name": F.col("pk3")}
    )
    return enrich.with_current_xattr(rows, t.xattrs).select(
        "logical_time", "xattr_name", "xattr_value", "xattr_found", "xattr_complete"
    )


@query
def xattr_incomplete(t: Tables) -> DataFrame:
    """Changes that wait for parts of their xattr."""
    held = mutations.incomplete_xattr_changes(t.mutations, t.xattrs)
    return held.select(
        keys.key_string(keys.MUTATION_KEY).alias("log_pk"), "logical_time", F.col("pk3").alias("xattr_name")
    )


@query
def xattr_lookup_all(t: Tables) -> DataFrame:
    """J7."""
    rows = t.mutations.filter(F.col("operation") == codes.XATTR_ADD_ALL)
    return enrich.with_all_xattrs(rows, t.xattrs).select("logical_time", "xattr_name", "xattr_value")


@query
def asof_mode(t: Tables) -> DataFrame:
    """J8, F10."""
    return enrich.with_store_mode(t.provenance, t.xattr_buffer).select(
        "io_logical_time", "core_time", "core_mode", "core_project"
    )


@query
def buffered_value(t: Tables) -> DataFrame:
    """J9."""
    rows = t.provenance.filter(F.col("inode_operation").isin("XATTR_ADD", "XATTR_UPDATE"))
    return enrich.with_buffered_xattr(rows, t.xattr_buffer).select(
        "io_logical_time", "i_xattr_name", "buffer_value"
    )


@query
def exists_filter(t: Tables) -> DataFrame:
    """J10, J11, L2, L6."""
    rows = classify.with_asset(t.provenance)
    projects = enrich.existing_projects(
        t.provenance_inodes, rows.select(F.col("project_i_id").alias("project"))
    ).select(F.col("project").alias("project_i_id"), F.lit(True).alias("found"))
    views = enrich.viewable_inodes(rows, t.provenance_inodes).withColumn("seen", F.lit(True))
    flagged = joins.lookup(joins.lookup(rows, projects, ["project_i_id"]), views, ["inode_id"])
    return flagged.select(
        "io_logical_time",
        F.coalesce("found", F.lit(False)).alias("project_exists"),
        (F.coalesce("seen", F.lit(False)) | (F.col("inode_operation") == "DELETE")).alias("kept"),
    )


# --- values and scalars ----------------------------------------------------


@query
def assemble_parts(t: Tables) -> DataFrame:
    """A1."""
    return assemble.assemble(t.xattrs, enrich.XATTR_ID).select(
        "inode_id", "name", "value", "num_parts", "complete"
    )


@query
def assemble_strict(t: Tables) -> DataFrame:
    """A2."""
    return assemble.assemble_strict(t.xattr_buffer, enrich.BUFFER_ID).select(
        "inode_id", "name", "inode_logical_time", "value"
    )


@query
def classify_asset(t: Tables) -> DataFrame:
    """F1-F9."""
    return classify.with_asset(t.provenance).select("io_logical_time", "ml_type", "ml_id")


@query
def depth_tests(t: Tables) -> DataFrame:
    """P4, F7."""
    return t.provenance.select(
        "io_logical_time",
        classify.is_dataset().alias("is_dataset"),
        classify.is_readme().alias("is_readme"),
        classify.one_level_deep().alias("one_level"),
        classify.one_plus_levels_deep().alias("one_plus"),
        classify.two_levels_deep().alias("two_levels"),
        classify.two_plus_levels_deep().alias("two_plus"),
    )


@query
def mutation_codes(t: Tables) -> DataFrame:
    """P1, P2, F12, F13, O8, F15."""
    code = F.col("operation")
    return t.mutations.select(
        keys.key_string(keys.MUTATION_KEY).alias("log_pk"),
        codes.fs_op_name(code).alias("op_name"),
        codes.is_inode_op(code).alias("is_inode_op"),
        codes.needs_inode(code).alias("needs_inode"),
        codes.is_xattr_op(code).alias("is_xattr_op"),
        codes.needs_xattr(code).alias("needs_xattr"),
        values.num_parts(F.col("logical_time") * 7).cast("int").alias("wrapped_parts"),
        values.namespace(F.col("logical_time")).cast("int").alias("wrapped_namespace"),
        keys.xattr_key(F.col("inode_id"), values.namespace(F.col("pk2")), F.col("pk3")).alias(
            "xattr_id"
        ),
    )


@query
def admin_codes(t: Tables) -> DataFrame:
    """F12 for the admin log."""
    return t.admin_log.select(
        "id",
        codes.admin_target_name(F.col("op_on")).alias("target"),
        codes.admin_op_name(F.col("op_type")).alias("op_name"),
        codes.admin_op_name(F.col("op_id")).alias("unknown_name"),
    )


@query
def json_or_text(t: Tables) -> DataFrame:
    """F16."""
    whole = assemble.assemble(t.xattr_buffer, enrich.BUFFER_ID)
    value = values.json_or_text(F.col("value"))
    return whole.select(
        "inode_id",
        "name",
        "inode_logical_time",
        values.is_json(F.col("value")).alias("is_json"),
        F.try_variant_get(value, "$.a", "long").alias("a"),
        F.when(~values.is_json(F.col("value")), F.try_variant_get(value, "$", "string")).alias("text"),
    )


@query
def readable_time(t: Tables) -> DataFrame:
    """F14."""
    return t.feed.select("event_id", values.readable_time(F.col("ts_ms")).alias("readable"))


@query
def document_ids(t: Tables) -> DataFrame:
    """F15, F17, F18."""
    return t.provenance.select(
        "io_logical_time",
        keys.operation_doc_id().alias("operation_id"),
        keys.state_doc_id().alias("state_id"),
        keys.doc_type(F.col("inode_id"), F.col("dataset_i_id")).alias("doc_type"),
        keys.project_index(F.col("project_i_id")).alias("index_name"),
    )


# --- document operations ---------------------------------------------------


def _mutation_ops(t: Tables) -> DataFrame:
    return mutations.mutation_ops(
        t.mutations, t.inodes, t.users, t.groups, t.xattrs, t.projects, t.datasets
    )


def _admin_ops(t: Tables) -> DataFrame:
    return mutations.admin_ops(t.admin_log, t.datasets, t.projects)


SEARCH_COLUMNS = [
    "doc_type",
    "parent_id",
    "partition_id",
    "dataset_id",
    "project_id",
    "name",
    "operation",
    "timestamp",
    "size",
    "user",
    "group",
    "description",
    "public_ds",
]


def _flat(source: str = "") -> list:
    """Document fields under names that are plain identifiers everywhere."""
    renamed = {
        "timestamp": "doc_time",
        "user": "owner",
        "group": "owner_group",
        "name": "doc_name",
        "operation": "doc_operation",
        "size": "doc_size",
    }
    return [F.col(f"{source}{c}").alias(renamed.get(c, c)) for c in SEARCH_COLUMNS]


@query
def dispatch_mutations(t: Tables) -> DataFrame:
    """One row per document operation."""
    ops = _mutation_ops(t)
    return ops.select(
        "log_pk",
        "doc_id",
        F.col("seq.op_no").alias("op_no"),
        "kind",
        "event_type",
        "xattr_key",
        "xattr_raw",
        *_flat("fields."),
    )


@query
def dispatch_admin(t: Tables) -> DataFrame:
    """D2, D4, D5, D22."""
    ops = _admin_ops(t)
    return ops.select("log_pk", "doc_id", "kind", "event_type", "asset_type", *_flat("fields."))


@query
def state_fanout(t: Tables) -> DataFrame:
    """D18."""
    ops = docops.app_states(t.app_log)
    return ops.select(
        "doc_id",
        "kind",
        F.col("fields.app_id").alias("app_id"),
        F.col("fields.app_state").alias("app_state"),
        F.col("fields.timestamp").alias("state_time"),
        F.col("fields.readable_timestamp").alias("readable"),
        F.col("fields.app_name").alias("app_name"),
        F.col("fields.app_user").alias("app_user"),
    )


def _enriched(t: Tables) -> DataFrame:
    return provenance.enriched(t.provenance, t.provenance_inodes, t.xattr_buffer)


def _provenance_ops(t: Tables) -> DataFrame:
    good, _ = sink.split_problems(_enriched(t))
    return provenance.provenance_ops(good)


@query
def enrich_provenance(t: Tables) -> DataFrame:
    """What the routing decides on."""
    return _enriched(t).select(
        "io_logical_time", "mode", "project_i_id", "project_name", "project_exists", "viewable"
    )


@query
def route_ops(t: Tables) -> DataFrame:
    """D10-D17, D19-D21."""
    return _provenance_ops(t).select(
        "log_pk",
        "index",
        "doc_id",
        F.col("seq.op_no").alias("op_no"),
        "kind",
        "xattr_key",
        "xattr_raw",
        "create_if_absent",
        F.col("fields.entry_type").alias("entry_type"),
        F.col("fields.ml_type").alias("ml_type"),
        F.col("fields.ml_id").alias("ml_id"),
        F.col("fields.project_i_id").alias("project_i_id"),
        F.col("fields.project_name").alias("project_name"),
        F.col("fields.xattr_prov_key").alias("xattr_prov_key"),
        F.col("fields.r_timestamp").alias("r_timestamp"),
        F.col("fields.r_create_timestamp").alias("r_create_timestamp"),
    ).withColumnRenamed("index", "index_name")


@query
def quarantine(t: Tables) -> DataFrame:
    """X5, F10, F11."""
    _, bad = sink.split_problems(_enriched(t))
    return bad.select("io_logical_time", "inode_operation", "problem")


# --- materialisation -------------------------------------------------------


def _search_ops(t: Tables) -> DataFrame:
    return ordering.union_feeds(_mutation_ops(t), _admin_ops(t))


@query
def fold_documents(t: Tables) -> DataFrame:
    """X1 over D1-D5: the projects collection."""
    return fold.fold(_search_ops(t), docops.SEARCH_GROUPS).select("doc_id", *_flat())


@query
def fold_map(t: Tables) -> DataFrame:
    """X2 over D6-D9: the xattrs of the projects collection."""
    return fold.fold_entries(_search_ops(t)).select("doc_id", "xattr_key", "xattr_raw")


@query
def fold_provenance(t: Tables) -> DataFrame:
    """X1 over D10-D17."""
    return _provenance_columns(fold.fold(_provenance_ops(t), docops.PROVENANCE_GROUPS))


def _provenance_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("index").alias("index_name"),
        "doc_id",
        "entry_type",
        "inode_id",
        "inode_operation",
        F.col("timestamp").alias("op_time"),
        F.col("create_timestamp").alias("create_time"),
        "project_i_id",
        "project_name",
        "ml_type",
        "ml_id",
        "xattr_prov_key",
    )


@query
def fold_provenance_map(t: Tables) -> DataFrame:
    """X2 over D13, D14, D16: raw value, and the value where it is JSON."""
    rows = fold.fold_entries(_provenance_ops(t))
    return rows.select(
        F.col("index").alias("index_name"),
        "doc_id",
        "xattr_key",
        "xattr_raw",
        values.is_json(F.col("xattr_raw")).alias("is_json"),
    )


def _path_rows(leaves: DataFrame) -> DataFrame:
    path = F.concat_ws(".", F.lit("$"), "path")
    return leaves.select(F.col("index").alias("index_name"), "doc_id", "xattr_key", path.alias("path"), "leaf")


def _nested_ops(t: Tables) -> DataFrame:
    """The provenance log as changes of a dataset's xattrs, whose values conflict.

    Objects meet objects, scalars and texts on the same names; some changes
    remove an entry, empty the map or delete the document.
    """
    k, clock = F.col("k"), F.col("io_logical_time")
    value = F.expr("""
        case k % 6
          when 0 then concat('{"a": {"b": ', k, ', "c": "x', k, '"}, "d": true}')
          when 1 then concat('{"a": {"e": ', k, '}, "n": {}}')
          when 2 then concat('{"a": ', k, '}')
          when 3 then concat('text-', k)
          when 4 then concat('{"a": {"b": {"f": ', k, '}}, "n": {"m": 1.5}}')
          else concat('"', k, '"') end""")
    doc, key = F.col("dataset_i_id"), F.concat(F.lit("x"), F.pmod(k, F.lit(2)).cast("string"))
    kind = F.col("event_type")
    ops = (
        F.when(kind.isin("purchase", "view", "click"), F.array(docops.xattr_set(doc, key, value)))
        .when((kind == "signup") & (k % 4 == 0), F.array(docops.xattr_clear(doc)))
        .when((kind == "signup") & (k % 4 == 1), F.array(docops.delete_doc(doc)))
        .otherwise(F.array(docops.xattr_remove(doc, key)))
    )
    return docops.explode_ops(t.provenance, ops, F.lit("datasets"), F.struct(clock.alias("clock")), [])


@query
def fold_map_nested(t: Tables) -> DataFrame:
    """X2 over D6, F16: values merged object by object, one row per leaf."""
    return _path_rows(nested.nested_leaves(nested.nested_state(_nested_ops(t)))).drop("index_name")


@query
def fold_provenance_nested(t: Tables) -> DataFrame:
    """X2 over D13, D16: the parsed values of a document's xattrs, one row per leaf."""
    ops = provenance.with_values(_provenance_ops(t))
    return _path_rows(nested.nested_leaves(nested.nested_state(ops)))


@query
def fold_apps(t: Tables) -> DataFrame:
    """X1 over D18."""
    return _app_columns(fold.fold(docops.app_states(t.app_log), docops.APP_GROUPS))


def _app_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "app_id",
        "app_state",
        F.col("timestamp").alias("state_time"),
        "app_name",
        F.col("app_user").alias("app_owner"),
        F.col("readable_timestamp").alias("readable"),
    )


@query
def index_routing(t: Tables) -> DataFrame:
    """Documents per collection, read back from its folders."""
    docs = fold.fold(_provenance_ops(t), docops.PROVENANCE_GROUPS)
    path = f"{shared_root(t.spark)}/collections-{uuid4().hex}"
    sink.write_collections(docs.select("index", "doc_id", "entry_type"), path)
    written = t.spark.read.schema("doc_id string, entry_type string, index string").parquet(path)
    return written.groupBy(F.col("index").alias("index_name"), "entry_type").agg(
        F.count(F.lit(1)).alias("documents")
    )


@query
def response_outcomes(t: Tables) -> DataFrame:
    """X6."""
    return sink.parse_responses(t.responses).select(
        "event_id", "success", "retryable", F.size("item_errors").alias("failed_items")
    )


@query
def response_errors(t: Tables) -> DataFrame:
    """Failures per error."""
    return sink.error_counts(sink.parse_responses(t.responses))


# --- rebuild ---------------------------------------------------------------


def _roots(t: Tables) -> DataFrame:
    roots = rebuild.dataset_roots(t.projects, t.datasets, t.inodes)
    return roots.filter(F.col("dataset_inode").isNotNull())


@query
def rebuild_tree(t: Tables) -> DataFrame:
    """R3."""
    return rebuild.descendants(t.inodes, _roots(t)).select(
        F.col("id").alias("inode_id"), "dataset_id", "project_id"
    )


@query
def rebuild_documents(t: Tables) -> DataFrame:
    """The collection as the rebuild writes it."""
    ops = rebuild.rebuild_ops(t.projects, t.datasets, t.inodes, t.users, t.groups, t.xattrs)
    return fold.fold(ops, docops.SEARCH_GROUPS).select("doc_id", *_flat())


@query
def rebuild_xattrs(t: Tables) -> DataFrame:
    """R5."""
    below = rebuild.descendants(t.inodes, _roots(t))
    return rebuild.inode_xattrs(below, t.xattrs).select("inode_id", "name", "value")


@query
def rebuild_counts(t: Tables) -> DataFrame:
    """A11, R6."""
    roots = _roots(t)
    return rebuild.dataset_counts(rebuild.descendants(t.inodes, roots), roots)


@query
def rebuild_stats(t: Tables) -> DataFrame:
    """A12, R6."""
    return rebuild.totals(t.projects, t.datasets, t.inodes, t.xattrs)


# --- cascade ---------------------------------------------------------------

STAR_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    "part": ["p_partkey"],
}


def _gone(gone: dict[str, DataFrame], tables: list[str]) -> DataFrame:
    """Deleted keys of all tables as (table_name, deleted_key)."""
    rows = None
    for name in tables:
        if name not in gone:
            continue
        one = gone[name].select(
            F.lit(name).alias("table_name"), keys.key_string(STAR_KEYS[name]).alias("deleted_key")
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _star(t: Tables) -> dict[str, DataFrame]:
    return {name: t.source(name) for name in STAR_KEYS}


@query
def cascade_simple(t: Tables) -> DataFrame:
    """Dependents go with their parent, three levels deep."""
    rules = [
        cascade.rule("region", "r_regionkey", "nation", "n_regionkey"),
        cascade.rule("nation", "n_nationkey", "customer", "c_nationkey"),
        cascade.rule("nation", "n_nationkey", "supplier", "s_nationkey"),
        cascade.rule("customer", "c_custkey", "orders", "o_custkey"),
    ]
    seeds = {"region": t.region.filter(F.col("r_name") == "AFRICA")}
    gone = cascade.cascade(_star(t), STAR_KEYS, rules, seeds)
    return _gone(gone, ["nation", "customer", "supplier", "orders"])


@query
def cascade_shared(t: Tables) -> DataFrame:
    """A customer goes only with the last of its orders."""
    rules = [cascade.rule("orders", "o_custkey", "customer", "c_custkey", shared=True)]
    seeds = {"orders": t.orders.filter(F.col("o_orderstatus") != "P")}
    gone = cascade.cascade(_star(t), STAR_KEYS, rules, seeds)
    return _gone(gone, ["customer"])


@query
def cascade_fixpoint(t: Tables) -> DataFrame:
    """C11: shared and plain rules that feed each other, with a cycle.

    Suppliers take their lines along; an order goes with its last line, a
    customer with its last order, and a customer takes all its orders along.
    """
    rules = [
        cascade.rule("nation", "n_nationkey", "supplier", "s_nationkey"),
        cascade.rule("supplier", "s_suppkey", "lineitem", "l_suppkey"),
        cascade.rule("lineitem", "l_orderkey", "orders", "o_orderkey", shared=True),
        cascade.rule("lineitem", "l_partkey", "part", "p_partkey", shared=True),
        cascade.rule("orders", "o_custkey", "customer", "c_custkey", shared=True),
        cascade.rule("orders", "o_orderkey", "lineitem", "l_orderkey"),
        cascade.rule("customer", "c_custkey", "orders", "o_custkey"),
    ]
    seeds = {"nation": t.nation.filter(F.col("n_regionkey") != 4)}
    gone = cascade.cascade(_star(t), STAR_KEYS, rules, seeds)
    return _gone(gone, ["supplier", "orders", "customer", "part"])


@query
def cascade_survivors(t: Tables) -> DataFrame:
    """Rows left per table after the region's cascade."""
    rules = [
        cascade.rule("region", "r_regionkey", "nation", "n_regionkey"),
        cascade.rule("nation", "n_nationkey", "customer", "c_nationkey"),
        cascade.rule("customer", "c_custkey", "orders", "o_custkey"),
        cascade.rule("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ]
    seeds = {"region": t.region.filter(F.col("r_name") == "AFRICA")}
    tables = _star(t)
    left = cascade.survivors(tables, STAR_KEYS, cascade.cascade(tables, STAR_KEYS, rules, seeds))
    rows = None
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        one = left[name].agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _catalog(t: Tables) -> dict[str, DataFrame]:
    tables = {}
    for name, parts in CATALOG.items():
        rows = [t.source(source).selectExpr(*_expressions(columns)) for source, columns in parts]
        tables[name] = rows[0]
        for more in rows[1:]:
            # Named, since unnamed columns of one origin make the optimizer fail.
            tables[name] = tables[name].union(more.toDF(*rows[0].columns))
    return tables


def _expressions(columns: str) -> list[str]:
    return [c.strip() for c in re.split(r",(?![^(]*\))", columns)]


def _deleted_rows(t: Tables, name: str) -> DataFrame:
    """Rows of a catalog table that the change feed reports as deleted."""
    source, columns, which = DELETED[name]
    rows = t.source(source).filter(which).selectExpr(*_expressions(columns))
    changes = rows.select(F.lit("DELETE").alias("op"), F.lit(1).alias("commit_epoch"), F.struct("*").alias("pre"))
    return feeds.subscribe(changes, ["DELETE"], rows.columns, "pre")


@query
def cascade_catalog(t: Tables) -> DataFrame:
    """The rule table of the catalog cleaner, fed by deletes of four tables."""
    tables = _catalog(t)
    seeds = {name: _deleted_rows(t, name) for name in DELETED}
    gone = cascade.cascade(tables, cascade.CATALOG_KEYS, cascade.CATALOG_RULES, seeds)
    rows = None
    for name in CATALOG:
        if name in gone:
            key = F.concat_ws("-", *[F.col(c).cast("string") for c in cascade.CATALOG_KEYS[name]])
            one = gone[name].select(F.lit(name).alias("table_name"), key.alias("deleted_key")).distinct()
            rows = one if rows is None else rows.unionByName(one)
    return rows


# --- retention -------------------------------------------------------------


def _acked(t: Tables) -> DataFrame:
    good, _ = sink.split_problems(_enriched(t))
    return provenance.acknowledged(good)


@query
def retention_keys(t: Tables) -> DataFrame:
    """K1: the companion of every processed change."""
    return _acked(t).select(
        "io_logical_time",
        F.col("companion.inode_id").alias("companion_inode"),
        F.col("companion.name").alias("companion_name"),
        F.col("companion.inode_logical_time").alias("companion_time"),
        F.col("companion.num_parts").alias("companion_parts"),
    )


@query
def retention_log(t: Tables) -> DataFrame:
    """What stays in the log, i.e. the quarantined rows."""
    left = retention.remaining_log(t.provenance, _acked(t), keys.PROVENANCE_KEY)
    return left.select("io_logical_time", "inode_operation")


@query
def retention_buffer(t: Tables) -> DataFrame:
    """K2, K4."""
    return _buffer_columns(retention.remaining_buffer(t.xattr_buffer, _acked(t)))


def _buffer_columns(left: DataFrame) -> DataFrame:
    return left.select(
        "inode_id", "name", "inode_logical_time", F.col("index").alias("part_no"), "value"
    )


# --- metrics ---------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if c in metrics.MEANS else F.col(c) for c in df.columns])


@query
def metrics_bulks(t: Tables) -> DataFrame:
    """A6, A8."""
    return metrics.bulks(t.changes).select(
        "bulk_id", "events", "batching_ms", "waiting_ms", "processing_ms", "sink_wait_ms", "total_ms"
    )


@query
def metrics_log_types(t: Tables) -> DataFrame:
    """A8."""
    return metrics.log_type_counts(t.changes)


@query
def metrics_minute(t: Tables) -> DataFrame:
    """A3-A5."""
    return _rounded(metrics.scope_metrics(metrics.bulks(t.changes), "last_minute"))


@query
def metrics_hour(t: Tables) -> DataFrame:
    """A3-A5."""
    return _rounded(metrics.scope_metrics(metrics.bulks(t.changes), "last_hour"))


@query
def metrics_all(t: Tables) -> DataFrame:
    """A3-A5."""
    return _rounded(metrics.scope_metrics(metrics.bulks(t.changes), "all_time"))


@query
def metrics_throughput(t: Tables) -> DataFrame:
    """A7."""
    return metrics.throughput(metrics.bulks(t.changes)).withColumn(
        "events_per_second", F.round("events_per_second", 6)
    )


@query
def metrics_text(t: Tables) -> DataFrame:
    """A10."""
    rows = metrics.long_form(metrics.scope_metrics(metrics.bulks(t.changes), "last_hour"))
    return metrics.text_lines(rows, "feed").select("window_start_ms", "line")


# --- streaming -------------------------------------------------------------


ROWS_A_FILE = 50_000


def _stream(t: Tables, feed: DataFrame, order: list[str], files: int = 4) -> tuple[DataFrame, str]:
    """A feed written in commit order and read as a stream of two batches.

    The files grow in number, not in size, so a batch of a large feed is written and read by many tasks.
    """
    folder = f"{shared_root(t.spark)}/stream-{uuid4().hex}"
    files = max(files, feed.count() // ROWS_A_FILE)
    feed.repartitionByRange(files, *order).write.option("compression", "zstd").parquet(f"{folder}/feed")
    source = t.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", (files + 1) // 2)
    return source.parquet(f"{folder}/feed"), folder


def _bare(ops: DataFrame) -> DataFrame:
    return ops.drop("log_type", "log_pk", "event_type", "asset_type")


@query
def stream_replay(t: Tables) -> DataFrame:
    """The feed applied as a stream of micro-batches.

    Same result as `fold_documents` without the admin log. Changes whose xattr
    is incomplete are held and offered again with every batch.
    """
    stream, folder = _stream(t, t.mutations, ["commit_epoch", "inode_id"])

    def to_ops(rows: DataFrame) -> DataFrame:
        return _bare(
            mutations.mutation_ops(rows, t.inodes, t.users, t.groups, t.xattrs, t.projects, t.datasets)
        )

    docs = drain(
        stream,
        to_ops,
        StreamedDocuments(t.spark, f"{folder}/state", docops.SEARCH_GROUPS),
        f"{folder}/checkpoint",
        EpochBarrier(t.spark, f"{folder}/open", lambda rows: mutations.incomplete_xattr_changes(rows, t.xattrs)),
    )
    return docs.select("doc_id", *_flat())


@query
def stream_admin(t: Tables) -> DataFrame:
    """The admin log as a stream; the documents of a batch fold."""
    stream, folder = _stream(t, t.admin_log, ["commit_epoch", "id"])
    docs = drain(
        stream,
        lambda rows: _bare(mutations.admin_ops(rows, t.datasets, t.projects)),
        StreamedDocuments(t.spark, f"{folder}/state", docops.SEARCH_GROUPS),
        f"{folder}/checkpoint",
        EpochBarrier(t.spark, f"{folder}/open"),
    )
    return docs.select("doc_id", *_flat())


@query
def stream_apps(t: Tables) -> DataFrame:
    """The application log as a stream; equal to `fold_apps`."""
    stream, folder = _stream(t, t.app_log, ["commit_epoch", "id"])
    docs = drain(
        stream,
        docops.app_states,
        StreamedDocuments(t.spark, f"{folder}/state", docops.APP_GROUPS),
        f"{folder}/checkpoint",
        EpochBarrier(t.spark, f"{folder}/open"),
    )
    return _app_columns(docs)


def _provenance_stream(t: Tables, pruned: Pruned | None = None) -> tuple[DataFrame, Outputs]:
    """The provenance log as a stream: its documents, quarantine and acknowledgements.

    Inodes found viewable are kept across batches, so the documents are those of
    one fold over the whole log. `pruned` gets the acknowledgements of each batch.
    """
    stream, folder = _stream(t, t.provenance, ["commit_epoch", "dataset_i_id", "io_logical_time"])
    barrier = ViewableBarrier(t.spark, f"{folder}/open", t.provenance_inodes)

    batch = {}

    def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        # Operations and outputs of a batch share its enrichment.
        if batch.get("rows") is not rows:
            found = provenance.enriched(rows, t.provenance_inodes, t.xattr_buffer, barrier.seen())
            # Written, since three outputs read it.
            batch.update(rows=rows, parts=sink.split_problems(materialize(found, "enriched")))
        return batch["parts"]

    outputs = Outputs(
        f"{folder}/out",
        problems=lambda rows: parted(rows)[1].select("io_logical_time", "inode_operation", "problem"),
        acked=lambda rows: provenance.acknowledged(parted(rows)[0]),
        prune=pruned,
    )
    docs = drain(
        stream,
        lambda rows: _bare(provenance.provenance_ops(parted(rows)[0])),
        StreamedDocuments(t.spark, f"{folder}/state", docops.PROVENANCE_GROUPS),
        f"{folder}/checkpoint",
        barrier,
        outputs,
    )
    return docs, outputs


@query
def stream_provenance(t: Tables) -> DataFrame:
    """S1, X1, J11 on a stream: the provenance log; equal to `fold_provenance`."""
    docs, _ = _provenance_stream(t)
    return _provenance_columns(docs)


@query
def stream_quarantine(t: Tables) -> DataFrame:
    """X5 on a stream: the rows each batch put aside; equal to `quarantine`."""
    _, outputs = _provenance_stream(t)
    return outputs.read(t.spark, "problems")


@query
def stream_retention(t: Tables) -> DataFrame:
    """X4, K2 in a stream: the buffer that each batch pruned; equal to `retention_buffer`."""
    buffer = PrunedBuffer(t.spark, f"{shared_root(t.spark)}/buffer-{uuid4().hex}", t.xattr_buffer.schema)
    buffer.add(t.xattr_buffer, 0)
    _provenance_stream(t, buffer.prune)
    return _buffer_columns(buffer.parts())


@query
def stream_retention_log(t: Tables) -> DataFrame:
    """X4, K3, K4 in a stream: the log that each batch pruned; equal to `retention_log`."""
    path = f"{shared_root(t.spark)}/log-{uuid4().hex}"
    # A log of many epochs has wider blocks, so that folders stay few.
    epochs = t.provenance.agg(F.max("commit_epoch")).first()[0] or 0
    log = PrunedLog(t.spark, path, t.provenance.schema, keys.PROVENANCE_KEY, max(64, epochs // 128))
    log.add(t.provenance)
    _provenance_stream(t, lambda acked, _: log.prune(acked))
    return log.rows().select("io_logical_time", "inode_operation")


@query
def stream_bootstrap(t: Tables) -> DataFrame:
    """O7 as streams: rows deferred until the snapshot ends; equal to `bootstrap_dedup`."""
    folder = f"{shared_root(t.spark)}/bootstrap-{uuid4().hex}"
    captured = dict(zip(("snapshot", "live"), _captured(t)))
    for name, rows in captured.items():
        rows.repartitionByRange(4, "commit_epoch", "event_id").write.parquet(f"{folder}/{name}")

    def feed(session: SparkSession, name: str, files: int) -> DataFrame:
        source = session.readStream.schema(captured[name].schema).option("maxFilesPerTrigger", files)
        return source.parquet(f"{folder}/{name}")

    # The live feed runs ahead of the snapshot.
    start = Bootstrap(t.spark, f"{folder}/state", ["event_id"], lambda s: (feed(s, "snapshot", 1), feed(s, "live", 2)))
    start.follow().awaitTermination()
    return start.rows()


def _stream_metrics(t: Tables, scope: str, slices: int = 4) -> DataFrame:
    """The changes arrive slice by slice of their time, in any order within one."""
    folder = f"{shared_root(t.spark)}/metrics-{uuid4().hex}"
    changes = materialize(t.changes, "changes")
    first, last = changes.agg(F.min("done_ms"), F.max("done_ms")).first()
    span = (last - first) // slices + 1
    for start in range(first, last + 1, span):
        part = changes.filter(F.col("done_ms").between(start, start + span - 1))
        part.write.mode("append").parquet(f"{folder}/changes")
    # Windows close when a later change is seen, so the feed ends with one.
    end = [
        F.lit(last + span + 2 * 3_600_000 if f.name == "done_ms" else None).cast(f.dataType).alias(f.name)
        for f in changes.schema
    ]
    t.spark.range(1).select(*end).write.mode("append").parquet(f"{folder}/changes")
    table = MetricsTable(t.spark, f"{folder}/state")
    # A batch is about a slice, however many files that has.
    files = sum(n.endswith(".parquet") for n in Files(t.spark, f"{folder}/changes").names())
    feed = table.changes(f"{folder}/changes", changes.schema, max(2, files // slices))
    windows = windowed_metrics(feed, scope, delay=f"{span} milliseconds")
    table.follow(windows).awaitTermination()
    return _rounded(table.rows(windows.schema))


@query
def stream_metrics(t: Tables) -> DataFrame:
    """A3-A6, A8 on a stream: every closed minute; equal to `metrics_minute`."""
    return _stream_metrics(t, "last_minute")


@query
def stream_metrics_hour(t: Tables) -> DataFrame:
    """A3-A6, A8 on a stream: every closed hour; equal to `metrics_hour`."""
    return _stream_metrics(t, "last_hour")
