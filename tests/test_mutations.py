from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.plans import mutations
from tidemark.sources import schemas


def frame(spark, ddl, data):
    return spark.createDataFrame(data, schemas.struct(ddl))


def tables(spark):
    inodes = frame(
        spark,
        schemas.INODES,
        [
            (1, "Projects", 1, 2, 0, 1, 1, 0, True, 0, 0),
            (2, "proj", 2, 3, 0, 1, 1, 0, True, 0, 0),
            (3, "data", 3, 10, 0, 1, 1, 0, True, 0, 0),
            (10, "a", 10, 100, 7, 1, 9, 0, False, 1, 0),
            (10, "b", 10, 101, 8, 8, 1, 0, False, 0, 0),
            (50, "proj_featurestore.db", 50, 11, 0, 1, 1, 0, True, 0, 0),
            (50, "twice_featurestore.db", 50, 12, 0, 1, 1, 0, True, 0, 0),
        ],
    )
    users = frame(spark, schemas.USERS, [(1, "ann")])
    groups = frame(spark, schemas.GROUPS, [(1, "staff")])
    xattrs = frame(
        spark,
        schemas.XATTRS,
        [
            (100, 5, "x", 0, '{"k":', 2),
            (100, 5, "x", 1, "1}", 2),
            (100, 5, "y", 0, "text", 1),
            (101, 5, "half", 0, "he", 2),
        ],
    )
    projects = frame(spark, schemas.PROJECTS, [(7, "proj", "ann", "about")])
    datasets = frame(
        spark,
        schemas.DATASETS,
        [
            (70, "data", 7, "d", True, 1),
            (71, "proj_featurestore.db", 7, "f", False, 0),
            (72, "twice_featurestore.db", 7, "f", False, 0),
            (73, "twice_featurestore.db", 7, "f", False, 0),
        ],
    )
    return inodes, users, groups, xattrs, projects, datasets


def log(spark, data):
    df = frame(spark, schemas.FS_MUTATION, [d[1:] for d in data])
    epochs = spark.createDataFrame([(d[3], d[0]) for d in data], "logical_time int, commit_epoch long")
    return df.join(epochs, "logical_time")


# epoch, dataset, inode, logical time, parts, namespace, xattr, op, partition, parent, name
LOG = [
    (1, 10, 100, 1, 0, 0, "", 0, 10, 10, "a"),
    (1, 10, 101, 2, 0, 0, "", 0, 10, 10, "a"),  # the name now belongs to inode 100
    (1, 10, 102, 3, 0, 0, "", 2, 10, 10, "gone"),
    (1, 10, 103, 4, 0, 0, "", 1, 10, 10, "c"),
    (1, 11, 101, 5, 0, 0, "", 4, 10, 10, "b"),
    (2, 10, 100, 6, 2, 5, "x", 10, 10, 10, "a"),
    (2, 10, 100, 7, 1, 5, "y", 12, 10, 10, "a"),
    (2, 10, 100, 8, 1, 5, "none", 10, 10, 10, "a"),
    (2, 10, 101, 9, 2, 5, "half", 10, 10, 10, "b"),
    (2, 10, 100, 10, 0, 0, "y", 13, 10, 10, "a"),
    (2, 10, 100, 11, 0, 0, "", 11, 10, 10, "a"),
    (2, 10, 103, 12, 0, 0, "", 11, 10, 10, "c"),
    (2, 10, 103, 13, 0, 0, "", 99, 10, 10, "c"),
]


def test_dispatch(spark):
    inodes, users, groups, xattrs, projects, datasets = tables(spark)
    ops = mutations.mutation_ops(log(spark, LOG), inodes, users, groups, xattrs, projects, datasets)
    got = {}
    for r in ops.orderBy("seq", "xattr_key").collect():
        got.setdefault(r["log_pk"].split("-")[-1], []).append((r["kind"], r["doc_id"], r["xattr_key"], r["xattr_raw"]))
    assert got == {
        "1": [("UPSERT", "100", None, None)],
        "2": [("DELETE", "101", None, None)],
        "3": [("DELETE", "102", None, None)],
        "4": [("DELETE", "103", None, None)],
        "5": [("UPSERT", "101", None, None)],
        "6": [("UPSERT", "100", "x", '{"k":1}')],
        "7": [("MAP_REMOVE", "100", "y", None), ("UPSERT", "100", "y", "text")],
        "8": [("MAP_REMOVE", "100", "none", None)],
        "10": [("MAP_REMOVE", "100", "y", None)],
        "11": [("UPSERT", "100", "x", '{"k":1}'), ("UPSERT", "100", "y", "text")],
        "12": [("MAP_CLEAR", "103", None, None)],
    }
    first = ops.filter(F.col("log_pk") == "10-100-1").select("fields.*").first().asDict()
    assert first == {
        "doc_type": "inode",
        "parent_id": 10,
        "partition_id": 10,
        "dataset_id": 10,
        "project_id": 7,
        "name": "a",
        "operation": 0,
        "timestamp": 1,
        "size": 7,
        "user": "ann",
        "group": "-1",
        "description": None,
        "public_ds": None,
    }
    waiting = mutations.incomplete_xattr_changes(log(spark, LOG), xattrs)
    assert [r["logical_time"] for r in waiting.collect()] == [9]


def test_without_project_tables_ids_are_missing(spark):
    inodes, users, groups, xattrs, _, _ = tables(spark)
    ops = mutations.mutation_ops(log(spark, LOG[:1]), inodes, users, groups, xattrs)
    assert tuple(ops.select("fields.dataset_id", "fields.project_id").first()) == (-1, -1)


def test_resolve_datasets(spark):
    from tidemark.operators.enrich import resolve_datasets

    inodes, _, _, _, projects, datasets = tables(spark)
    ids = spark.createDataFrame([(10,), (10,), (11,), (12,), (3,), (999,)], "dataset_id long")
    got = rows(resolve_datasets(ids, inodes, projects, datasets))
    assert got == [
        (10, "data", 7, "proj"),
        (11, "proj_featurestore.db", 7, "proj"),
        (12, "twice_featurestore.db", -1, "-1"),
        (3, "proj", -1, "-1"),
        (999, "-1", -1, "-1"),
    ]


def test_admin_ops(spark):
    _, _, _, _, projects, datasets = tables(spark)
    data = [
        (1, 70, 0, 0, 7, 10, 5),
        (2, 70, 0, 1, 7, 10, 5),
        (3, 7, 1, 2, 7, 0, 3),
        (4, 99, 1, 0, 7, 0, 4),
    ]
    ops = frame(spark, schemas.OPS_LOG, data).withColumn("commit_epoch", F.lit(1))
    got = mutations.admin_ops(ops, datasets, projects)
    assert rows(got.select("log_pk", "kind", "doc_id", "event_type", "asset_type")) == [
        ("1", "UPSERT", "10", "add", "datasets"),
        ("2", "DELETE", "5", "delete", "datasets"),
        ("3", "UPSERT", "3", "update", "projects"),
    ]
    docs = {r["doc_id"]: r["doc_type"] for r in fold.fold(got).collect()}
    assert docs == {"10": "ds", "3": "proj"}


def test_app_states(spark):
    from tidemark.operators.docops import app_states

    apps = frame(
        spark,
        schemas.APP_PROV,
        [("a1", "FINISHED", 9, "job", "ann", 1, 2, 5), ("a2", "RUNNING", 9, "job", "ann", 3, 4, 0)],
    ).withColumn("commit_epoch", F.lit(1))
    assert rows(app_states(apps).select("doc_id")) == [
        ("a1-FINISHED-5",),
        ("a1-RUNNING-2",),
        ("a1-SUBMITTED-1",),
        ("a2-RUNNING-4",),
        ("a2-SUBMITTED-3",),
    ]
