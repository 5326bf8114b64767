import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fold, sink
from tidemark.operators.docops import PROVENANCE_GROUPS
from tidemark.plans import provenance
from tidemark.session import materialize
from tidemark.sources import schemas

DS = 50
INODES = "parent_id long, name string, partition_id long, id long"
MODES = {1: "none", 2: "state", 3: "ALL"}


def core(mode, project=100):
    return json.dumps({"project_iid": project, "prov_type": {"prov_status": mode}})


def change(op, clock, inode=60, name="m1", xattr="", parts=0, ds_clock=None, project=100, part=False):
    """A change of an experiment directly below the dataset, or of a file in it."""
    name = "application_1_2_3" if not part else "file"
    parent, parent_name = (DS, "") if not part else (60, "application_1_2_3")
    return (
        inode, op, clock, 1564997115000 + clock, "app", 1, "tb", parent, project, DS, parent, name,
        "Proj", "Experiments", "", "", parent_name, "ann", xattr, clock, 0,
        clock if ds_clock is None else ds_clock, parts,
    )


def run(spark, changes, buffer):
    rows = spark.createDataFrame(changes, schemas.struct(schemas.FILE_PROV)).withColumn(
        "commit_epoch", F.lit(1).cast("long")
    )
    inodes = spark.createDataFrame(
        [
            (2, "MyProject", 2, 100),
            (DS, "application_1_2_3", DS, 60),
            (60, "file", 60, 61),
        ],
        INODES,
    )
    stored = spark.createDataFrame(buffer, schemas.struct(schemas.XATTR_BUFFER))
    # Written tables have a known size, so small lookups are broadcast.
    written = [materialize(df, "test") for df in (rows, inodes, stored)]
    return sink.split_problems(materialize(provenance.enriched(*written), "test"))


def steps(good):
    ops = provenance.provenance_ops(good).orderBy("seq").collect()
    out = {}
    for r in ops:
        name = {"UPSERT": "set", "DELETE": "dead", "MAP_REMOVE": "unset"}[r["kind"]]
        if r["kind"] == "UPSERT" and r["fields"]["entry_type"]:
            name = r["fields"]["entry_type"]
        out.setdefault(r["seq"]["io_logical_time"], []).append(name)
    return out


def versions(mode, at=0):
    return [(DS, 5, "core", at, 0, core(mode), 1)]


EXPECTED = {
    # op: (NONE, STATE, ALL), part under ALL
    "CREATE": ([], ["state"], ["state", "operation"], ["operation"]),
    "DELETE": ([], ["dead"], ["dead", "operation"], ["operation"]),
    "MODIFY_DATA": ([], [], ["operation"], ["operation"]),
    "ACCESS_DATA": ([], [], ["operation"], ["operation"]),
    "XATTR_ADD": ([], ["unset", "set"], ["unset", "set", "operation"], ["operation"]),
    "XATTR_UPDATE": ([], ["unset", "set"], ["unset", "set", "operation"], ["operation"]),
    "XATTR_DELETE": ([], ["unset"], ["unset", "operation"], ["operation"]),
    "METADATA": ([], [], [], []),
    "OTHER": ([], [], [], []),
}


@pytest.mark.parametrize("column", range(4), ids=["none", "state", "all", "part"])
def test_routing(spark, column):
    part = column == 3
    inode, mode = (61, "ALL") if part else (60, ["NONE", "STATE", "ALL"][column])
    changes, buffer = [], versions(mode)
    for clock, op in enumerate(EXPECTED, 10):
        xattr = ("x", 2) if op.startswith("XATTR") else ("", 0)
        changes.append(change(op, clock, inode=inode, xattr=xattr[0], parts=xattr[1], part=part))
        buffer += [(inode, 5, "x", clock, 0, '{"a":', 2), (inode, 5, "x", clock, 1, "1}", 2)]
    got = steps(run(spark, changes, buffer)[0])
    for clock, op in enumerate(EXPECTED, 10):
        assert got.get(clock, []) == EXPECTED[op][column], op


def test_store_mode_follows_the_dataset_clock(spark):
    buffer = versions("state", 5) + versions("none", 8)
    good, _ = run(spark, [change("CREATE", c) for c in (4, 5, 7, 8, 9)], buffer)
    # Before the first version everything is recorded.
    assert steps(good) == {4: ["state", "operation"], 5: ["state"], 7: ["state"]}
    acked = provenance.acknowledged(good)
    assert acked.count() == 5


def test_mode_change_writes_state_first_and_frees_the_older_version(spark):
    buffer = versions("ALL", 1) + [(60, 5, "core", 10, 0, core("NONE"), 1)]
    good, _ = run(spark, [change("XATTR_ADD", 10, xattr="core", parts=1)], buffer)
    assert steps(good) == {10: ["dead"]}
    companion = provenance.acknowledged(good).first()["companion"]
    assert (companion["inode_id"], companion["inode_logical_time"]) == (DS, 1)
    buffer = versions("NONE", 1) + [(60, 5, "core", 10, 0, core("state"), 1)]
    good, _ = run(spark, [change("XATTR_ADD", 10, xattr="core", parts=1)], buffer)
    assert steps(good) == {10: ["state", "unset", "set"]}


def test_unknown_project_is_taken_from_the_store_mode(spark):
    good, _ = run(spark, [change("CREATE", 10, project=-1)], versions("STATE"))
    op = provenance.provenance_ops(good).first()
    assert op["index"] == "100__file_prov"
    assert (op["fields"]["project_i_id"], op["fields"]["project_name"]) == (100, "MyProject")
    good, _ = run(spark, [change("CREATE", 10, project=-1)], [(DS, 5, "x", 0, 0, "v", 1)])
    assert steps(good) == {} and good.count() == 1


def test_missing_project_or_value_is_skipped_but_acknowledged(spark):
    changes = [change("CREATE", 10, project=7), change("XATTR_ADD", 11, xattr="gone", parts=1)]
    good, bad = run(spark, changes, [(DS, 5, "other", 0, 0, "v", 1)])
    assert steps(good) == {}
    assert provenance.acknowledged(good).count() == 2 and bad.count() == 0


def test_only_viewable_inodes_unless_deleted(spark):
    changes = [change("CREATE", 10, inode=77), change("DELETE", 11, inode=77)]
    good, _ = run(spark, changes, versions("ALL"))
    assert steps(good) == {11: ["dead", "operation"]}


def test_problems_are_quarantined(spark):
    changes = [change("TRUNCATE", 1), change("CREATE", 10), change("CREATE", 20)]
    buffer = versions("odd", 5) + [(DS, 5, "core", 15, 0, "part", 2)]
    good, bad = run(spark, changes, buffer)
    assert good.count() == 0
    problems = {r["io_logical_time"]: r["problem"] for r in bad.collect()}
    assert problems == {1: "unknown operation", 10: "bad store mode", 20: "bad store mode"}
    rows = bad.limit(1)
    with pytest.raises(Exception, match="bad store mode|unknown operation"):
        sink.split_problems(rows, fail_fast=True)[0].collect()


def test_documents(spark):
    changes = [
        change("CREATE", 10),
        change("XATTR_ADD", 11, xattr="x", parts=1),
        change("XATTR_ADD", 12, xattr="project_iid", parts=1),
        change("XATTR_DELETE", 13, xattr="x", parts=1),
    ]
    buffer = versions("STATE") + [(60, 5, "x", 11, 0, "v", 1), (60, 5, "project_iid", 12, 0, "100", 1)]
    good, _ = run(spark, changes, buffer)
    docs = fold.fold_whole(provenance.provenance_ops(good), PROVENANCE_GROUPS).collect()
    assert len(docs) == 1
    doc = docs[0]
    assert (doc["doc_id"], doc["ml_type"], doc["ml_id"]) == ("60", "EXPERIMENT", "application_1_2_3")
    assert doc["r_create_timestamp"] == "2019.Aug.5 9:25:15"
    assert doc["xattrs"] == {"project_iid": "100"}


def test_the_projects_are_written_so_that_their_size_is_known(spark, monkeypatch):
    written = {}

    def keep(df, label):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(provenance, "materialize", keep)
    run(spark, [change("CREATE", 10)], versions("ALL"))
    assert [tuple(r) for r in written["projects"].collect()] == [(100, "MyProject")]
