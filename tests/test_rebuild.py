from conftest import rows

from tidemark.operators import fold
from tidemark.plans import rebuild
from tidemark.sources import schemas


def frame(spark, ddl, data):
    return spark.createDataFrame(data, schemas.struct(ddl))


def inode(parent, name, number, is_dir=True, xattrs=0):
    return (parent, name, parent, number, 1, 1, 1, 0, is_dir, xattrs, 0)


def tables(spark, depth=40):
    chain = [inode(10 if i == 0 else 199 + i, f"d{i}", 200 + i) for i in range(depth)]
    inodes = frame(
        spark,
        schemas.INODES,
        [
            inode(1, "Projects", 2),
            inode(2, "proj", 3),
            inode(3, "data", 10),
            inode(3, "empty", 11),
            *chain,
            inode(200 + depth - 1, "leaf", 900, is_dir=False, xattrs=1),
            inode(900, "below a file", 901),
            inode(77, "outside", 78),
            inode(78, "outside too", 79),
            inode(81, "cycle a", 80),
            inode(80, "cycle b", 81),
            (10, "other partition", 5, 902, 1, 1, 1, 0, False, 0, 0),
            inode(10, "marked", 903, is_dir=False, xattrs=1),
        ],
    )
    projects = frame(spark, schemas.PROJECTS, [(7, "proj", "ann", "about"), (8, "lost", "bob", "")])
    datasets = frame(
        spark,
        schemas.DATASETS,
        [(70, "data", 7, "d", True, 1), (71, "empty", 7, "e", False, 1), (72, "lost", 8, "l", False, 1)],
    )
    xattrs = frame(spark, schemas.XATTRS, [(900, 5, "x", 0, "v", 1), (10, 5, "unmarked", 0, "v", 1)])
    users = frame(spark, schemas.USERS, [(1, "ann")])
    groups = frame(spark, schemas.GROUPS, [(1, "staff")])
    return projects, datasets, inodes, users, groups, xattrs


def test_descendants_of_a_deep_tree(spark):
    projects, datasets, inodes, _, _, _ = tables(spark)
    roots = rebuild.dataset_roots(projects, datasets, inodes).filter("dataset_inode is not null")
    below = rebuild.descendants(inodes, roots)
    got = {r["id"]: (r["dataset_id"], r["project_id"]) for r in below.collect()}
    assert set(got) == {*range(200, 240), 900, 903}
    assert set(got.values()) == {(10, 7)}
    counts = rebuild.dataset_counts(below, roots).collect()
    assert [tuple(r) for r in counts] == [(11, "empty", 0), (10, "data", 42)]


def test_rebuilt_documents_and_totals(spark):
    projects, datasets, inodes, users, groups, xattrs = tables(spark, depth=3)
    ops = rebuild.rebuild_ops(projects, datasets, inodes, users, groups, xattrs)
    docs = {r["doc_id"]: r for r in fold.fold_whole(ops).collect()}
    assert set(docs) == {"3", "10", "11", "200", "201", "202", "900", "903"}
    assert docs["3"]["doc_type"] == "proj" and docs["10"]["doc_type"] == "ds"
    assert docs["900"]["xattrs"] == {"x": "v"} and docs["10"]["xattrs"] is None
    assert docs["900"]["operation"] is None and docs["900"]["user"] == "ann"
    total = rebuild.totals(projects, datasets, inodes, xattrs).first().asDict()
    assert total == {
        "projects": 2,
        "missing_projects": 1,
        "datasets": 2,
        "missing_datasets": 1,
        "inodes": 5,
        "xattrs": 1,
        "missing_xattrs": 1,
        "cyclic_directories": 2,
        "documents": 8,
    }


def test_no_datasets(spark):
    _, datasets, inodes, _, _, _ = tables(spark, depth=2)
    none = frame(spark, schemas.PROJECTS, [(99, "nobody", "", "")])
    roots = rebuild.dataset_roots(none, datasets, inodes).filter("dataset_inode is not null")
    assert rows(rebuild.descendants(inodes, roots)) == []
