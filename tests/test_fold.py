import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import fold

OPS = (
    "index string, doc_id string, seq struct<epoch long, op_no int>, kind string, "
    "fields struct<a long, b string, c string>, xattr_key string, xattr_raw string, "
    "create_if_absent boolean"
)


def random_ops(seed, n=400):
    rng = random.Random(seed)
    ops = []
    for i in range(n):
        doc = "hot" if rng.random() < 0.4 else f"d{rng.randrange(12)}"
        kind = rng.choices(["UPSERT", "SET", "MAP_REMOVE", "MAP_CLEAR", "DELETE"], [6, 5, 2, 1, 1])[0]
        key, raw, body, create = None, None, None, True
        if kind == "UPSERT":
            body = (rng.choice([None, i]), rng.choice([None, f"b{i}"]), rng.choice([None, f"c{i}"]))
        elif kind == "SET":
            kind, key, raw = "UPSERT", f"k{rng.randrange(3)}", f"v{i}"
        elif kind == "MAP_REMOVE":
            key, create = f"k{rng.randrange(3)}", rng.random() < 0.5
        ops.append((f"i{rng.randrange(2)}", doc, (i, 0), kind, body, key, raw, create))
    return ops


def replay(ops):
    """The documents after applying the operations one by one."""
    docs = {}
    for index, doc_id, _, kind, body, key, raw, create in sorted(ops, key=lambda o: o[2]):
        place = (index, doc_id)
        if kind == "DELETE":
            docs.pop(place, None)
            continue
        if place not in docs:
            if kind != "UPSERT" and not create:
                continue
            docs[place] = ({}, {})
        fields, xattrs = docs[place]
        if kind == "MAP_CLEAR":
            xattrs.clear()
        elif kind == "MAP_REMOVE":
            xattrs.pop(key, None)
        else:
            for name, value in zip("abc", body or (None,) * 3):
                if value is not None:
                    fields[name] = value
            if key is not None:
                xattrs[key] = raw
    return docs


def as_dict(df):
    return {
        (r["index"], r["doc_id"]): (
            {n: r[n] for n in "abc" if r[n] is not None},
            dict(r["xattrs"] or {}),
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", range(4))
def test_fold_equals_replay_for_any_order(spark, seed):
    ops = random_ops(seed)
    shuffled = ops[:]
    random.Random(seed + 100).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, OPS).repartition(5)
    assert as_dict(fold.fold_whole(df)) == replay(ops)


def test_applying_twice_changes_nothing(spark):
    df = spark.createDataFrame(random_ops(9), OPS)
    assert rows(fold.fold(df.unionByName(df))) == rows(fold.fold(df))
    assert rows(fold.fold_entries(df.unionByName(df))) == rows(fold.fold_entries(df))


def test_partial_states_merge_to_the_whole(spark):
    df = spark.createDataFrame(random_ops(11), OPS)
    first, second = df.filter("seq.epoch % 3 = 0"), df.filter("seq.epoch % 3 <> 0")
    merged = fold.merge_docs(fold.doc_state(first).unionByName(fold.doc_state(second)))
    assert rows(fold.documents(merged)) == rows(fold.fold(df))
    merged = fold.merge_entries(fold.entry_state(first).unionByName(fold.entry_state(second)))
    assert rows(fold.entries(merged)) == rows(fold.fold_entries(df))


def test_groups_keep_the_newest_write_of_all_members(spark):
    ops = [
        ("i", "d", (1, 0), "UPSERT", (1, "b1", "c1"), None, None, True),
        ("i", "d", (2, 0), "UPSERT", (2, "b2", None), None, None, True),
    ]
    got = fold.fold(spark.createDataFrame(ops, OPS), [["a", "b"]]).select("a", "b", "c").first()
    assert tuple(got) == (2, "b2", "c1")


def test_removal_alone_creates_only_when_asked(spark):
    ops = [
        ("i", "absent", (1, 0), "MAP_REMOVE", None, "k", None, False),
        ("i", "empty", (1, 0), "MAP_REMOVE", None, "k", None, True),
    ]
    assert [r["doc_id"] for r in fold.fold(spark.createDataFrame(ops, OPS)).collect()] == ["empty"]


def test_fold_has_one_shuffle(spark):
    df = spark.createDataFrame(random_ops(1), OPS).withColumn("x", F.lit(1))
    plan = fold.fold(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
