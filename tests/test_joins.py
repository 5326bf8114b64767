import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import joins, retention


def skewed(spark, n=600):
    rng = random.Random(3)
    left = [(i, 1 if rng.random() < 0.4 else (None if rng.random() < 0.1 else rng.randrange(50))) for i in range(n)]
    right = [(k, f"v{k}") for k in range(0, 50, 2)] + [(1, "hot")]
    return left, right, spark.createDataFrame(left, "id long, k long"), spark.createDataFrame(right, "k long, v string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    _, _, left, right = skewed(spark)
    plain = left.join(right, ["k"], how)
    hot = joins.hot_keys(left, ["k"], 0.2)
    salted = joins.salted_join(left, right, ["k"], hot, how).select(plain.columns)
    assert rows(salted) == rows(plain)
    assert rows(joins.lookup(left, right, ["k"], how, grows=True)) == rows(plain)


def test_a_side_that_an_explode_made_is_never_broadcast(spark):
    left = spark.range(5).withColumnRenamed("id", "k")
    right = spark.range(3).selectExpr("explode(sequence(id, id + 2)) as k")
    plan = joins.lookup(left, right, ["k"], grows=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_salted_join_spreads_the_hot_key(spark):
    _, _, left, _ = skewed(spark)
    hot = joins.hot_keys(left, ["k"], 0.2)
    assert rows(hot) == [(1,)]


def test_as_of_matches_brute_force(spark):
    rng = random.Random(5)
    versions = sorted({(rng.randrange(4), rng.randrange(200)) for _ in range(60)})
    points = [(i, 0 if i % 3 else rng.randrange(6), rng.randrange(220)) for i in range(500)]
    left = spark.createDataFrame(points, "id long, k long, t int")
    right = spark.createDataFrame([(k, v, f"{k}@{v}") for k, v in versions], "k long, vt int, name string")
    got = joins.as_of(left, right, ["k"], "t", "vt", chunk=8)
    assert got.columns == ["id", "k", "t", "vt", "name"]
    for r in got.collect():
        older = [v for k, v in versions if k == r["k"] and v <= r["t"]]
        assert r["vt"] == (max(older) if older else None)
    assert got.count() == len(points)


def test_unique_match(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k long, v string")
    assert rows(joins.unique_match(df, ["k"])) == [(1, "a")]
    with pytest.raises(Exception, match="several rows for unique key"):
        joins.unique_match_strict(df, ["k"]).collect()


def test_existence_and_delete(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k long")
    assert rows(joins.keep_existing(df, keys, ["k"])) == [(2,)]
    left, gone = retention.delete_matching(df, keys, ["k"])
    assert rows(left) == [(1,), (3,)] and gone.first()["deleted"] == 1
    again, gone = retention.delete_matching(left, keys, ["k"])
    assert rows(again) == [(1,), (3,)] and gone.first()["deleted"] == 0


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 2 as searchable", "id * 2 as other").write.parquet(f"{tmp_path}/t")
    df = joins.match_equal(spark.read.parquet(f"{tmp_path}/t"), searchable=1).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(searchable,1)" in plan and "other" not in plan


def test_existing_keys_are_read_once_for_a_union(spark):
    """A part with a constant key would otherwise join all keys in one task."""
    many = spark.range(1000).select(F.col("id"), F.lit("row").alias("kind"))
    one = spark.range(1).select(F.lit(2).cast("long").alias("id"), F.lit("root").alias("kind"))
    keys = spark.range(0, 1000, 2).union(spark.range(0, 10, 2))
    kept = joins.keep_existing(many.union(one), keys, ["id"])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "Join " in line]) == 1
    assert rows(kept) == sorted([*[(i, "row") for i in range(0, 1000, 2)], (2, "root")], key=repr)
    assert kept.columns == ["id", "kind"]
