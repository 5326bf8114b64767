from conftest import rows

from tidemark.operators import assemble, retention

COLUMNS = "inode_id long, namespace byte, name string, `index` short, value string, num_parts short"
KEY = ["inode_id", "namespace", "name"]


def parts(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def test_parts_in_order_short_long_and_copied(spark):
    df = parts(
        spark,
        [
            (1, 5, "one", 0, "a", 1),
            (1, 5, "three", 2, "c", 3),
            (1, 5, "three", 0, "a", 3),
            (1, 5, "three", 1, "b", 3),
            (1, 5, "short", 0, "a", 2),
            (1, 5, "gap", 0, "a", 2),
            (1, 5, "gap", 2, "c", 2),
            (1, 5, "long", 0, "a", 1),
            (1, 5, "long", 1, "b", 1),
        ]
        + [(1, 5, "copies", i, "xy"[i], 2) for i in (0, 1)] * 30,
    )
    got = {r["name"]: (r["value"], r["complete"]) for r in assemble.assemble(df, KEY).collect()}
    assert got == {
        "one": ("a", True),
        "three": ("abc", True),
        "short": ("a", False),
        "gap": ("a", False),
        "long": ("a", True),
        "copies": ("xy", True),
    }
    strict = {r["name"]: r["value"] for r in assemble.assemble_strict(df, KEY).collect()}
    assert strict["short"] is None and strict["gap"] is None and strict["three"] == "abc"
    loose = {r["name"]: r["value"] for r in assemble.assemble(df, KEY, counted=False).collect()}
    assert loose["long"] == "ab"


def test_part_keys(spark):
    df = spark.createDataFrame([(1, 2), (2, 0)], "k long, num_parts short")
    assert [(r["k"], r["index"]) for r in assemble.part_keys(df).collect()] == [(1, 0), (1, 1)]


def test_companion_parts_leave_other_versions(spark):
    buffer = spark.createDataFrame(
        [(1, 5, "x", 3, 0), (1, 5, "x", 3, 1), (1, 5, "x", 4, 0)],
        "inode_id long, namespace byte, name string, inode_logical_time long, `index` short",
    )
    acked = spark.createDataFrame(
        [((1, 5, "x", 3, 2),), (None,)],
        "companion struct<inode_id long, namespace byte, name string, inode_logical_time long, num_parts short>",
    )
    assert rows(retention.remaining_buffer(buffer, acked)) == [(1, 5, "x", 4, 0)]
