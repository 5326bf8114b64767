"""Keyed lookups as joins: plain, salted for known heavy keys, as-of.

No window or collected group here grows with the number of rows of one key,
so a key that holds a large share of a table does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Keys above 1/64 of the rows are salted, so at most 64 keys can qualify.
HOT_SHARE = 1.0 / 64
SALTS = 64
# Width of a clock chunk: rows of one key in one chunk fit in one task.
CHUNK = 1 << 16


def lookup(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", grows: bool = False
) -> DataFrame:
    """Left rows with the matching right row, whatever the sizes and the skew.

    Stated as a plain join. A written side within Spark's limit is broadcast;
    any other is shuffled, and adaptive execution then decides by the measured
    sizes and splits the partitions that a heavy key fills. With `grows`, for a
    right side that an explode has made and whose size no estimate knows, the
    join sorts both sides and is never a broadcast.
    """
    return left.join(right.hint("merge") if grows else right, on, how)


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than `share` of the rows; at most 1/share of them.

    Reads `df` twice: give it a written table, once per feed.
    """
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    heavy = F.col("_n") > F.col("_total") * F.lit(share)
    return counts.join(F.broadcast(total), heavy).select(*on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    hot: DataFrame,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join whose heavy left keys are spread over `salts` partitions.

    For keys so heavy that splitting a partition does not do. `hot` is the
    bounded list of `hot_keys`, known beforehand, so each side is read once:
    the right rows of its keys are repeated once per salt, all other rows keep
    salt 0. The salt is a hash of the left row, so a re-run task assigns the
    same one.
    """
    marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    spread = [
        f.name
        for f in left.schema.fields
        if f.name not in on and f.dataType.typeName() not in ("map", "variant")
    ]
    row_hash = F.xxhash64(*[F.col(c) for c in spread] or [F.lit(0)])
    salted_left = left.join(marked, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)).cast("int")
    )
    copies = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))
    salted_right = right.join(marked, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), copies))
    )
    return (
        salted_left.drop("_hot")
        .join(salted_right.drop("_hot"), [*on, "_salt"], how)
        .drop("_salt")
    )


def keep_existing(left: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """L6, positive: rows whose key occurs in `keys`.

    Distinct keys make it an inner join. A semi join would be pushed into the
    parts of a union, so that each reads all keys, and a part whose key is a
    constant reads them in a single task.
    """
    return lookup(left, keys.select(*on).distinct(), on, "inner").select(*left.columns)


def keep_missing(
    left: DataFrame, keys: DataFrame, on: list[str], grows: bool = False
) -> DataFrame:
    """L6, negative, and L9: rows whose key does not occur in `keys`."""
    return lookup(left, keys.select(*on).distinct(), on, "left_anti", grows)


def unique_match(df: DataFrame, key: list[str]) -> DataFrame:
    """The row of every key that has exactly one row."""
    rest = [c for c in df.columns if c not in key]
    one = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(*rest)).alias("_row")
    )
    return one.filter(F.col("_n") == 1).select(*key, "_row.*")


def unique_match_strict(df: DataFrame, key: list[str]) -> DataFrame:
    """L7, fatal form: a key with several rows fails the job."""
    rest = [c for c in df.columns if c not in key]
    one = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(*rest)).alias("_row")
    )
    label = F.concat_ws("-", *[F.col(k).cast("string") for k in key])
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("several rows for unique key "), label))
    ).otherwise(F.col("_row"))
    return one.select(*key, checked.alias("_row")).select(*key, "_row.*")


def match_equal(df: DataFrame, **values) -> DataFrame:
    """L4: conjunction of equalities on typed columns, pushed to the scan."""
    condition = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == F.lit(value))
    return df.filter(condition)


def as_of(
    left: DataFrame,
    versions: DataFrame,
    on: list[str],
    clock: str,
    version_clock: str,
    chunk: int = CHUNK,
    points_of: DataFrame | None = None,
) -> DataFrame:
    """Every left row with the latest version at or before its clock.

    A key has at most one version per clock value. The distinct (key, clock) points are resolved, not the rows. Integer
    clocks are cut into chunks: inside a chunk a window sees at most `chunk`
    points and `chunk` versions; the last version of earlier chunks is carried
    over a summary of one row per chunk. The result is then looked up by the
    rows. Left rows without a version
    keep null version columns. `points_of` names a cheaper frame with the same
    keys and clocks as `left`.
    """
    payload = [c for c in versions.columns if c not in on]
    version = F.struct(*[F.col(c) for c in payload])
    points = (
        (left if points_of is None else points_of)
        .select(*on, F.col(clock).cast("long").alias("_t"))
        .distinct()
        .withColumn("_is_point", F.lit(1))
    )
    marks = versions.select(
        *on,
        F.col(version_clock).cast("long").alias("_t"),
        F.lit(0).alias("_is_point"),
        version.alias("_v"),
    )
    inside = (
        Window.partitionBy(*on, "_b")
        .orderBy("_t", "_is_point")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    line = (
        points.unionByName(marks, allowMissingColumns=True)
        .withColumn("_b", F.expr(f"(_t - pmod(_t, {chunk})) div {chunk}"))
        .withColumn("_local", F.last("_v", ignorenulls=True).over(inside))
    )
    # The newest row of a chunk knows the chunk's last version. Both uses of
    # `line` need the same shuffle, which Spark runs once.
    ends = line.groupBy(*on, "_b").agg(
        F.max(F.struct("_t", "_is_point", "_local"))["_local"].alias("_end")
    )
    before = Window.partitionBy(*on).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*on, "_b", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    resolved = (
        line.filter(F.col("_is_point") == 1)
        .join(carry, [*on, "_b"], "left")
        .select(*on, "_t", F.coalesce("_local", "_carry").alias("_v"))
    )
    rows = left.withColumn("_t", F.col(clock).cast("long"))
    return lookup(rows, resolved, [*on, "_t"]).drop("_t").select(*left.columns, "_v.*")
