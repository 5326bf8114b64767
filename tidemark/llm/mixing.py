"""Mixing sources to target weights by weighted sampling without replacement (native).

Every document gets an exponential key divided by its quality weight; in key
order, a source's documents form a weighted random order. A source's target is
met by complete epochs first and then by the documents of that order up to the
rest of the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, packed, plain_key, whole_text
from tidemark.operators.scans import commit_position
from tidemark.session import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
EPOCHS = 2
SEED = "mix"
# Cells of the key grid at each of its two levels.
CELLS = 1024


def n_words(text: str = "text") -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(whole_text(text), F.lit(f"[^{SPACES}]+")).cast("long")


def label_weight(quality: str = "quality") -> Column:
    """Quality weight by label: 2 for good, 0.5 for poor, 1 where there is none."""
    return F.when(F.col(quality) == 1, 2.0).when(F.col(quality) == 0, 0.5).otherwise(1.0)


def exponential_key(key: str, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight, with u in (0, 1) from a digest of seed and key: reruns agree."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS
) -> DataFrame:
    """(_source, source_size) with weight and target.

    Weights repeat along the order of the sources. The level is what one unit
    of weight gets; sources whose cap lies below their share leave the sharing
    and the level rises, until no other source is above its cap. Each round
    brings three sums to the driver.
    """
    ranked = commit_position(sources, ["_source"], "_place")
    at = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    ranked = materialize(
        ranked.select(
            "_source",
            "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1).alias("weight"),
            (F.col("source_size") * float(epochs)).alias("_cap"),
        ),
        "sources",
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") < F.col("weight") * level
        n, held, weight = ranked.agg(
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not weight:
            break
        level, capped = (total - held) / weight, n
    return ranked.withColumn("target", F.least("_cap", F.col("weight") * level)).drop("_cap")


def _crossing(cells: DataFrame, cell: str) -> DataFrame:
    """Per source, the cell of the grid where its running size crosses `_rest`.

    A source has at most CELLS cells, whatever its number of documents.
    """
    along = Window.partitionBy("_source").orderBy(cell)
    running = F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        cells.withColumn("_end", F.col("_before") + running)
        .filter((F.col("_end") - F.col("_sum") <= F.col("_rest")) & (F.col("_end") > F.col("_rest")))
        .withColumn("_before", F.col("_end") - F.col("_sum"))
        .drop("_end", "_sum")
    )


def _drawn(
    df: DataFrame,
    labels: DataFrame,
    key: str,
    source: str,
    text: str,
    weights: Sequence[int],
    budget: float,
    epochs: int,
    seed: str,
) -> DataFrame:
    """Per row: _key, _source, _raw (hash of the text), size, source_size, target,
    _epochs, and _again: whether it is taken once more."""
    given = df.select(
        F.col(key).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
        # Code-point order of this string is that of the sources, null last.
        plain_key(f"`{source}`").alias("_source"),
        F.xxhash64(F.col(text)).alias("_raw"),
        n_words(text).alias("size"),
    )
    given = materialize(given, "mix")
    marks = labels.groupBy(F.col(key).alias("_key")).agg(F.max("quality").alias("quality"))
    drawn = exponential_key("_key", label_weight(), seed)
    spot = (F.lit(1.0) - F.exp(-F.col("_draw"))) * CELLS
    rows = (
        given.join(marks, "_key", "left")
        .select("_key", "_row", "_source", "_raw", "size", drawn.alias("_draw"))
        .withColumn("_cell", F.floor(spot).cast("int"))
        .withColumn("_fine", F.floor((spot - F.col("_cell")) * CELLS).cast("int"))
    )
    rows = materialize(rows, "draws")

    cells = rows.groupBy("_source", "_cell").agg(F.sum("size").alias("_sum"))
    cells = materialize(cells, "cells")
    sources = source_targets(
        cells.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, budget, epochs
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    sources = sources.withColumn("_epochs", F.coalesce(whole, F.lit(0)).cast("int"))
    sources = materialize(
        sources.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")),
        "targets",
    )

    # Where each source's order crosses the rest: grid cell, finer cell, document.
    start = sources.filter("_rest > 0").select("_source", "_rest", F.lit(0).cast("long").alias("_before"))
    coarse = materialize(_crossing(cells.join(start, "_source"), "_cell"), "coarse")
    near = rows.select("_source", "_cell", "_fine", "size", "_draw", "_key", "_row").join(
        coarse, ["_source", "_cell"]
    )
    near = materialize(near, "near")
    fine = _crossing(
        near.groupBy("_source", "_rest", "_before", "_fine").agg(F.sum("size").alias("_sum")), "_fine"
    )
    exact = near.drop("_rest", "_before").join(fine, ["_source", "_fine"])
    order = Window.partitionBy("_source").orderBy("_draw", "_key", "_row")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    place = F.struct("_cell", "_fine", "_draw", "_key", "_row")
    taken = exact.withColumn("_end", F.col("_before") + end).filter(
        2 * F.col("_end") - F.col("size") <= 2 * F.col("_rest")
    )
    cut = taken.groupBy("_source").agg(F.max(place).alias("_last"))
    # With nothing taken in the finest cell, all before it is taken.
    edge = fine.join(coarse.select("_source", "_cell"), "_source").select("_source", "_cell", "_fine")
    limits = (
        sources.select("_source", "source_size", "target", "_epochs", "_rest")
        .join(edge.withColumnsRenamed({"_cell": "_c", "_fine": "_f"}), "_source", "left")
        .join(cut, "_source", "left")
    )
    limits = materialize(limits, "limits")
    before = (F.col("_cell") < F.col("_c")) | (
        (F.col("_cell") == F.col("_c")) & (F.col("_fine") < F.col("_f"))
    )
    within = F.col("_last").isNotNull() & (place <= F.col("_last"))
    again = F.coalesce((F.col("_rest") > 0) & (before | within), F.lit(False))
    picked = ["_key", "_source", "_raw", "size", "source_size", "target", "_epochs"]
    return rows.join(limits, "_source").select(*picked, again.cast("int").alias("_again"))


def mix(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: key, size, source_size, target, repeats, taken.

    `labels` has the key and `quality`, which weighs the sampling; of several
    labels of one key the best counts. Whole documents are taken. After the
    complete epochs, a document is taken once more if at least half of it lies
    within what is left of the target in the order of its source; equal keys
    go by id, then by place in the input. So a source misses its target by at
    most half a document. Null sources are one source, the last; null texts
    have size 0; repeated rows are documents of their own. Empty tables give
    no rows. Other columns are ignored.
    """
    repeats = F.col("_epochs") + F.col("_again")
    return _drawn(df, labels, key, source, text, weights, budget, epochs, seed).select(
        F.col("_key").alias(key),
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (repeats * F.col("size")).cast("long").alias("taken"),
    )


def mixed(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, input columns only.

    It is decided on keys and sizes; the documents are shuffled once. Of rows
    with the same key, source and text as many are taken once more as the
    order took, whichever of them these are.
    """
    own = ["_same", "_source", "_raw"]
    drawn = _drawn(df, labels, key, source, text, weights, budget, epochs, seed)
    times = drawn.select(plain_key("_key").alias("_same"), "_source", "_raw", "_epochs", "_again").groupBy(*own)
    times = times.agg(F.max("_epochs").alias("_epochs"), F.sum("_again").alias("_more"))
    times = materialize(times.filter("_epochs > 0 or _more > 0"), "times")
    docs = df.select(
        packed(df).alias("_doc"),
        plain_key(f"`{key}`").alias("_same"),
        plain_key(f"`{source}`").alias("_source"),
        F.xxhash64(F.col(text)).alias("_raw"),
    )
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(*own))
    met = docs.join(times, own).withColumn("_nth", nth)
    met = met.withColumn("_times", F.col("_epochs") + (F.col("_nth") <= F.col("_more")).cast("int"))
    return met.filter("_times > 0").withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select("_doc.*")
