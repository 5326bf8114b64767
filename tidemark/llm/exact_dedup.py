"""Exact duplicates by a tree-merge of digest runs (native).

Each input partition is a run of (digest, proof) entries with its smallest row
and row count. Rounds merge 2**fan_bits neighbouring runs into one, as in a
binomial tree, until a single run is left. A run is a set keyed by digest, and
a round one hash aggregation: the shuffle that brings equal digests of
neighbouring runs together also spreads each merged run over the cluster. The answer then travels down the same tree, so a
group with a third of all rows meets at most 2**fan_bits entries in a merge,
and at most one partition's rows on the way back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, plain_key, whole_text
from tidemark.session import materialize

FAN_BITS = 4
ENTRY = ["_run", "_digest", "_proof"]


def normal_text(text: str = "text") -> Column:
    """The text with each run of white space as one space.

    Single spaces are left alone by the pattern, which gives the same text as
    replacing every run and touches far fewer places.
    """
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(whole_text(text), runs, " ")


def _merged(run: DataFrame, shift: int) -> DataFrame:
    """One round: the runs that share the upper bits of their number become one."""
    return (
        run.withColumn("_run", F.shiftright("_run", shift))
        .groupBy(*ENTRY)
        .agg(F.min("_first").alias("_first"), F.sum("_rows").alias("_rows"))
    )


def _answered(df: DataFrame, key: str, text: str, fan_bits: int) -> DataFrame:
    """Per row: _key, _row, _raw (hash of the text as it is), _proof, and, for
    texts that occur more than once, _first (the row that stays) and _rows."""
    norm = normal_text(text)
    rows = df.select(
        F.col(key).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
        F.spark_partition_id().alias("_run"),
        F.xxhash64(F.col(text)).alias("_raw"),
        norm.alias("_norm"),
    )
    rows = rows.withColumns(
        {"_digest": F.xxhash64("_norm"), "_proof": F.unhex(F.sha2("_norm", 256))}
    ).drop("_norm")
    rows = materialize(rows, "digests")
    entries = rows.select(
        *ENTRY, F.struct("_key", "_row").alias("_first"), F.lit(1).cast("long").alias("_rows")
    )
    levels = [materialize(_merged(entries, 0), "run")]
    last = rows.agg(F.max("_run")).first()[0] or 0
    while last:
        levels.append(materialize(_merged(levels[-1], fan_bits), "run"))
        last >>= fan_bits

    # Only texts that occur more than once have an answer to carry down.
    answer = levels[-1].filter("_rows > 1").select(*ENTRY, "_first", "_rows")
    for level in reversed(levels[:-1]):
        parents = answer.withColumnRenamed("_run", "_up")
        answer = (
            level.select(*ENTRY, F.shiftright("_run", fan_bits).alias("_up"))
            .join(parents, ["_up", "_digest", "_proof"])
            .select(*ENTRY, "_first", "_rows")
        )
    return rows.join(answer, ENTRY, "left")


def exact_dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", fan_bits: int = FAN_BITS
) -> DataFrame:
    """One row per input row: its key, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after white-space runs become one
    space; null is the empty text. The digest is a 64-bit hash, the proof the
    SHA-256 of the same text: entries merge only when both agree. The smallest
    key of a group stays (null counts as smallest); of rows with that key, the
    first read. Empty tables give no rows. Other columns are ignored, whatever
    their names.
    """
    found = _answered(df, key, text, fan_bits)
    alone = F.col("_rows").isNull()
    return found.select(
        F.col("_key").alias(key),
        F.when(alone, F.col("_key")).otherwise(F.col("_first._key")).alias("keep_id"),
        F.coalesce("_rows", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_first._row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("_proof")).alias("text_sha256"),
    )


def without_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input.

    It is decided on digests; the documents are shuffled once, to meet the keys
    and hashes of those that have copies. Of rows with the same key and text
    one stays.
    """
    found = _answered(df, key, text, FAN_BITS).filter("_rows > 1")
    own = ["_same", "_raw"]
    stays = F.max(F.col("_first._row") == F.col("_row")).alias("_stays")
    copies = materialize(found.select(plain_key("_key").alias("_same"), "_raw", "_first", "_row").groupBy(*own).agg(stays), "copies")
    docs = df.select(
        packed(df).alias("_doc"), plain_key(f"`{key}`").alias("_same"), F.xxhash64(F.col(text)).alias("_raw")
    )
    nth = F.row_number().over(Window.partitionBy(*own).orderBy(*own))
    met = docs.join(copies, own, "left").withColumn("_nth", nth)
    return met.filter("_stays is null or (_stays and _nth = 1)").select("_doc.*")
