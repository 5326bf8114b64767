"""MinHash near-dedup: banded minima, verification, alternating stars.

Each distinct shingle set is a class, whatever the number of its copies. Its
signature holds the minima of many universal hashes; classes that agree on all
minima of a band share a bucket. Pairs of a bucket are held against each other on
their signatures first and on their whole sets after that, and links become
components by alternating large-star and small-star.

A bucket may hold a third of all classes. Up to a few members all their pairs are
candidates. In a larger one members meet its first; what then still is of another
component than most members meets all members in blocks, which compare signatures
and sets inside a task and hand on what joins two components. So no link between
components is missed, and no bucket's pairs are ever written out.
"""

from __future__ import annotations

import hashlib
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import mix, shingle_sets
from tidemark.llm.common import arrow_map, ship
from tidemark.llm.components import stars
from tidemark.llm.jaccard import KeyFilter, same_document
from tidemark.session import materialize

# Contract of op13: three words, 85 of 100.
WORDS, SIMILAR = 3, 85
# Two sets of similarity 0.85 share none of 40 bands of 7 minima with a chance of 2e-7.
BANDS, ROWS = 40, 7
# Estimates so many standard deviations below the similarity asked for are still verified.
DEVIATIONS = 5
# Buckets up to this size have their pairs listed; members of a block of a larger one.
SMALL, BLOCK = 8, 1024
# Leads of large buckets that a class is held against first.
LEADS = 3
# Shingles of a block's members, on either side; a longer set stands alone.
BLOCK_SHINGLES = 1 << 19
# Rounds at most that verify one candidate a class; the next takes all that are left.
PICKY_ROUNDS = 3
# Shingles hashed at once, so that they stay in the processor's cache.
CHUNK = 1 << 15


def hash_family(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of `count` universal hashes x -> a x + b modulo 2**64."""
    at = np.arange(1, count + 1, dtype=np.uint64)
    return mix(at, 2 * seed) | np.uint64(1), mix(at, 2 * seed + 1)


def minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """A row of `count` minima for each set; sets are not empty."""
    a, b = hash_family(count)
    out = np.empty((len(sets), count), dtype=np.uint64)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= CHUNK):
            size += len(sets[last])
            last += 1
        joined = np.concatenate(sets[first:last])
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[first : last - 1]]))).astype(np.int64)
        for i in range(count):
            out[first:last, i] = np.minimum.reduceat(joined * a[i] + b[i], starts)
        first = last
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band; the band's number is part of it."""
    each = values.reshape(len(values), bands, rows)
    key = np.zeros((len(values), bands), dtype=np.uint64)
    for j in range(rows):
        key = mix(key + each[:, :, j], j + 1)
    return mix(key + np.arange(bands, dtype=np.uint64), rows + 1)


def least_agreement(similar: int, count: int) -> int:
    """Minima that must agree, in 8 bits each, for a pair to be verified."""
    p = similar / 100 + (1 - similar / 100) / 256
    return max(0, int(count * p - DEVIATIONS * sqrt(count * p * (1 - p))))


def profiles(df: DataFrame, key: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """Per row: _id, _hash (of the text), n_shingles, node (class of its set), signature, bands."""
    kind = df.schema[key].dataType.simpleString()
    names = ["_id", "_hash", "n_shingles", "node", "signature", "bands"]

    def work(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(2).to_pylist(), k))
            full = [s for s in sets if len(s)]
            values = minima(full, bands * rows) if full else np.empty((0, bands * rows), np.uint64)
            keys = band_keys(values, bands, rows).view(np.int64)
            signs = (mix(values, 5) >> np.uint64(56)).astype(np.uint8)
            at = iter(range(len(full)))
            place = [next(at) if len(s) else None for s in sets]
            node = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.array([None if i is None else signs[i].tobytes() for i in place], pa.binary()),
                    pa.array([None if i is None else keys[i] for i in place], pa.list_(pa.int64())),
                ],
                names=names,
            )

    body = F.col(f"`{text}`").cast("string")
    schema = f"_id {kind}, _hash long, n_shingles long, node binary, signature binary, bands array<long>"
    found = arrow_map(df.select(F.col(f"`{key}`"), F.xxhash64(body), body), work, schema)
    return materialize(found, "signatures")


def classes(profile: DataFrame) -> DataFrame:
    """One row per distinct set: _class (a number), node, n, _first (its first document), signature, bands."""
    rows = profile.filter("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n"),
        F.min(F.struct("_id", "_hash")).alias("_first"),
        F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    return materialize(rows.withColumn("_class", F.monotonically_increasing_id()), "classes")


def buckets(named: DataFrame) -> DataFrame:
    """bucket, _class, n, size, lead: the members of all buckets of two classes or more."""
    posts = named.select("_class", "n", F.explode("bands").alias("bucket"))
    sizes = posts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("_class", "n")).alias("lead")
    )
    return materialize(posts.join(sizes.filter("size > 1"), "bucket"), "buckets")


def _lengths(n: Column, m: Column, similar: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * similar


def first_pairs(members: DataFrame, similar: int) -> DataFrame:
    """a, b: all pairs of small buckets; of larger ones each member with the leads it meets most.

    What that leaves out, `block_pairs` finds.
    """
    few = members.filter(F.col("size") <= SMALL).groupBy("bucket").agg(
        F.sort_array(F.collect_list(F.struct("_class", "n"))).alias("all")
    )
    pairs = F.flatten(
        F.transform(
            "all",
            lambda x, i: F.transform(
                F.filter(F.slice("all", i + 2, SMALL), lambda y: _lengths(x["n"], y["n"], similar)),
                lambda y: F.struct(x["_class"].alias("a"), y["_class"].alias("b")),
            ),
        )
    )
    many = members.filter((F.col("size") > SMALL) & (F.col("_class") != F.col("lead._class")))
    many = many.filter(_lengths(F.col("n"), F.col("lead.n"), similar))
    # The leads that a member meets in most of its buckets, at most one a band, are its likeliest links.
    met = many.groupBy("_class", F.col("lead._class").alias("a")).agg(F.count(F.lit(1)).alias("times"))
    leads = met.groupBy("_class").agg(F.sort_array(F.collect_list(F.struct((-F.col("times")).alias("less"), "a"))).alias("all"))
    star = leads.select(F.explode(F.slice(F.col("all.a"), 1, LEADS)).alias("a"), F.col("_class").alias("b"))
    return few.select(F.explode(pairs).alias("p")).select("p.a", "p.b").union(star).distinct()


def scored(pairs: DataFrame, named: DataFrame, least: int) -> DataFrame:
    """a, b, agree: pairs whose signatures agree often enough."""
    ship(named.sparkSession)

    @F.arrow_udf("int")
    def agreement(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array((_matrix(x) == _matrix(y)).sum(axis=1, dtype=np.int32))

    left, right = (named.select(F.col("_class").alias(c), F.col("signature").alias(f"_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", agreement("_a", "_b").alias("agree")).filter(F.col("agree") >= least)


def _matrix(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(len(raw), -1 if raw else 1)


def block_pairs(members: DataFrame, named: DataFrame, labels: DataFrame, sets: Sets, similar: int, least: int) -> DataFrame:
    """a, b, agree: for each class the likeliest links to other components in its large buckets.

    Members whose label is not that of most of the bucket meet all members, in
    blocks of a bounded size. A task compares the signatures of a block, then the
    sets of pairs that may link (as 32-bit hashes, which can only add links), and
    hands on at most two links of a member to any other label: one joins the
    components, so the rest are not needed. Pairs of one label, the bulk of a
    group of near copies, meet nowhere.
    """
    held = labels.select(F.col("node").alias("_class"), F.col("component").alias("label"))
    large = members.filter(F.col("size") > SMALL).select("bucket", "_class", "n")
    large = large.join(held, "_class", "left").withColumn("label", F.coalesce("label", "_class"))
    each = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    counts = each.groupBy("bucket").agg(
        F.sum("c").alias("size"),
        F.sum("n").alias("total"),
        F.max(F.struct("c", "label", "n")).alias("most"),
        F.count(F.lit(1)).alias("kinds"),
    )
    cells = lambda c, n: F.ceil(F.greatest(c / BLOCK, n / BLOCK_SHINGLES)).cast("int")
    open_ = counts.filter("kinds > 1").select(
        "bucket",
        F.col("most.label").alias("most"),
        cells(F.col("size") - F.col("most.c"), F.col("total") - F.col("most.n")).alias("down"),
        cells(F.col("size"), F.col("total")).alias("across"),
    )
    rows = materialize(large.join(open_, "bucket"), "open")
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "a long, b long, agree int")
    whole = sets.of(rows.select("_class").distinct())
    cut = F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int"))
    profile = materialize(named.select("_class", "signature").join(whole.select("_class", cut.alias("cut")), "_class"), "asked")
    spread = lambda n: F.pmod(F.xxhash64("_class"), n.cast("long")).cast("int")
    count = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    down, across = F.col("down"), F.col("across")
    columns = ["bucket", "i", "j", "asks", "_class", "label", "n", "signature", "cut"]
    asks = rows.filter(F.col("label") != F.col("most"))
    asks = asks.withColumns({"i": spread(down), "asks": F.lit(True)}).withColumn("j", count(across))
    rest = rows.withColumns({"j": spread(across), "asks": F.lit(False)}).withColumn("i", count(down))
    both = asks.select(columns[:-2]).union(rest.select(columns[:-2])).join(profile, "_class").select(columns)

    def compare(table: pa.Table) -> pa.Table:
        flag = np.array(table.column("asks").to_pylist(), dtype=bool)
        ids = table.column("_class").to_numpy()
        marks, n = table.column("label").to_numpy(), table.column("n").to_numpy()
        signs = _matrix(table.column("signature"))
        cuts = table.column("cut").combine_chunks()
        ends, values = cuts.offsets.to_numpy(), cuts.values.to_numpy()
        left, right = np.flatnonzero(flag), np.flatnonzero(~flag)
        found: list[tuple[int, int, int]] = []
        for i in left.tolist():
            may = right[marks[right] != marks[i]]
            shorter, longer = np.minimum(n[may], n[i]), np.maximum(n[may], n[i])
            may = may[shorter * 100 >= longer * similar]
            agree = (signs[may] == signs[i]).sum(axis=1)
            order = np.argsort(-agree, kind="stable")[: int((agree >= least).sum())]
            own, taken = np.sort(values[ends[i] : ends[i + 1]]), {}
            for j, c in zip(may[order].tolist(), agree[order].tolist()):
                if taken.get(marks[j], 0) < 2:
                    other = values[ends[j] : ends[j + 1]]
                    at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    common = int((own[at] == other).sum())
                    if common * 100 >= (int(n[i]) + int(n[j]) - common) * similar:
                        taken[marks[j]] = taken.get(marks[j], 0) + 1
                        found.append((min(ids[i], ids[j]), max(ids[i], ids[j]), c))
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "agree": pa.array(c, pa.int32())})

    ship(named.sparkSession)
    return both.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long, agree int").distinct()


class Sets:
    """Whole shingle sets of classes, made again from one document of each."""

    def __init__(self, df: DataFrame, named: DataFrame, key: str, text: str, k: int):
        self.df, self.named, self.key, self.text, self.k = df, named, key, text, k

    def of(self, wanted: DataFrame) -> DataFrame:
        """_class, shingles; a filter of fixed size keeps most other texts out of the shuffle."""
        first = self.named.join(wanted, "_class", "left_semi").select("_class", "_first._id", "_first._hash")
        first = materialize(first, "wanted")
        k = self.k

        def work(batches):
            for batch in batches:
                sets = [s.view(np.int64) for s in shingle_sets(batch.column(1).to_pylist(), k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["_class", "shingles"]
                )

        text = F.col(f"`{self.text}`").cast("string")
        docs = self.df.select(F.col(f"`{self.key}`").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
        docs = docs.filter(KeyFilter(first, ["_id", "_hash"]).may_hold())
        # Repeated rows give their set more than once.
        chosen = docs.join(first, same_document(docs, first)).select("_class", "_text")
        return arrow_map(chosen, work, "_class long, shingles array<long>").dropDuplicates(["_class"])

    def links(self, pairs: DataFrame, similar: int) -> DataFrame:
        """a, b: the labels of the pairs that are similar enough, in whole numbers."""
        ends = pairs.select(F.col("a").alias("_class")).union(pairs.select("b")).distinct()
        sets = materialize(self.of(ends), "sets")
        left, right = (sets.select(F.col("_class").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
        both = pairs.select("a", "b", "of_a", "of_b").join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("_a", "_b")).cast("long")
        union = F.size("_a") + F.size("_b") - common
        found = both.filter(common * 100 >= union * similar)
        return found.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()


def _linked(candidates: DataFrame, labels: DataFrame, sets: Sets, similar: int, few: int = 0) -> tuple[DataFrame, int]:
    """Labels of the classes after verification of all candidates that matter, and `few`.

    A candidate inside a component adds nothing. So each class first verifies
    the candidate it agrees with most; only pairs whose components still differ
    are verified in later rounds. As soon as no more than `few` are left, the
    pairs that the first round verified, or after PICKY_ROUNDS, a round takes all.
    Links join the components found so far, so what was joined is not joined again.
    """
    left, turn = candidates, 0
    while True:
        left = materialize(_across(left, labels), "candidates")
        count = left.count()
        if not count:
            return labels, few
        last = turn >= PICKY_ROUNDS or count <= few
        pick = left
        if not last:
            best = F.max(F.struct("agree", "a", "of_a", "of_b")).alias("_best")
            pick = materialize(left.groupBy("b").agg(best).select("_best.*", "b"), "picked")
            few = few or pick.count()
            left = left.join(pick, ["a", "b"], "left_anti")
        links = materialize(sets.links(pick, similar), "links")
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = stars(known.union(links)).toDF("node", "component")
        if last:
            return labels, few
        turn += 1


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """a, b, agree, of_a, of_b: the pairs whose ends have different labels, and these.

    A class without a label is its own.
    """
    left, right = (labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in "ab")
    both = pairs.select("a", "b", "agree").join(left, "a", "left").join(right, "b", "left")
    both = both.select("a", "b", "agree", F.coalesce("_a", "a").alias("of_a"), F.coalesce("_b", "b").alias("of_b"))
    return both.filter(F.col("of_a") != F.col("of_b"))


def minhash_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = WORDS,
    similar: int = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: key, n_shingles, component_id, kept.

    Words are runs other than ASCII white space, A-Z lower-cased; a set holds a
    text's distinct k-word shingles (as 64-bit hashes), or its whole sequence
    when it has fewer words. Documents link when 100 times the size of the
    intersection is at least `similar` times that of the union; every link is
    confirmed on the whole sets. Minima find a pair at that similarity but for
    a chance of (1 - similarity**rows)**bands, and more similar ones still more
    surely. component_id is the smallest key reachable by links; a null key
    counts as smallest. `kept` says that a row has the key of its component, so
    rows repeated under that key are all kept. Null and empty texts have no set,
    link with nothing and are kept. Equal texts are one class, compared once.
    Other columns are ignored; an empty table gives no rows.
    """
    profile = profiles(df, key, text, k, bands, rows)
    named = classes(profile)
    members = buckets(named)
    least = least_agreement(similar, bands * rows)
    sets = Sets(df, named, key, text, k)
    labels = df.sparkSession.createDataFrame([], "node long, component long")
    labels, few = _linked(scored(first_pairs(members, similar), named, least), labels, sets, similar)
    more = materialize(block_pairs(members, named, labels, sets, similar, least), "block-pairs")
    labels, _ = _linked(more, labels, sets, similar, few)
    grouped = named.select("node", "_first", "_class").join(
        labels.select(F.col("node").alias("_class"), "component"), "_class", "left"
    )
    grouped = grouped.withColumn("_group", F.coalesce("component", "_class"))
    first = grouped.groupBy("_group").agg(F.min("_first").alias("_keep"))
    answer = materialize(grouped.join(first, "_group").select("node", "_keep"), "answer")
    own = F.struct("_id", "_hash")
    found = profile.select("_id", "_hash", "n_shingles", "node").join(answer, "node", "left")
    keep = F.coalesce("_keep", own)["_id"]
    return found.select(
        F.col("_id").alias(key), "n_shingles", keep.alias("component_id"), keep.eqNullSafe(F.col("_id")).alias("kept")
    )
