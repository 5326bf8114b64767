"""N-gram Jaccard join by prefix filters under several global token orders.

Documents with equal shingle sets form one class. Under any global order of the
shingles, two sets with a Jaccard similarity of at least t share one of the
first n - ceil(t n) + 1 shingles of each. Candidates share one under the first
order (rare ones first), lie within the length bounds, and share one under each
of the other orders; only these are verified on the whole sets.

Which documents are connected does not need every link of a large group of near
copies. In a bucket (the classes with one prefix shingle) of more than a few
members, pivots are compared with the others; members whose component is then
the same need no comparison of their own. All pairs of different components are
compared in the end, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import mix, shingle_sets
from tidemark.llm.common import arrow_map
from tidemark.llm.components import components
from tidemark.session import discard, materialize

# Contract of op10: three words, 90 of 100.
WORDS, SIMILAR = 3, 90
# Counters for the order by frequency, as a power of two, in blocks.
ORDER_BITS, BLOCK_BITS = 24, 14
# A task's counter stops here; the tasks' counts are added in 64 bits.
TASK_COUNT = 1 << 15
# Salts of the other orders.
ORDERS = (11, 13)
# Prefix tokens that two sets must share under each of the other orders.
SHARE = 8
# A counter that far above twice the mean belongs to a token of many documents.
HOT = 1 << 14
# Buckets up to this size have their pairs compared at once.
SMALL = 4
# Bits of the filters that tell which documents a later step may leave alone.
FILTER_BITS = 24
# Pivots of a larger bucket, at first and in the rounds on what is still open.
FIRST_PIVOTS, PIVOTS = 2, 8
# Pairs of different components are compared at once when a bucket member has
# on average no more than this many of them.
PAIRS_PER_MEMBER = 64


def level(count):
    """A document frequency as one byte, eight steps to a doubling."""
    return np.minimum(np.round(np.log2(1.0 + count) * 8), 255).astype(np.uint8)


def shingle_levels(df: DataFrame, text: str, k: int, bits: int = ORDER_BITS) -> tuple[np.ndarray, int]:
    """Document frequencies of all shingles in 2**bits hashed counters, and their sum.

    Tasks count in 16 bits and send the blocks they touched, deflated: most
    counters of a block are zero or small. Blocks are added as they stream in
    and leave as levels of one byte, so what reaches the driver has a fixed
    size, whatever the corpus.
    """
    shift, width = np.uint64(64 - bits), min(BLOCK_BITS, bits)

    def count(batches):
        totals = np.zeros(1 << bits, dtype=np.uint16)
        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist(), k):
                np.add.at(totals, (s >> shift).astype(np.int64), np.uint16(1))
            # A batch of documents cannot count past what 16 bits hold above this.
            np.minimum(totals, TASK_COUNT, out=totals)
        blocks = totals.reshape(-1, 1 << width)
        used = np.flatnonzero(blocks.any(axis=1))
        if len(used):
            raw = [zlib.compress(blocks[i].tobytes(), 1) for i in used]
            columns = [pa.array(used, pa.int32()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "counts"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(raw), dtype=np.uint16)
                if block not in totals:
                    totals[block] = np.zeros(1 << width, dtype=np.int64)
                totals[block] += counts
        if totals:
            columns = [
                pa.array(list(totals), pa.int32()),
                pa.array([level(t).tobytes() for t in totals.values()], pa.binary()),
                pa.array([int(t.sum()) for t in totals.values()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "levels", "n"])

    parts = arrow_map(df.select(F.col(text).cast("string")), count, "block int, counts binary")
    summed = arrow_map(parts.repartition("block"), add, "block int, levels binary, n long")
    out, n = np.zeros((1 << (bits - width), 1 << width), dtype=np.uint8), 0
    for row in summed.collect():
        out[row["block"]] = np.frombuffer(row["levels"], dtype=np.uint8)
        n += row["n"]
    return out.reshape(-1), n


def prefix_length(n: int, similar: int, share: int = 1) -> int:
    """Tokens of which two similar sets share at least `share` under any order."""
    return min(n, n - (similar * n + 99) // 100 + share)


def prefixes(
    df: DataFrame, key: str, text: str, k: int, similar: int, bits: int = ORDER_BITS
) -> DataFrame:
    """Per row: _id, _hash (of the text), n_shingles, node (class of its set), prefixes.

    `rare` and `hot` are the prefix under the order by frequency, apart by
    whether many documents have the token. `order0`, ... are the prefixes under
    the random orders, cut to 32 bits, which can only add candidates.
    """
    levels, total = shingle_levels(df, text, k, bits)
    many = int(level(2 * (total >> bits) + HOT))
    shared = df.sparkSession.sparkContext.broadcast(levels)
    shift = np.uint64(64 - bits)
    kind = df.schema[key].dataType.simpleString()

    def work(batches):
        order = shared.value
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names[2:]}
            for s in shingle_sets(batch.column(2).to_pylist(), k):
                n = len(s)
                out["n_shingles"].append(n)
                if not n:
                    out["node"].append(None)
                    for name in names[4:]:
                        out[name].append([])
                    continue
                out["node"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                # The level in the upper byte, ties by a hash.
                rank = order[(s >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)
                rank |= mix(s, 7) >> np.uint64(8)
                # Stable over ascending hashes: a total order, the same everywhere.
                first = np.argsort(rank, kind="stable")[: prefix_length(n, similar)]
                hot = rank[first] >> np.uint64(56) >= many
                out["rare"].append(s[first[~hot]].view(np.int64))
                out["hot"].append(s[first[hot]].view(np.int64))
                length = prefix_length(n, similar, SHARE)
                for name, salt in zip(orders, ORDERS):
                    least = np.partition(mix(s, salt), length - 1)[:length]
                    out[name].append(least.astype(np.uint32).view(np.int32))
            columns = [pa.array(out[name], types[name]) for name in names[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    orders = [f"order{i}" for i in range(len(ORDERS))]
    names = ["_id", "_hash", "n_shingles", "node", "rare", "hot", *orders]
    types = {"n_shingles": pa.int64(), "node": pa.binary(), "rare": pa.list_(pa.int64()), "hot": pa.list_(pa.int64())}
    types |= {name: pa.list_(pa.int32()) for name in orders}
    fixed = "n_shingles bigint, node binary, rare array<bigint>, hot array<bigint>"
    schema = f"_id {kind}, _hash bigint, {fixed}" + "".join(f", {name} array<int>" for name in orders)
    body = F.col(text).cast("string")
    found = arrow_map(df.select(F.col(key), F.xxhash64(body), body), work, schema)
    return materialize(found.withColumn("_row", F.monotonically_increasing_id()), "prefixes")


def postings(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of all buckets, by row, and those of large ones, by class.

    Most prefix tokens are unique. One shuffle by token, with a row number in
    place of the document, counts them and drops those; the tokens of many
    documents keep out of it, since they are shared anyway. `pos` is the place
    of the token in the member's prefix.
    """
    sets = profiles.filter("n_shingles > 0").withColumnRenamed("n_shingles", "n")
    posts = sets.select("_row", "n", F.posexplode("rare").alias("pos", "token"))
    size = F.count(F.lit(1)).over(Window.partitionBy("token"))
    live = materialize(posts.withColumn("_size", size).filter("_size > 1"), "live")
    many = live.filter(F.col("_size") > SMALL).join(sets.select("_row", "node"), "_row")
    hot = sets.select("node", "n", F.size("rare").alias("_at"), F.posexplode("hot").alias("pos", "token"))
    member = ["token", "node", "n", "pos"]
    many = many.select(member).union(hot.withColumn("pos", F.expr("_at + pos")).select(member)).distinct()
    many = materialize(many, "members")
    sizes = many.groupBy("token").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    buckets = materialize(many.join(sizes, "token"), "buckets")
    discard(many)
    return live, buckets


def bucket_pairs(live: DataFrame, profiles: DataFrame, similar: int) -> DataFrame:
    """Pairs of classes that share a small bucket and may be similar.

    At most SMALL rows meet in a bucket, whose pairs are made in one row.
    """
    member = F.struct("_row", "n", "pos")
    few = live.filter(F.col("_size") <= SMALL)
    rows = few.groupBy("token").agg(F.sort_array(F.collect_list(member)).alias("_all"))
    pairs = F.flatten(
        F.transform(
            "_all",
            lambda x, i: F.transform(
                F.filter(
                    F.slice("_all", i + 2, SMALL),
                    lambda y: _may_link(x["n"], x["pos"], y["n"], y["pos"], similar),
                ),
                lambda y: F.struct(x["_row"].alias("x"), y["_row"].alias("y")),
            ),
        )
    )
    pairs = rows.select(F.explode(pairs).alias("p")).select("p.x", "p.y").distinct()
    nodes = profiles.filter("n_shingles > 0").select("_row", "node")
    left, right = (nodes.withColumnsRenamed({"_row": r, "node": f"_{r}"}) for r in ("x", "y"))
    both = pairs.join(left, "x").join(right, "y").filter(F.col("_x") != F.col("_y"))
    return both.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))


def _may_link(n: Column, pos: Column, m: Column, other: Column, similar: int) -> Column:
    """Length and position bounds of two sets of n and m shingles in a bucket.

    The similarity asks for `least` common shingles. If the bucket's token is
    the first that both have, neither has a common one before it. Every pair
    meets in the bucket of its first common token, so a pair that fails here
    in a later bucket is not lost.
    """
    least = F.floor((similar * (n + m) + 99 + similar) / F.lit(100 + similar))
    return (n - pos >= least) & (m - other >= least)


def _pairs(left: DataFrame, right: DataFrame, similar: int) -> DataFrame:
    """Pairs of one bucket that have different labels and may link, a < b."""
    a, b = left.alias("a"), right.alias("b")
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.label") != F.col("b.label"))
    on &= _may_link(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), similar)
    if left is right:
        on &= F.col("a.node") < F.col("b.node")
    ends = F.col("a.node"), F.col("b.node")
    return a.join(b, on).select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))


def _star_pairs(members: DataFrame, similar: int, turn: int, pivots: int) -> DataFrame:
    """Each bucket's pivots, about `pivots` others each turn, with members of other labels.

    One pivot is the member with the fewest tokens before the bucket's, the one
    most likely to be what the others are copies of. Whether another class is a
    pivot follows from its hash and the size of the bucket, so the buckets of
    one group of near copies mostly have the same ones and give the same pairs.
    """
    chance = F.greatest(F.expr(f"_size div {pivots}"), F.lit(1))
    chosen = members.filter(F.pmod(F.xxhash64("node", F.lit(turn)), chance) == 0)
    rest = [F.col(c) for c in members.columns if c not in ("token", "pos")]
    first = F.min(F.struct("pos", F.xxhash64("node", F.lit(turn)).alias("_rank"), *rest)).alias("_first")
    central = members.groupBy("token").agg(first).select("token", "_first.*").select(members.columns)
    return _pairs(chosen.union(central), members, similar)


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"])


class KeyFilter:
    """A bitmap of fixed size that holds all keys of a table, and some others."""

    def __init__(self, keys: DataFrame, columns: list[str], bits: int = FILTER_BITS):
        self.columns, self.bits = columns, bits
        width = min(BLOCK_BITS, bits - 3)
        shift = np.uint64(64 - bits)

        def mark(batches):
            held = np.zeros(1 << (bits - 3), dtype=np.uint8)
            for batch in batches:
                at = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), 3) >> shift
                np.bitwise_or.at(held, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            blocks = held.reshape(-1, 1 << width)
            yield from sent({i: blocks[i] for i in np.flatnonzero(blocks.any(axis=1)).tolist()})

        def join(batches):
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    part = np.frombuffer(raw, dtype=np.uint8)
                    held[block] = held[block] | part if block in held else part
            yield from sent(held)

        def sent(blocks):
            if blocks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(blocks), pa.int32()), pa.array([b.tobytes() for b in blocks.values()], pa.binary())],
                    names=["block", "held"],
                )

        parts = arrow_map(keys.select(F.xxhash64(*columns)), mark, "block int, held binary")
        held = np.zeros((1 << (bits - 3 - width), 1 << width), dtype=np.uint8)
        for row in arrow_map(parts.repartition("block"), join, "block int, held binary").collect():
            held[row["block"]] |= np.frombuffer(row["held"], dtype=np.uint8)
        self.held = keys.sparkSession.sparkContext.broadcast(held.reshape(-1))

    def may_hold(self) -> Column:
        """False for rows whose key is surely not in the table."""
        held, shift = self.held, np.uint64(64 - self.bits)

        @F.arrow_udf("boolean")
        def test(hashes: pa.Array) -> pa.Array:
            at = mix(hashes.to_numpy(zero_copy_only=False).view(np.uint64), 3) >> shift
            bits = held.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
            return pa.array((bits & 1).astype(bool))

        return test(F.xxhash64(*self.columns))


class _Verifier:
    """Candidate pairs to links, on the other orders' prefixes and whole sets."""

    def __init__(self, df, profiles, key, text, k, similar):
        self.df, self.key, self.text, self.k, self.similar = df, key, text, k, similar
        self.profiles = profiles.filter("n_shingles > 0")

    def filtered(self, pairs: DataFrame) -> DataFrame:
        """Pairs that share enough prefix tokens under every other order."""
        pairs = materialize(pairs.distinct(), "pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        names = [f"order{i}" for i in range(len(ORDERS))]
        # Most classes are in no pair; a filter keeps their prefixes out of the shuffle.
        orders = self.profiles.select("node", "n_shingles", *names)
        orders = orders.filter(KeyFilter(nodes, ["node"]).may_hold()).join(nodes, "node", "left_semi")
        orders = orders.groupBy("node").agg(
            F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in names]
        )
        orders = materialize(orders, "orders")
        left, right = (orders.withColumnsRenamed({c: f"{s}_{c}" for c in orders.columns}) for s in "ab")
        both = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
        # Sets smaller than SHARE share at least what the similarity asks of the larger.
        least = F.expr(f"least({SHARE}, ({self.similar} * greatest(a_n, b_n) + 99) div 100)")
        for c in names:
            a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
            # Tokens that are alike in 32 bits count once; what that hides is added.
            hidden = F.size(a) - F.size(F.array_distinct(a))
            both = both.filter(F.size(F.array_intersect(a, b)) + hidden >= least)
        candidates = materialize(both.select("a", "b"), "candidates")
        discard(pairs, orders)
        return candidates

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """Whole sets of one document for each of the classes.

        A filter of fixed size keeps most other documents out of the shuffle of
        texts; where it fills up, it lets more through.
        """
        first = (
            self.profiles.join(nodes, "node", "left_semi")
            .groupBy("node")
            .agg(F.min(F.struct("_id", "_hash")).alias("_first"))
            .select("_first._id", "_first._hash")
        )
        first = materialize(first.distinct(), "wanted")
        k = self.k

        def work(batches):
            for batch in batches:
                sets = [s for s in shingle_sets(batch.column(0).to_pylist(), k) if len(s)]
                names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["node", "shingles"],
                )

        text = F.col(self.text).cast("string")
        docs = self.df.select(
            F.col(self.key).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")
        )
        docs = docs.filter(KeyFilter(first, ["_id", "_hash"]).may_hold())
        # Sorted on both sides, so that the filter and the sets are in different
        # tasks: one with both would hold two Python workers.
        chosen = docs.join(first.hint("merge"), same_document(docs, first), "left_semi")
        sets = arrow_map(chosen.select("_text"), work, "node binary, shingles array<bigint>")
        return materialize(sets, "sets")

    def links(self, candidates: DataFrame) -> DataFrame:
        """Candidates whose similarity holds, in whole numbers; the candidates are used up."""
        nodes = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
        sets = self._sets(nodes)
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
        both = candidates.join(left, "a").join(right, "b")
        both = both.withColumn("_in", F.size(F.array_intersect("_a", "_b")).cast("long"))
        union = F.size("_a") + F.size("_b") - F.col("_in")
        links = both.filter(F.col("_in") * 100 >= union * self.similar).select("a", "b").distinct()
        links = materialize(links, "links")
        discard(sets, candidates)
        return links


def linked_classes(
    df: DataFrame, profiles: DataFrame, key: str, text: str, k: int, similar: int
) -> DataFrame:
    """(node, component) of all classes that are linked with another one."""
    live, many = postings(profiles)
    pairs = bucket_pairs(live, profiles, similar)
    first = many.withColumn("label", F.col("node"))
    pairs = pairs.union(_star_pairs(first, similar, 0, FIRST_PIVOTS))

    check = _Verifier(df, profiles, key, text, k, similar)
    candidates = check.filtered(pairs)
    discard(live)
    links = check.links(candidates)
    groups = materialize(components(links), "components")
    turn, before = 1, None
    while True:
        label = F.coalesce("component", "node").alias("label")
        members = many.join(groups, "node", "left").select("token", "node", "n", "pos", label)
        # A pair needs its smaller set to be near enough to the front of its prefix.
        active = _may_link(F.col("n"), F.col("pos"), F.col("n"), F.col("pos"), similar)
        each = members.groupBy("token", "label").agg(
            F.count(F.lit(1)).alias("c"), F.count(F.when(active, 1)).alias("a")
        )
        open_buckets = (
            each.groupBy("token")
            .agg(F.sum("c").alias("n"), (F.sum("a") * F.sum("c") - F.sum(F.expr("a * c"))).alias("pairs"))
            .filter("pairs > 0")
        )
        open_buckets = materialize(open_buckets, "open")
        n, cross = open_buckets.agg(F.sum("n"), F.sum("pairs")).first()
        if not n:
            return groups
        sizes = open_buckets.select("token", F.col("n").alias("_size"))
        members = materialize(members.join(sizes, "token"), "members")
        last = cross <= PAIRS_PER_MEMBER * n or (before is not None and cross > 0.9 * before)
        if last:
            pairs = _pairs(members, members, similar)
        else:
            pairs = _star_pairs(members, similar, turn, PIVOTS)
        more = check.links(check.filtered(pairs))
        known, found = links, groups
        links = materialize(known.union(more).distinct(), "links")
        groups = materialize(components(links), "components")
        discard(known, more, found, members, open_buckets)
        if last:
            return groups
        turn, before = turn + 1, cross


def _answered(
    df: DataFrame, key: str, text: str, k: int, similar: int, bits: int
) -> DataFrame:
    """Per row: _id, _hash, n_shingles and _keep, the first (_id, _hash) of its component."""
    profiles = prefixes(df, key, text, k, similar, bits)
    groups = linked_classes(df, profiles, key, text, k, similar)
    own = F.struct("_id", "_hash")
    # The prefixes are not needed any more.
    whole, profiles = profiles, materialize(profiles.select("_id", "_hash", "n_shingles", "node"), "sets-of-rows")
    discard(whole)
    classes = profiles.filter("n_shingles > 0").groupBy("node").agg(F.min(own).alias("_first"))
    named = classes.join(groups, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    least = named.groupBy("_group").agg(F.min("_first").alias("_keep"))
    answer = materialize(named.join(least, "_group").select("node", "_keep"), "answer")
    return (
        profiles.select("_id", "_hash", "n_shingles", "node")
        .join(answer, "node", "left")
        .select("_id", "_hash", "n_shingles", F.coalesce("_keep", own).alias("_keep"))
    )


def jaccard_components(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = WORDS,
    similar: int = SIMILAR,
    bits: int = ORDER_BITS,
) -> DataFrame:
    """One row per input row: key, n_shingles, component_id.

    Words are runs other than ASCII white space, A-Z lower-cased; a set holds a
    text's distinct k-word shingles (as 64-bit hashes), or its whole sequence
    when it has fewer words. Two documents link when 100 times the size of the
    intersection is at least `similar` times that of the union. component_id is
    the smallest key reachable by links; a null key counts as smallest. Null
    and empty texts have no set and link with nothing: each is its own
    component. Equal texts and repeated rows are one class, compared once.
    Other columns are ignored; an empty table gives no rows.
    """
    found = _answered(df, key, text, k, similar, bits)
    return found.select(
        F.col("_id").alias(key), "n_shingles", F.col("_keep._id").alias("component_id")
    )


def without_near_copies(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    k: int = 5,
    similar: int = 80,
    bits: int = ORDER_BITS,
) -> DataFrame:
    """One document of each component, with the columns of the input.

    The one with the smallest key stays, of rows with equal keys the one with
    the smallest text hash, of rows repeated in full one. Texts without words
    are components of their own, so all of them stay but for repeated rows.
    """
    answered = _answered(df, key, text, k, similar, bits)
    own = ["_id", "_hash"]
    each = answered.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.first("_keep").alias("_keep"))
    # Rows that go, and rows of which one stays; all others are left alone.
    leaves = ~(F.col("_keep._id").eqNullSafe(F.col("_id")) & (F.col("_keep._hash") == F.col("_hash")))
    asked = each.withColumn("_leaves", leaves).filter(F.col("_leaves") | (F.col("_n") > 1))
    asked = materialize(asked.select(*own, "_leaves"), "asked")
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc"),
        F.col(key).alias("_id"),
        F.xxhash64(F.col(text).cast("string")).alias("_hash"),
    )
    may = KeyFilter(asked, own).may_hold()
    docs = docs.withColumn("_may", may)
    clear = docs.filter(~F.col("_may")).select("_doc.*")
    docs = docs.filter("_may")
    named = asked.withColumnsRenamed({"_id": "_a_id", "_hash": "_a_hash"})
    same = docs["_id"].eqNullSafe(named["_a_id"]) & (docs["_hash"] == named["_a_hash"])
    rest = docs.join(named, same, "left").filter("coalesce(not _leaves, true)")
    nth = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    return clear.union(rest.withColumn("_nth", nth).filter("_nth = 1").select("_doc.*"))
