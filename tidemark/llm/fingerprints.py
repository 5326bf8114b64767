"""Order MinHash fingerprints (native).

A text becomes the sequence of its pieces (words, long words cut), and this the
sequence of its k-mers, each numbered by its occurrence. Each of `sketches` hash
functions selects the minimal k-mer of either half of the hash space; the pair
keeps its order in the text and is hashed. Two texts share a sketch when they
share the minimal k-mers and these stand in the same order, so the share of
equal sketches falls with edit distance, reordering included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, whole_text
from tidemark.operators.scans import commit_position
from tidemark.session import materialize

SKETCHES = 16
KMER = 3
PIECE = 8
# Low bits of a packed minimum hold the position, the others the hash.
POSITION_BITS = 24
POSITION = (1 << POSITION_BITS) - 1


def pieces(text: Column, length: int = PIECE) -> Column:
    """Words, those of more than `length` code points cut from their start."""
    return F.regexp_extract_all(text, F.lit(f"([^{SPACES}]{{1,{length}}})"), F.lit(1))


def kmers(parts: Column, k: int = KMER) -> Column:
    """Hashes of all runs of k pieces; of the whole when there are fewer."""
    n = F.size(parts)
    runs = F.transform(
        F.sequence(F.lit(1), n - k + 1),
        lambda i: F.xxhash64(*[F.element_at(parts, i + j) for j in range(k)]),
    )
    return (
        F.when(n >= k, runs)
        .when(n > 0, F.array(F.xxhash64(parts)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def numbered(hashes: Column) -> Column:
    """(value, place) of every k-mer; the value also holds its occurrence number.

    Where all are distinct nothing is to be numbered. Else they are sorted by
    hash and place: equal ones stand together, and their number is the distance
    from the start of their run.
    """
    plain = F.transform(
        hashes, lambda h, i: F.struct(h.alias("value"), i.cast("long").alias("place"))
    )

    def by_run(s: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i)["value"] != F.get(s, i - 1)["value"]),
        )
        ends = F.concat(F.slice(heads, 2, F.greatest(F.size(heads) - 1, F.lit(0))), F.array(F.size(s)))
        return F.flatten(
            F.zip_with(
                heads,
                ends,
                lambda a, b: F.transform(
                    F.slice(s, a + 1, b - a),
                    lambda x, i: F.struct(
                        F.when(i == 0, x["value"]).otherwise(F.xxhash64(x["value"], i)).alias("value"),
                        x["place"].alias("place"),
                    ),
                ),
            )
        )

    # One-element arrays bind the sorted array to a name.
    sorted_runs = F.element_at(F.transform(F.array(F.sort_array(plain)), by_run), 1)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), sorted_runs).otherwise(plain)


def _packed(seed: int) -> Column:
    """Hash of the value under one function, in the upper bits, then the place."""
    place = F.least(F.col("_place"), F.lit(POSITION).cast("long"))
    return F.xxhash64("_value", F.lit(seed)).bitwiseAND(F.lit(~POSITION)).bitwiseOR(place)


def _tuple_hash(even: Column, odd: Column) -> Column:
    """The selected k-mers hashed in text order; null for none."""
    first = even.bitwiseAND(F.lit(POSITION)) <= odd.bitwiseAND(F.lit(POSITION))
    a, b = F.shiftright(even, POSITION_BITS), F.shiftright(odd, POSITION_BITS)
    return (
        F.when(even.isNull() & odd.isNull(), F.lit(None).cast("long"))
        .when(odd.isNull() | (even.isNotNull() & first), F.xxhash64(a, b))
        .otherwise(F.xxhash64(b, a))
    )


def fingerprints(
    df: DataFrame,
    ids: list[str],
    text: str,
    sketches: int = SKETCHES,
    k: int = KMER,
) -> DataFrame:
    """Per row of `ids` (which must be unique): `sketch`, an array of longs.

    Only the minima of a document are aggregated, and these are combined before
    the shuffle: one row per document and input partition crosses it. Texts
    without pieces have an array of nulls.
    """
    parts = df.select(*ids, pieces(F.col(text)).alias("_parts"))
    hashes = parts.select(*ids, kmers(F.col("_parts"), k).alias("_hashes"))
    rows = hashes.select(*ids, F.explode_outer(numbered(F.col("_hashes"))).alias("_k")).select(
        *ids, F.col("_k.value").alias("_value"), F.col("_k.place").alias("_place")
    )
    odd = F.col("_value").bitwiseAND(F.lit(1)) == 1
    minima = rows.select(
        *ids, odd.alias("_odd"), *[_packed(s).alias(f"_h{s}") for s in range(sketches)]
    )
    per = minima.groupBy(*ids).agg(
        *[F.min(F.when(~F.col("_odd"), F.col(f"_h{s}"))).alias(f"_e{s}") for s in range(sketches)],
        *[F.min(F.when(F.col("_odd"), F.col(f"_h{s}"))).alias(f"_o{s}") for s in range(sketches)],
    )
    sketch = F.array(*[_tuple_hash(F.col(f"_e{s}"), F.col(f"_o{s}")) for s in range(sketches)])
    return per.select(*ids, sketch.alias("sketch"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches; texts without any are alike only among themselves."""
    same = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"].eqNullSafe(p["b"]))
    return (F.size(same) / F.size(a)).cast("double")


def as_text(sketch: Column) -> Column:
    """Fixed-width hexadecimal digits of all sketches."""
    digits = F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(F.coalesce(h, F.lit(0))), 16, "0")))
    return F.array_join(digits, "")


# Rows made at once from one that stands for many.
STEP = 4096
# A document's identity without nulls, so that one shuffle serves all steps.
IDENTITY = ["_null", "_id", "_hash"]


def neighbours(docs: DataFrame) -> DataFrame:
    """Each distinct document's identity with that of the one it lends to, the number
    of code points it lends, and its rows: `_for_null`, `_for_id`, `_for_hash`, `_take`, `_rows`."""
    ids = docs.groupBy(*IDENTITY).agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    turned = ids.withColumns({"_down": -F.col("_id"), "_turn": F.bitwise_not(F.col("_hash"))})
    placed = commit_position(turned, ["_null", "_down", "_turn"], "_place").drop("_down", "_turn")
    placed = materialize(placed, "places")
    last = placed.agg(F.max("_place")).first()[0] or 0
    following = F.when(F.col("_place") == last, F.lit(1).cast("long")).otherwise(F.col("_place") + 1)
    wanted = placed.select(
        following.alias("_place"), *[F.col(c).alias(f"_for{c}") for c in IDENTITY], F.expr("_n div 3").alias("_take")
    )
    return placed.join(wanted, "_place").select(*IDENTITY, *[f"_for{c}" for c in IDENTITY], "_take", "_rows")


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as `times` says, in steps, so that no array grows with it."""
    steps = df.withColumn("_step", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {STEP})")))
    inside = F.expr(f"sequence(1L, least({times} - _step * {STEP}, {STEP}))")
    return steps.withColumn("_nth", F.explode(inside)).drop("_step", "_nth", times)


def edited(docs: DataFrame, links: DataFrame) -> DataFrame:
    """Documents with `_edited`: the last third replaced by the start of the next.

    Both joins read the texts from one shuffle on their identity; what a text
    lends is shuffled once more. The result stays partitioned by identity.
    """
    # The same columns as below, so that Spark reuses the shuffle of the texts.
    lent = (
        docs.join(links, IDENTITY)
        .select(
            *[F.col(f"_for{c}").alias(c) for c in IDENTITY],
            F.expr("substr(_text, 1, least(_take, _n))").alias("_lent"),
        )
        .dropDuplicates(IDENTITY)
    )
    changed = F.concat(F.expr("substr(_text, 1, _n - _n div 3)"), F.col("_lent"))
    return docs.join(lent, IDENTITY).select(*IDENTITY, "_n", "_text", changed.alias("_edited"))


def order_fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", sketches: int = SKETCHES, k: int = KMER
) -> DataFrame:
    """One row per input row: both fingerprints and their likenesses.

    Documents stand in descending order of their integer key, null last, equal
    keys by a hash of their text; the last is followed by the first. In the
    edited text the last n_chars div 3 code points give way to as many of the
    next document, or to all it has. Null is the empty text. Rows repeated in
    full are one document, which each of them gets the results of. Texts without words have the fingerprint of zeros and are
    alike. Other columns are ignored; an empty table gives no rows.
    """
    body = whole_text(text)
    docs = df.select(
        F.col(key).isNull().alias("_null"),
        F.coalesce(F.col(key), F.lit(0)).cast("long").alias("_id"),
        F.xxhash64(body).alias("_hash"),
        F.char_length(body).cast("long").alias("_n"),
        body.alias("_text"),
    )
    links = materialize(neighbours(docs), "neighbours")
    forms = edited(docs, links).select(
        *IDENTITY,
        "_n",
        F.unhex(F.sha2("_edited", 256)).alias("_sha"),
        F.explode(
            F.array(
                F.struct(F.lit(False).alias("new"), F.col("_text").alias("text")),
                F.struct(F.lit(True).alias("new"), F.col("_edited").alias("text")),
            )
        ).alias("_form"),
    )
    forms = forms.select(
        *IDENTITY, "_n", "_sha", F.col("_form.new").alias("_new"), F.col("_form.text").alias("_body")
    )
    sketched = fingerprints(forms, [*IDENTITY, "_n", "_sha", "_new"], "_body", sketches, k)
    pairs = sketched.groupBy(*IDENTITY, "_n", "_sha").agg(
        F.max(F.when(~F.col("_new"), F.col("sketch"))).alias("_own"),
        F.max(F.when(F.col("_new"), F.col("sketch"))).alias("_edit"),
    )
    pairs = materialize(pairs, "fingerprints")
    own = pairs.select(*IDENTITY, F.col("_own").alias("_next"))
    next_own = (
        links.select(*IDENTITY, *[f"_for{c}" for c in IDENTITY])
        .join(own, IDENTITY)
        .select(*[F.col(f"_for{c}").alias(c) for c in IDENTITY], "_next")
    )
    found = pairs.join(next_own, IDENTITY).join(links.select(*IDENTITY, "_rows"), IDENTITY)
    return repeated(found, "_rows").select(
        F.when(~F.col("_null"), F.col("_id")).cast(df.schema[key].dataType).alias(key),
        F.col("_n").alias("n_chars"),
        F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edit")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edit")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
