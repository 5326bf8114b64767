"""Spelling variants: words one edit apart, by a variable-length gram index.

Words are padded and cut into grams of two to four code points. A gram grows
while the shorter one is frequent: the dictionary holds the frequent grams and
is pruned of all others, so the lists of the index stay short. At each place the
longest gram of the dictionary is taken, and one contained in an earlier gram is
skipped. For every word the largest number of its grams that one edit can change
is found, place by place, from the dictionary; two words one edit apart share
all but that many grams of either word, each at the same distance from the start
or from the end. So the longest lists of a word can be skipped, one fewer than
the grams that stay; the others are merged, and what meets there is verified.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, whole_text
from tidemark.session import materialize

# Contract of op12: letters of a run, how many runs are changed, and what counts as a word.
RUN = r"[A-Za-zÀ-ÿ]+"
MODULUS, LEAST_LENGTH, LEAST_COUNT, RATIO = 97, 5, 3, 2
SHORTEST, LONGEST = 2, 4
# Stands before and after a word; no letter of a run.
PAD = "\u0001" * 2
# A gram of at least so many words is extended, of more where a share of 2**-16 is more.
FREQUENT, SHARE_BITS = 64, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def changed_run(key: Column, run: Column) -> Column:
    """The run in lower case (A-Z only); where 97 divides the checksum, one code point short."""
    low = F.translate(run, UPPER, LOWER)
    mark = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), low))
    at = F.pmod(mark, F.char_length(low).cast("long")).cast("int")
    cut = F.concat(F.substring(low, F.lit(1), at), F.substring(low, at + 2, F.char_length(low)))
    return F.when(F.pmod(mark, F.lit(MODULUS)) == 0, cut).otherwise(low)


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of the corpus and how often they occur; counted before the shuffle."""
    runs = df.select(
        F.col(f"`{key}`").alias("_key"),
        F.explode(F.regexp_extract_all(whole_text(f"`{text}`"), F.lit(RUN), F.lit(0))).alias("_run"),
    )
    words = runs.select(changed_run(F.col("_key"), F.col("_run")).alias("word"))
    counted = words.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def frequent_grams(words: DataFrame, least: int = FREQUENT, share_bits: int = SHARE_BITS) -> frozenset[str]:
    """The grams shorter than LONGEST that many words hold, which are extended.

    A share of all grams bounds their number, whatever the vocabulary: at most
    2**share_bits of each length reach the driver.
    """
    def cut(batches):
        for batch in batches:
            counts: Counter[str] = Counter()
            for word in batch.column(0).to_pylist():
                padded = PAD + word + PAD
                for size in range(SHORTEST, LONGEST):
                    counts.update(padded[i : i + size] for i in range(len(padded) - size + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["gram", "c"]
            )

    parts = arrow_map(words.select("word"), cut, "gram string, c long")
    counts = materialize(parts.groupBy("gram").agg(F.sum("c").alias("c")), "gram-counts")
    found: set[str] = set()
    for size in range(SHORTEST, LONGEST):
        grams = counts.filter(F.char_length("gram") == size)
        total = grams.agg(F.sum("c")).first()[0] or 0
        limit = max(least, (total >> share_bits) + 1)
        kept = {r["gram"] for r in grams.filter(F.col("c") >= limit).select("gram").collect()}
        # Kept closed under prefixes, as a trie is.
        found |= {g for g in kept if size == SHORTEST or g[:-1] in found}
    return frozenset(found)


def decompose(word: str, frequent: frozenset[str]) -> list[tuple[str, int]]:
    """The grams of a padded word with their places, none inside another."""
    out, last = [], 0
    for start in range(len(word) - SHORTEST + 1):
        end = start + SHORTEST
        while end - start < LONGEST and end < len(word) and word[start:end] in frequent:
            end += 1
        if end > last:
            out.append((word[start:end], start))
            last = end
    return out


def affected(grams: list[tuple[str, int]], length: int, frequent: frozenset[str]) -> int:
    """The most grams of a padded word of `length` that one edit can change.

    Before the edited place a gram changes when it holds the place, or when it
    ends right there and could be extended. After it, one that a gram over the
    edited place might come to contain is skipped. So each gram changes for a
    run of places, and the most runs over one place are found by running sums.
    """
    pad = len(PAD)
    changed, inserted = [0] * (length + 2), [0] * (length + 2)
    for g, start in grams:
        end = start + len(g)
        upto = end + (len(g) < LONGEST and g in frequent)
        changed[max(end - LONGEST, 0)] += 1
        changed[upto] -= 1
        inserted[max(end - LONGEST + 1, 0)] += 1
        inserted[upto] -= 1
    # Code points of the word are replaced or deleted, others inserted before or after them.
    most = max(list(accumulate(changed))[pad : length - pad], default=0)
    return max(most, *list(accumulate(inserted))[pad : length - pad + 1])


def _profiles(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """_word (a number), word, n, len, bound (grams that one edit leaves) and grams with their places."""
    schema = "_word long, word string, n long, len int, bound int, grams array<struct<gram: string, at: int>>"
    gram = pa.list_(pa.struct([("gram", pa.string()), ("at", pa.int32())]))
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def work(batches):
        for batch in batches:
            known = shared.value
            lengths, bounds, grams = [], [], []
            for word in batch.column(1).to_pylist():
                padded = PAD + word + PAD
                cut = decompose(padded, known)
                lengths.append(len(padded))
                bounds.append(len(cut) - affected(cut, len(padded), known))
                grams.append([{"gram": g, "at": at} for g, at in cut])
            columns = [pa.array(lengths, pa.int32()), pa.array(bounds, pa.int32()), pa.array(grams, gram)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    names = ["_word", "word", "n", "len", "bound", "grams"]
    numbered = words.select(F.monotonically_increasing_id().alias("_word"), "word", "n")
    return arrow_map(numbered, work, schema)


def postings(profiles: DataFrame) -> DataFrame:
    """The index: of each word its rarest grams, as many as one edit can change and one more.

    Two words one edit apart share at least `bound` grams of either. Of a
    word's lists the `bound` - 1 longest are therefore skipped when lists are
    merged: the rarest gram that both share is among the others of either.
    Numbers stand for the words until their lists are chosen, since a word may
    be as long as a text.
    """
    grams = profiles.select("_word", "bound", F.explode("grams").alias("g")).select("_word", "bound", "g.*")
    sizes = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    rows = grams.join(sizes, "gram").groupBy("_word", "bound").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram", "at"))).alias("all")
    )
    kept = F.slice("all", F.lit(1), F.size("all") - F.col("bound") + 1)
    lists = rows.select("_word", F.explode(kept).alias("p")).select("_word", "p.gram", "p.at")
    return lists.join(profiles.select("_word", "word", "n", "len"), "_word").drop("_word")


def near_pairs(profiles: DataFrame) -> DataFrame:
    """a, b, na, nb: pairs of words one edit apart, each once, in one of its orders.

    A list of the index is a gram with its distance from the start, and one with
    that from the end; only words of the same or the next length meet in it, so
    a frequent gram is spread over its places and lengths.
    """
    index = materialize(postings(profiles), "grams")
    ends = index.withColumn("at", F.col("at") - F.col("len"))
    lists = index.select("*", F.lit(False).alias("end")).union(ends.select("*", F.lit(True).alias("end")))
    # A word meets its own length and the next one; lists from the end serve different lengths only.
    short = lists.withColumn("size", F.explode(F.array("len", F.col("len") + 1)))
    short = short.filter(~F.col("end") | (F.col("size") > F.col("len")))
    key = ["gram", "at", "end", "size"]
    a = short.select(*key, F.col("word").alias("a"), F.col("n").alias("na"), F.col("len").alias("la"))
    b = lists.withColumn("size", F.col("len")).select(*key, F.col("word").alias("b"), F.col("n").alias("nb"))
    met = a.join(b, key).filter((F.col("la") < F.col("size")) | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b", "na", "nb").distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """word, root: pointers doubled until every word points to the end of its chain.

    A form occurs at least twice as often as its word, so chains end, after no
    more steps than a count has bits.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = now.join(ahead, "root", "left")
        step = step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        step = materialize(step, "roots")
        now = step.select("word", "root")
        if not step.filter("_moved").limit(1).count():
            return now


def spelling_variants(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = FREQUENT,
    words: Callable[[DataFrame, str, str], DataFrame] = vocabulary,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of letters (A-Z, a-z and U+00C0 to U+00FF; only A-Z become
    lower case) after every run whose checksum with its document's key 97
    divides has lost one code point; they have at least 5 code points and occur
    at least 3 times. A null text has no runs, a null key counts as the empty
    string. Near words differ by exactly one inserted, deleted or replaced code
    point. The form is the near word of largest n, of equals the smallest in
    code-point order, if it occurs at least twice as often as the word; else
    null. The root is the last word reached over forms. Repeated rows count each
    time; very long runs are words like others; an empty table has no words.
    `least` says from how many words on a gram is extended; it does not change
    the result. Other columns are ignored.
    """
    counted = materialize(words(df, key, text), "words")
    profiles = materialize(_profiles(counted, frequent_grams(counted, least)), "decomposed")
    pairs = materialize(near_pairs(profiles), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(
        pairs.select("b", "a", "na")
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best")
    )
    rows = counted.join(best, "word", "left")
    m = -F.col("best.less")
    enough = m >= RATIO * F.col("n")
    rows = materialize(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, m).alias("form_n"),
        ),
        "forms",
    )
    roots = _followed(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
