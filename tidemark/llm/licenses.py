"""License scans by ordered signature rules (native).

Words are normalised once; a few stems decide whether a text can hold any
license at all, keywords decide which rules are tried, and a rule marks its
matches in the word string, so that their word positions are read off without
comparing places. A detection is suppressed when a rule of the same or a lower
tier covers its whole interval.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.llm.license_rules import AT_START, BASE, GENERIC, STEMS, TAG, rules

# Separators and words of the contract.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE_TIER = GENERIC + 1
RULE_TYPE = "array<struct<rank:int,tier:int,label:string,keyword:string,pattern:string,confidence:double>>"


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def normal_words(text: str = "text") -> Column:
    """Lower-cased words between single spaces, with a space at both ends."""
    spaced = F.regexp_replace(F.translate(whole_text(text), UPPER, LOWER), SEPARATORS, " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def may_hold(text: str = "text") -> Column:
    """Whether some rule or base phrase can match: every one needs a stem or "cc by".

    Full lower-casing finds every ASCII match, and stems of two words are looked
    for by their first, those at the start of a word by both.
    """
    low = F.lower(whole_text(text))
    stems = [low.contains(s.split()[0]) for s in STEMS if s not in AT_START]
    starts = "|".join(s.replace(" ", SEPARATORS) for s in AT_START)
    hit = low.contains("cc") & low.rlike(r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by")
    hit = hit | low.rlike(f"(?:^|{SEPARATORS[:-1]})(?:{starts})")
    for stem in stems:
        hit = stem | hit
    return hit


def rule_table() -> Column:
    """The base phrases and all rules as one literal array."""
    rows = [
        {"rank": i, "tier": BASE_TIER, "label": label, "keyword": f" {phrase} ", "pattern": phrase, "confidence": 0.5}
        for i, (phrase, label) in enumerate(BASE.items())
    ]
    rows += [{"rank": len(BASE) + i, **rule._asdict()} for i, rule in enumerate(rules())]
    return F.from_json(F.lit(json.dumps(rows)), RULE_TYPE)


def _places(marked: Column, mark: str, at_end: bool) -> Column:
    """Positions of the words that start or end with the mark."""
    words = F.split(F.trim(marked), " ")
    test = (lambda w: w.endswith(mark)) if at_end else (lambda w: w.startswith(mark))
    places = F.transform(words, lambda w, i: F.when(test(w), i.cast("long")))
    return F.filter(places, lambda p: p.isNotNull())


def matches(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per rule match: _row, rank, tier, label, confidence, first, last (words).

    Rows without a match come once, with nulls, so that every document is kept;
    `n_words` is on every row.
    """
    docs = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).alias("_key"),
        word_count(text).alias("n_words"),
        F.when(may_hold(text), normal_words(text)).alias("_norm"),
    )
    tried = F.filter(rule_table(), lambda r: F.col("_norm").contains(r["keyword"]))
    docs = docs.withColumn("_rule", F.explode_outer(F.when(F.col("_norm").isNotNull(), tried)))
    # A mark cannot be in the text: control characters separate words.
    framed = F.concat(F.lit("(?<= )("), F.col("_rule.pattern"), F.lit(")(?= )"))
    docs = docs.withColumn(
        "_marked", F.regexp_replace(F.col("_norm"), framed, F.lit("\u0001$1\u0002"))
    )
    pairs = F.arrays_zip(
        _places(F.col("_marked"), "\u0001", False).alias("first"),
        _places(F.col("_marked"), "\u0002", True).alias("last"),
    )
    found = F.filter(F.when(F.col("_marked").contains("\u0001"), pairs), lambda p: p["first"].isNotNull())
    docs = docs.select("_row", "_key", "n_words", "_rule", F.explode_outer(found).alias("_at"))
    hit = F.col("_at").isNotNull()
    return docs.select(
        "_row",
        "_key",
        "n_words",
        *[F.when(hit, F.col(f"_rule.{c}")).alias(c) for c in ("rank", "tier", "label", "confidence")],
        F.col("_at.first").alias("first"),
        F.col("_at.last").alias("last"),
    )


def resolved(found: DataFrame) -> DataFrame:
    """Matches with `kept`: not covered by a match of the same or a lower tier.

    Sorted by start and then by longest interval, everything that can cover a
    match stands before it, so the largest end so far in each tier decides. A
    document's matches are one window; base phrases take no part.
    """
    order = Window.partitionBy("_row").orderBy("first", F.col("last").desc(), "tier", "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for tier in range(TAG, GENERIC + 1):
        end = F.max(F.when(F.col("tier") <= tier, F.col("last"))).over(before)
        covered = F.when(F.col("tier") == tier, end >= F.col("last")).otherwise(covered)
    return found.withColumn(
        "kept", (F.col("tier") <= GENERIC) & ~F.coalesce(covered, F.lit(False))
    )


def licenses(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: base counts and labels, all labels, spans, score.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
    n_base counts all places of all base phrases, first_word and last_word are
    their smallest and largest start (null without any). `labels` joins the base
    labels and those of the detections kept; `spans` has the latter with their
    words; `score` is the confidence of the surest one kept, 0 without any.
    Null and empty texts have no words. Repeated rows are reported each, null
    keys are kept, other columns are ignored; an empty table gives no rows.
    """
    found = resolved(matches(df, key, text))
    base = F.col("tier") == BASE_TIER
    per = found.groupBy("_row", "_key", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("_base"),
        F.collect_set(F.when(base | F.col("kept"), F.col("label"))).alias("_all"),
        F.collect_list(F.when(F.col("kept"), F.struct("first", "last", "label"))).alias("spans"),
        F.max(F.when(F.col("kept"), F.col("confidence"))).alias("_score"),
    )
    return per.select(
        F.col("_key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort("_all"), ",").alias("labels"),
        F.array_sort("spans").alias("spans"),
        F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
