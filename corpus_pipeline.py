"""From raw documents to the token ids of a training mix, in five stages.

Each stage works on all rows its predecessor kept; every result but the last has
the columns of `documents` and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.byte_bpe import encoded
from tidemark.llm.common import table
from tidemark.llm.exact_dedup import without_copies
from tidemark.llm.jaccard import without_near_copies
from tidemark.llm.mixing import mixed
from tidemark.llm.quality import good
from tidemark.session import materialize

# Near copies share four fifths of their five-word shingles.
SHINGLE, SIMILAR = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds to be of quality."""
    return good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest id."""
    return without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return without_near_copies(docs, k=SHINGLE, similar=SIMILAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; none for some, twice at most."""
    return mixed(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, their digest, and that of the text decoded from them."""
    return encoded(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

# The classifier and the shingle sets are not expressible in SQL; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
