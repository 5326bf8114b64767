"""Documents from operations.

Everything an operation says about a document is lifted to pairs (seq, value),
and pairs are merged by their maximum. That merge is associative, commutative
and idempotent, so operations are combined before the shuffle, a partial state
of one micro-batch can be merged with another, and a replayed batch changes
nothing.

There are two states: one row per document with its fields, and one row per
entry of its nested map. A hot document is combined on the map side, and its
entries are spread over their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.docops import DELETE, MAP_CLEAR, MAP_REMOVE, UPSERT
from tidemark.operators.joins import lookup
from tidemark.session import materialize

DOC_KEY = ["index", "doc_id"]
ENTRY_KEY = ["index", "doc_id", "entry_key"]


def _groups(ops: DataFrame, groups: list[list[str]] | None) -> list[list[str]]:
    """The given groups, with every field they leave out on its own."""
    names = ops.schema["fields"].dataType.names
    grouped = [n for g in groups or [] for n in g]
    return [*(groups or []), *[[n] for n in names if n not in grouped]]


def _merge(states: DataFrame, key: list[str]) -> DataFrame:
    values = [c for c in states.columns if c not in key]
    return states.groupBy(*key).agg(*[F.max(c).alias(c) for c in values])


def merge_docs(states: DataFrame) -> DataFrame:
    """One document row per key from any number of partial ones."""
    return _merge(states, DOC_KEY)


def merge_entries(states: DataFrame) -> DataFrame:
    """One entry row per key from any number of partial ones."""
    return _merge(states, ENTRY_KEY)


def doc_state(ops: DataFrame, groups: list[list[str]] | None = None) -> DataFrame:
    """Partial document state of operations.

    `groups` lists fields that operations always write together: such a group
    keeps one seq, and its newest write replaces all of its members.
    """
    return merge_docs(ops.select(*DOC_KEY, *_doc_writes(ops, groups)))


def _doc_writes(ops: DataFrame, groups: list[list[str]] | None) -> list[Column]:
    """What operations say about a document: created, deleted, and each group's fields."""
    seq, kind, body = F.col("seq"), F.col("kind"), F.col("fields")
    creates = (kind == UPSERT) | (kind.isin(MAP_REMOVE, MAP_CLEAR) & F.col("create_if_absent"))
    written = [F.when(creates, seq).alias("created"), F.when(kind == DELETE, seq).alias("deleted")]
    for names in _groups(ops, groups):
        any_set = F.coalesce(*[body[n].cast("string") for n in names]).isNotNull()
        value = F.struct(*[body[n].alias(n) for n in names])
        set_ = F.when((kind == UPSERT) & any_set, F.struct(seq.alias("seq"), value.alias("value")))
        written.append(set_.alias(f"g_{names[0]}"))
    return written


def _entry_write() -> Column:
    """What an operation says about an entry, or about the whole map when it empties it."""
    return F.struct(
        F.col("seq").alias("seq"), (F.col("kind") == UPSERT).alias("present"), F.col("xattr_raw").alias("raw")
    )


def entry_state(ops: DataFrame) -> DataFrame:
    """Partial map-entry state of operations.

    The row without an entry key holds the last operation that emptied the
    whole map: a DELETE of the document or a MAP_CLEAR.
    """
    resets = F.col("kind").isin(DELETE, MAP_CLEAR)
    rows = ops.filter(resets | F.col("xattr_key").isNotNull()).select(
        *DOC_KEY,
        F.when(~resets, F.col("xattr_key")).alias("entry_key"),
        _entry_write().alias("entry"),
    )
    return merge_entries(rows)


def change_state(ops: DataFrame, groups: list[list[str]] | None = None) -> DataFrame:
    """Document state and entry state in one aggregation, for batches and streams.

    A document's fields and the emptying of its map are in its row without an
    entry key. An operation on an entry gives two rows, one for the document.
    """
    resets = F.col("kind").isin(DELETE, MAP_CLEAR)
    none = F.lit(None).cast("string")
    key = F.col("xattr_key")
    both = F.when(~resets & key.isNotNull(), F.array(none, key)).otherwise(F.array(none))
    rows = ops.withColumn("entry_key", F.explode(both))
    of_doc = F.col("entry_key").isNull()
    writes = {c: F.when(of_doc, F.col(c)) for c in rows.select(*_doc_writes(ops, groups)).columns}
    rows = rows.select(*ENTRY_KEY, *_doc_writes(ops, groups), F.when(resets | ~of_doc, _entry_write()).alias("entry"))
    return merge_entries(rows.withColumns(writes))


def _after(seq: Column, limit: Column) -> Column:
    return seq.isNotNull() & (limit.isNull() | (seq > limit))


def documents(state: DataFrame) -> DataFrame:
    """Live documents of a merged document state.

    What happened at or before the last DELETE is gone; a document is live
    when something after it created the document.
    """
    deleted = F.col("deleted")
    fields = [
        F.when(_after(F.col(g)["seq"], deleted), F.col(g)["value"][name]).alias(name)
        for g in state.columns
        if g.startswith("g_")
        for name in state.schema[g].dataType["value"].dataType.names
    ]
    return state.filter(_after(F.col("created"), deleted)).select(*DOC_KEY, *fields)


def entries(state: DataFrame) -> DataFrame:
    """Map entries of a merged entry state.

    An entry stays when its newest operation set it and nothing emptied the
    map since.
    """
    resets = state.filter(F.col("entry_key").isNull()).select(
        *DOC_KEY, F.col("entry")["seq"].alias("_reset")
    )
    kept = state.filter(F.col("entry_key").isNotNull() & F.col("entry")["present"])
    return (
        lookup(kept, resets, DOC_KEY)
        .filter(_after(F.col("entry")["seq"], F.col("_reset")))
        .select(
            *DOC_KEY,
            F.col("entry_key").alias("xattr_key"),
            F.col("entry")["raw"].alias("xattr_raw"),
        )
    )


def with_maps(docs: DataFrame, entry_rows: DataFrame) -> DataFrame:
    """Documents with their entries as a map column.

    The map has one entry per key of the document, so it is as large as the
    document itself.
    """
    maps = entry_rows.groupBy(*DOC_KEY).agg(
        F.map_from_entries(F.collect_list(F.struct("xattr_key", "xattr_raw"))).alias("xattrs")
    )
    return docs.join(maps, DOC_KEY, "left")


def fold(ops: DataFrame, groups: list[list[str]] | None = None) -> DataFrame:
    """The fields of the documents after all operations."""
    return documents(doc_state(ops, groups))


def fold_entries(ops: DataFrame) -> DataFrame:
    """The map entries of the documents after all operations.

    The merged state is written because it is read twice.
    """
    return entries(materialize(entry_state(ops), "entry-state"))


def fold_whole(ops: DataFrame, groups: list[list[str]] | None = None) -> DataFrame:
    """X1 and X2 together; the operations are written once and read twice."""
    written = materialize(ops, "doc-ops")
    return with_maps(fold(written, groups), fold_entries(written))
