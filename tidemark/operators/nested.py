"""Nested map values: objects that merge path by path.

Adding an object to an entry that holds one merges the two, at every depth; any
other value replaces what is at its path and below. A value is shredded to one
node per path: an object, or a leaf with its JSON text. As elsewhere a node
keeps the newest write, so the state is a maximum per path and operations merge
in any order; what a later leaf above, a removal or an emptied map covers is
told apart when the state is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import is_json
from tidemark.operators.docops import DELETE, MAP_CLEAR, MAP_REMOVE, UPSERT
from tidemark.operators.fold import DOC_KEY, ENTRY_KEY, _after
from tidemark.operators.joins import lookup
from tidemark.session import materialize

NODES = "array<struct<path: array<string>, leaf: string>>"


def shredded(raw: Column) -> Column:
    """F16: the nodes of a value, parents before children; an object has no leaf.

    Text that is not JSON is a leaf at the root, a string. Arrays are leaves,
    since a merge replaces them whole. A leaf is compact JSON text.
    """

    @F.arrow_udf(NODES)
    def nodes(texts, valid):
        import json

        import pyarrow as pa

        def leaf(value):
            return json.dumps(value, ensure_ascii=False, separators=(",", ":"))

        def cut(text, parses):
            if text is None:
                return None
            out, left = [], [([], json.loads(text) if parses else text)]
            while left:
                path, value = left.pop()
                if isinstance(value, dict):
                    out.append({"path": path, "leaf": None})
                    left.extend(([*path, k], v) for k, v in value.items())
                else:
                    out.append({"path": path, "leaf": leaf(value)})
            return out

        kind = pa.list_(pa.struct([("path", pa.list_(pa.string())), ("leaf", pa.string())]))
        return pa.array([cut(t, v) for t, v in zip(texts.to_pylist(), valid.to_pylist())], kind)

    return nodes(raw, is_json(raw))


def nested_state(ops: DataFrame) -> DataFrame:
    """Newest writes per document, entry and path: `leaf` (seq, present, text) and `object` (seq).

    A removed entry is an absent leaf at its root; a document that is deleted or
    whose map is emptied has one in its row without an entry key.
    """
    kind, seq = F.col("kind"), F.col("seq")
    resets = kind.isin(DELETE, MAP_CLEAR)
    touched = ops.filter(resets | (F.col("xattr_key").isNotNull() & kind.isin(UPSERT, MAP_REMOVE)))
    sets = (kind == UPSERT) & F.col("xattr_raw").isNotNull()
    absent = F.array(F.struct(F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("leaf")))
    nodes = F.when(sets, shredded(F.col("xattr_raw"))).otherwise(absent)
    rows = touched.select(
        *DOC_KEY,
        F.when(~resets, F.col("xattr_key")).alias("entry_key"),
        "seq",
        sets.alias("_sets"),
        F.explode(nodes).alias("_node"),
    )
    text = F.col("_node.leaf")
    leaf = F.struct(seq.alias("seq"), F.col("_sets").alias("present"), text.alias("text"))
    return merge_nested(
        rows.select(
            *ENTRY_KEY,
            F.col("_node.path").alias("path"),
            F.when(text.isNotNull() | ~F.col("_sets"), leaf).alias("leaf"),
            F.when(text.isNull() & F.col("_sets"), seq).alias("object"),
        )
    )


def merge_nested(states: DataFrame) -> DataFrame:
    """One row per path from any number of partial states."""
    return states.groupBy(*ENTRY_KEY, "path").agg(F.max("leaf").alias("leaf"), F.max("object").alias("object"))


def live_nodes(state: DataFrame) -> DataFrame:
    """index, doc_id, xattr_key, path, leaf: the nodes that nothing newer covers; objects have no leaf."""
    resets = state.filter(F.col("entry_key").isNull()).select(*DOC_KEY, F.col("leaf")["seq"].alias("_reset"))
    nodes = state.filter(F.col("entry_key").isNotNull())
    # A leaf, or a removal, covers all that is older below its path.
    above = F.transform(F.sequence(F.lit(0), F.size("path") - 1), lambda i: F.slice("path", F.lit(1), i))
    deep = nodes.filter(F.size("path") > 0).select(*ENTRY_KEY, "path", F.explode(above).alias("_above"))
    covers = nodes.filter("leaf is not null").select(
        *ENTRY_KEY, F.col("path").alias("_above"), F.col("leaf")["seq"].alias("_seq")
    )
    covered = deep.join(covers, [*ENTRY_KEY, "_above"]).groupBy(*ENTRY_KEY, "path").agg(F.max("_seq").alias("_covered"))
    rows = lookup(lookup(nodes, covered, [*ENTRY_KEY, "path"]), resets, DOC_KEY)
    limit, own = F.greatest("_reset", "_covered"), F.col("leaf")["seq"]
    is_leaf = _after(own, limit) & _after(own, F.col("object")) & F.col("leaf")["present"]
    is_object = _after(F.col("object"), limit) & _after(F.col("object"), own)
    return rows.filter(is_leaf | is_object).select(
        *DOC_KEY,
        F.col("entry_key").alias("xattr_key"),
        "path",
        F.when(is_leaf, F.col("leaf")["text"]).alias("leaf"),
    )


KEY = [*DOC_KEY, "xattr_key"]


def nested_leaves(state: DataFrame) -> DataFrame:
    """index, doc_id, xattr_key, path, leaf: the leaves of all values, `{}` where an object is empty."""
    live = materialize(live_nodes(state), "nodes")
    parents = live.filter(F.size("path") > 0).select(*KEY, _parent().alias("path")).distinct()
    inner = live.filter("leaf is null").join(parents, [*KEY, "path"], "left_anti")
    return live.filter("leaf is not null").union(inner.withColumn("leaf", F.lit("{}")))


def _parent() -> Column:
    return F.slice("path", F.lit(1), F.size("path") - 1)


def _quoted(text: Column) -> Column:
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.char_length(whole) - 2)


def nested_values(state: DataFrame) -> DataFrame:
    """index, doc_id, xattr_key, value: each entry's merged value as compact JSON text, names in order.

    Values are put together from the deepest level up, one grouping a level.
    """
    live = materialize(live_nodes(state), "nodes")
    depth = live.agg(F.max(F.size("path"))).first()[0] or 0
    done = live.filter(F.size("path") == depth).withColumn("value", F.coalesce("leaf", F.lit("{}")))
    for level in range(depth - 1, -1, -1):
        part = F.concat(_quoted(F.element_at("path", -1)), F.lit(":"), F.col("value"))
        member = F.struct(F.element_at("path", -1).alias("name"), part.alias("text"))
        members = done.select(*KEY, _parent().alias("path"), member.alias("member"))
        inside = members.groupBy(*KEY, "path").agg(F.sort_array(F.collect_list("member")).alias("_members"))
        joined = F.concat(F.lit("{"), F.array_join(F.col("_members.text"), ","), F.lit("}"))
        here = live.filter(F.size("path") == level).join(inside, [*KEY, "path"], "left")
        value = F.coalesce("leaf", joined, F.lit("{}"))
        done = materialize(here.select(*KEY, "path", "leaf", value.alias("value")), "level")
    return done.select(*KEY, "value")
