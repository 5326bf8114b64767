"""Cleanup of dependent rows after deletes, to a fixpoint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import keep_existing, keep_missing
from tidemark.session import materialize


@dataclass(frozen=True)
class Rule:
    """Deleting a row of `table` deletes the rows of `target` it points to.

    With `shared`, a target goes only when no remaining row of `table` points
    to it any more.
    """

    table: str
    columns: tuple[str, ...]
    target: str
    target_columns: tuple[str, ...]
    shared: bool = False


def rule(table: str, column: str, target: str, target_column: str, shared: bool = False) -> Rule:
    return Rule(table, (column,), target, (target_column,), shared)


# What the cleaner deletes when a row of the first table is deleted.
CLEANUP_RULES = [
    rule("DBS", "DB_ID", "TBLS", "DB_ID"),
    rule("TBLS", "TBL_ID", "TABLE_PARAMS", "TBL_ID"),
    rule("TBLS", "TBL_ID", "TAB_COL_STATS", "TBL_ID"),
    rule("TBLS", "SD_ID", "SDS", "SD_ID"),
    rule("PARTITIONS", "PART_ID", "PART_COL_STATS", "PART_ID"),
    rule("PARTITIONS", "SD_ID", "SDS", "SD_ID"),
    rule("IDXS", "SD_ID", "SDS", "SD_ID"),
    rule("SDS", "CD_ID", "CDS", "CD_ID", shared=True),
    rule("SDS", "SERDE_ID", "SERDES", "SERDE_ID"),
    rule("SDS", "SD_ID", "TBLS", "SD_ID"),
    rule("SDS", "SD_ID", "SD_PARAMS", "SD_ID"),
    rule("CDS", "CD_ID", "SCHEMA_VERSION", "CD_ID"),
    rule("CDS", "CD_ID", "COLUMNS_V2", "CD_ID"),
    rule("SERDES", "SERDE_ID", "SCHEMA_VERSION", "SERDE_ID"),
    rule("SERDES", "SERDE_ID", "SERDE_PARAMS", "SERDE_ID"),
    rule("I_SCHEMA", "SCHEMA_ID", "SCHEMA_VERSION", "SCHEMA_ID"),
    rule("SKEWED_COL_VALUE_LOC_MAP", "STRING_LIST_ID_KID", "SKEWED_STRING_LIST", "STRING_LIST_ID", shared=True),
    rule("SKEWED_VALUES", "STRING_LIST_ID_EID", "SKEWED_STRING_LIST", "STRING_LIST_ID", shared=True),
]

# C11: foreign keys of the catalog that delete children with their parent.
FOREIGN_KEY_RULES = [
    rule("DBS", "DB_ID", "I_SCHEMA", "DB_ID"),
    rule("TBLS", "TBL_ID", "PARTITIONS", "TBL_ID"),
    rule("TBLS", "TBL_ID", "IDXS", "ORIG_TBL_ID"),
    rule("TBLS", "TBL_ID", "IDXS", "INDEX_TBL_ID"),
    rule("SDS", "SD_ID", "DBS", "SD_ID"),
    rule("SDS", "SD_ID", "PARTITIONS", "SD_ID"),
    rule("SDS", "SD_ID", "IDXS", "SD_ID"),
    rule("SDS", "SD_ID", "SKEWED_VALUES", "SD_ID_OID"),
    rule("SDS", "SD_ID", "SKEWED_COL_VALUE_LOC_MAP", "SD_ID"),
    rule("CDS", "CD_ID", "SDS", "CD_ID"),
    rule("SERDES", "SERDE_ID", "SDS", "SERDE_ID"),
    rule("SKEWED_STRING_LIST", "STRING_LIST_ID", "SKEWED_STRING_LIST_VALUES", "STRING_LIST_ID"),
    rule("SKEWED_STRING_LIST", "STRING_LIST_ID", "SKEWED_VALUES", "STRING_LIST_ID_EID"),
    rule("SKEWED_STRING_LIST", "STRING_LIST_ID", "SKEWED_COL_VALUE_LOC_MAP", "STRING_LIST_ID_KID"),
    Rule("INODES", ("partition_id", "parent_id", "name"), "SDS", ("PARTITION_ID", "PARENT_ID", "NAME")),
]
CATALOG_RULES = CLEANUP_RULES + FOREIGN_KEY_RULES

CATALOG_KEYS = {
    "DBS": ["DB_ID"],
    "TBLS": ["TBL_ID"],
    "PARTITIONS": ["PART_ID"],
    "IDXS": ["INDEX_ID"],
    "SDS": ["SD_ID"],
    "CDS": ["CD_ID"],
    "SERDES": ["SERDE_ID"],
    "COLUMNS_V2": ["CD_ID", "COLUMN_NAME"],
    "SCHEMA_VERSION": ["SCHEMA_VERSION_ID"],
    "I_SCHEMA": ["SCHEMA_ID"],
    "SD_PARAMS": ["SD_ID", "PARAM_KEY"],
    "SERDE_PARAMS": ["SERDE_ID", "PARAM_KEY"],
    "TABLE_PARAMS": ["TBL_ID", "PARAM_KEY"],
    "TAB_COL_STATS": ["CS_ID"],
    "PART_COL_STATS": ["CS_ID"],
    "SKEWED_STRING_LIST": ["STRING_LIST_ID"],
    "SKEWED_STRING_LIST_VALUES": ["STRING_LIST_ID", "INTEGER_IDX"],
    "SKEWED_VALUES": ["SD_ID_OID", "INTEGER_IDX"],
    "SKEWED_COL_VALUE_LOC_MAP": ["SD_ID", "STRING_LIST_ID_KID"],
    "INODES": ["parent_id", "name", "partition_id"],
}


class References:
    """How many rows of a table still point to each target of a shared rule.

    The table is counted once; every round adds the rows it deleted as negative
    counts. So no round reads the referencing table again.
    """

    def __init__(self, r: Rule, rows: DataFrame):
        self.rule = r
        self.counts = materialize(self._counted(rows, 1), "references")

    def _counted(self, rows: DataFrame, sign: int) -> DataFrame:
        named = rows.select(*_target_key(self.rule)).dropna()
        return named.groupBy(*self.rule.target_columns).agg((sign * F.count(F.lit(1))).alias("refs"))

    def lose(self, rows: DataFrame) -> None:
        self.counts = self.counts.unionByName(materialize(self._counted(rows, -1), "references"))

    def unused(self, keys: DataFrame) -> DataFrame:
        """Those of the target keys to which no row points any more."""
        on = list(self.rule.target_columns)
        left = keep_existing(self.counts, keys, on).groupBy(*on).agg(F.sum("refs").alias("refs"))
        return keep_missing(keys, left.filter("refs > 0").select(*on), on)


def _target_key(r: Rule) -> list:
    return [F.col(a).alias(b) for a, b in zip(r.columns, r.target_columns)]


def cascade(
    tables: dict[str, DataFrame],
    keys: dict[str, list[str]],
    rules: list[Rule],
    deleted: dict[str, DataFrame],
) -> dict[str, DataFrame]:
    """All rows that go, per table, given the rows deleted first.

    Only the rows deleted in one round trigger the next, and deleted rows are
    written once per round. A round that deletes nothing ends the loop; every
    other round deletes at least one row, so cycles in the rules end too. The
    rows deleted first may, as in a change feed, be gone from their table
    already. The surviving rows are those of `survivors`.
    """
    wanted = {}
    for r in rules:
        for name, columns in ((r.table, r.columns), (r.target, r.target_columns)):
            wanted.setdefault(name, set()).update(columns)
    names = {name: list(dict.fromkeys([*keys[name], *sorted(columns)])) for name, columns in wanted.items()}
    slim = {name: tables[name].select(*columns) for name, columns in names.items() if name in tables}
    shared = [r for r in rules if r.shared and r.table in slim and r.target in slim]
    # Rows that a shared rule counts are counted, and deleted, once.
    for name in {r.table for r in shared}:
        slim[name] = materialize(slim[name].distinct(), f"slim-{name}")
    counts = {r: References(r, slim[r.table]) for r in shared}
    fresh = {
        name: materialize(rows.select(*names[name]).distinct(), f"gone-{name}") for name, rows in deleted.items()
    }
    for r in shared:
        if r.table in fresh:
            counts[r].lose(keep_existing(slim[r.table], fresh[r.table], keys[r.table]))
    gone = dict(fresh)
    while fresh:
        matches: dict[str, list[DataFrame]] = {}
        for r in rules:
            if r.table not in fresh or r.target not in slim:
                continue
            hit = fresh[r.table].select(*_target_key(r)).dropna().distinct()
            hit = counts[r].unused(hit) if r in counts else hit
            rows = keep_existing(slim[r.target], hit, list(r.target_columns))
            matches.setdefault(r.target, []).append(rows)
        fresh = {}
        for name, parts in matches.items():
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            rows = rows.distinct() if len(parts) > 1 else rows
            if name in gone:
                rows = keep_missing(rows, gone[name], keys[name])
            written = materialize(rows, f"gone-{name}")
            if not written.isEmpty():
                fresh[name] = written
        for name, rows in fresh.items():
            gone[name] = gone[name].unionByName(rows) if name in gone else rows
            for r in shared:
                if r.table == name:
                    counts[r].lose(rows)
    return gone


def survivors(
    tables: dict[str, DataFrame], keys: dict[str, list[str]], gone: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """K4 for every table: the rows that stay."""
    return {
        name: keep_missing(df, gone[name], keys[name]) if name in gone else df
        for name, df in tables.items()
    }


def clean_catalog(
    tables: dict[str, DataFrame], deleted: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """C1-C11 over the catalog: surviving rows after the given deletes."""
    gone = cascade(tables, CATALOG_KEYS, CATALOG_RULES, deleted)
    return survivors(tables, CATALOG_KEYS, gone)
