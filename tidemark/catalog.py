"""A table catalog derived from the star tables, for the catalog cascade.

Customers stand for tables, orders for partitions, suppliers for indexes; each
has a storage descriptor, and the partitions of a table share its column list.
The expressions are valid in Spark and in plain SQL.
"""

from __future__ import annotations

# Catalog table: selections from star tables, put together.
CATALOG: dict[str, list[tuple[str, str]]] = {
    "DBS": [("nation", "cast(n_nationkey as bigint) as DB_ID, cast(n_nationkey * 10 + 9 as bigint) as SD_ID")],
    "TBLS": [
        (
            "customer",
            "cast(c_custkey as bigint) as TBL_ID, cast(c_nationkey as bigint) as DB_ID, "
            "cast(c_custkey * 10 + 1 as bigint) as SD_ID",
        )
    ],
    "PARTITIONS": [
        (
            "orders",
            "cast(o_orderkey as bigint) as PART_ID, cast(o_custkey as bigint) as TBL_ID, "
            "cast(o_orderkey * 10 + 2 as bigint) as SD_ID",
        )
    ],
    "IDXS": [
        (
            "supplier",
            "cast(s_suppkey as bigint) as INDEX_ID, cast(s_suppkey * 3 as bigint) as ORIG_TBL_ID, "
            "cast(s_suppkey * 7 as bigint) as INDEX_TBL_ID, cast(s_suppkey * 10 + 3 as bigint) as SD_ID",
        )
    ],
    "SDS": [
        (
            "customer",
            "cast(c_custkey * 10 + 1 as bigint) as SD_ID, cast(c_custkey as bigint) as CD_ID, "
            "cast(c_custkey * 10 + 1 as bigint) as SERDE_ID, cast(1 as bigint) as PARTITION_ID, "
            "cast(c_nationkey as bigint) as PARENT_ID, cast(c_custkey as string) as NAME",
        ),
        (
            "orders",
            "cast(o_orderkey * 10 + 2 as bigint), cast(o_custkey as bigint), cast(o_orderkey * 10 + 2 as bigint), "
            "cast(2 as bigint), cast(o_custkey as bigint), cast(o_orderkey as string)",
        ),
        (
            "supplier",
            "cast(s_suppkey * 10 + 3 as bigint), cast(1000000 + s_suppkey as bigint), cast(s_suppkey * 10 + 3 as bigint), "
            "cast(3 as bigint), cast(s_nationkey as bigint), cast(s_suppkey as string)",
        ),
    ],
    "CDS": [
        ("customer", "cast(c_custkey as bigint) as CD_ID"),
        ("supplier", "cast(1000000 + s_suppkey as bigint)"),
    ],
    "SERDES": [
        ("customer", "cast(c_custkey * 10 + 1 as bigint) as SERDE_ID"),
        ("orders", "cast(o_orderkey * 10 + 2 as bigint)"),
        ("supplier", "cast(s_suppkey * 10 + 3 as bigint)"),
    ],
    "I_SCHEMA": [("nation", "cast(n_nationkey as bigint) as SCHEMA_ID, cast(n_nationkey as bigint) as DB_ID")],
    "SCHEMA_VERSION": [
        (
            "part",
            "cast(p_partkey as bigint) as SCHEMA_VERSION_ID, cast(p_partkey % 25 as bigint) as SCHEMA_ID, "
            "cast(p_partkey as bigint) as CD_ID, cast(p_partkey * 10 + 2 as bigint) as SERDE_ID",
        )
    ],
    "COLUMNS_V2": [
        ("customer", "cast(c_custkey as bigint) as CD_ID, 'name' as COLUMN_NAME"),
        ("customer", "cast(c_custkey as bigint), c_mktsegment"),
    ],
    "SD_PARAMS": [("orders", "cast(o_orderkey * 10 + 2 as bigint) as SD_ID, o_orderpriority as PARAM_KEY")],
    "SERDE_PARAMS": [("customer", "cast(c_custkey * 10 + 1 as bigint) as SERDE_ID, c_mktsegment as PARAM_KEY")],
    "TABLE_PARAMS": [("customer", "cast(c_custkey as bigint) as TBL_ID, c_mktsegment as PARAM_KEY")],
    "TAB_COL_STATS": [("customer", "cast(c_custkey as bigint) as CS_ID, cast(c_custkey as bigint) as TBL_ID")],
    "PART_COL_STATS": [("orders", "cast(o_orderkey * 2 as bigint) as CS_ID, cast(o_orderkey as bigint) as PART_ID")],
    "SKEWED_STRING_LIST": [("customer", "cast(c_custkey as bigint) as STRING_LIST_ID")],
    "SKEWED_STRING_LIST_VALUES": [("customer", "cast(c_custkey as bigint) as STRING_LIST_ID, cast(0 as bigint) as INTEGER_IDX")],
    "SKEWED_VALUES": [
        (
            "orders",
            "cast(o_orderkey * 10 + 2 as bigint) as SD_ID_OID, cast(0 as bigint) as INTEGER_IDX, "
            "cast(o_custkey as bigint) as STRING_LIST_ID_EID",
        )
    ],
    "SKEWED_COL_VALUE_LOC_MAP": [
        ("supplier", "cast(s_suppkey * 10 + 3 as bigint) as SD_ID, cast(s_suppkey * 11 as bigint) as STRING_LIST_ID_KID")
    ],
}
# What the change feed reports as deleted: catalog table and the rows, of a star table, it names.
DELETED: dict[str, tuple[str, str, str]] = {
    "DBS": ("nation", CATALOG["DBS"][0][1], "n_nationkey in (3, 11)"),
    "PARTITIONS": ("orders", CATALOG["PARTITIONS"][0][1], "o_orderkey % 7 in (0, 1) or o_custkey % 5 = 0"),
    "IDXS": ("supplier", CATALOG["IDXS"][0][1], "s_suppkey % 4 = 0"),
    "INODES": (
        "customer",
        "cast(c_nationkey as bigint) as parent_id, cast(c_custkey as string) as name, cast(1 as bigint) as partition_id",
        "c_custkey % 13 = 0",
    ),
}
