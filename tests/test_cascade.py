"""The catalog cleanup cases: deletes applied one after another."""

import pytest

from tidemark.plans import cascade
from tidemark.sources import schemas


def table(spark, name, data):
    return spark.createDataFrame(data, schemas.struct(schemas.CATALOG[name]))


@pytest.fixture(scope="module")
def catalog(spark):
    """Three tables; table 2 has partitions 1..68 on descriptors 6..73."""
    partitions = [(p, p + 5, 2, f"zip={p}") for p in range(1, 69)]
    sds = [(1, None, None), (4, 1, 204), (5, 2, 205), (86, 11, 286)]
    sds += [(sd, 2, sd - 3) for _, sd, _, _ in partitions]
    lists = list(range(75, 95))
    rows = {
        "DBS": [(2, 1, "db", "hive")],
        "TBLS": [
            (1, 2, 4, "ext", "EXTERNAL_TABLE"),
            (2, 2, 5, "plain", "MANAGED_TABLE"),
            (11, 2, 86, "skewed", "MANAGED_TABLE"),
        ],
        "PARTITIONS": partitions,
        "IDXS": [(1, 90, 1, 1)],
        "SDS": [(*s, f"n{s[0]}", 1, 1) for s in [*sds, (90, 1, 90)]],
        "CDS": [(1,), (2,), (11,)],
        "SERDES": [(s, 0, f"s{s}") for s in {x[2] for x in sds if x[2]} | {90}],
        "COLUMNS_V2": [(cd, f"c{i}", "int", i) for cd in (1, 2, 11) for i in range(4)],
        "SCHEMA_VERSION": [(1, 1, 2, None, 1), (2, 1, 1, 18, 2), (3, 1, 1, None, 3)],
        "I_SCHEMA": [(1, 2, "schema")],
        "SD_PARAMS": [(21, "k", "v"), (5, "k", "v")],
        "SERDE_PARAMS": [(18, "k", "v"), (19, "k", "v")],
        "TABLE_PARAMS": [(t, "k", "v") for t in (1, 2, 11)],
        "TAB_COL_STATS": [(1, 2, "c0", 0, 1.0), (2, 11, "c0", 0, 1.0)],
        "PART_COL_STATS": [(1, 16, "c0"), (2, 17, "c0")],
        "SKEWED_STRING_LIST": [(i,) for i in lists],
        "SKEWED_STRING_LIST_VALUES": [(i, j, "v") for i in lists for j in (0, 1)],
        "SKEWED_VALUES": [(86, i, 87 + i) for i in range(4)],
        "SKEWED_COL_VALUE_LOC_MAP": [(86, i, "loc") for i in range(91, 95)],
    }
    return {name: table(spark, name, data) for name, data in rows.items()}


def ids(df, column):
    return {r[0] for r in df.select(column).collect()}


def delete(tables, name, condition):
    return cascade.clean_catalog(tables, {name: tables[name].filter(condition)})


def test_delete_one_partition(catalog):
    left = delete(catalog, "PARTITIONS", "PART_ID = 16")
    assert 16 not in ids(left["PARTITIONS"], "PART_ID")
    assert 21 not in ids(left["SDS"], "SD_ID")
    assert 18 not in ids(left["SERDES"], "SERDE_ID")
    assert ids(left["CDS"], "CD_ID") == {1, 2, 11}
    assert 2 in ids(left["COLUMNS_V2"], "CD_ID")
    assert 2 in ids(left["TBLS"], "TBL_ID")
    assert ids(left["SD_PARAMS"], "SD_ID") == {5}
    assert ids(left["SERDE_PARAMS"], "SERDE_ID") == {19}
    assert ids(left["PART_COL_STATS"], "CS_ID") == {2}
    assert ids(left["SCHEMA_VERSION"], "SCHEMA_VERSION_ID") == {1, 3}
    assert left["SDS"].count() == catalog["SDS"].count() - 1


def test_delete_all_partitions_then_the_table(catalog):
    left = delete(catalog, "PARTITIONS", "true")
    assert left["PARTITIONS"].count() == 0
    assert ids(left["CDS"], "CD_ID") == {1, 2, 11}
    assert 2 in ids(left["COLUMNS_V2"], "CD_ID")
    left = delete(left, "TBLS", "TBL_ID = 2")
    assert ids(left["TBLS"], "TBL_ID") == {1, 11}
    assert ids(left["CDS"], "CD_ID") == {1, 11}
    assert 2 not in ids(left["COLUMNS_V2"], "CD_ID")
    assert ids(left["TABLE_PARAMS"], "TBL_ID") == {1, 11}
    assert ids(left["TAB_COL_STATS"], "TBL_ID") == {11}


def test_delete_table_takes_partitions_and_shared_columns(catalog):
    left = delete(catalog, "TBLS", "TBL_ID = 2")
    assert left["PARTITIONS"].count() == 0
    assert ids(left["CDS"], "CD_ID") == {1, 11}


def test_delete_skewed_value(catalog):
    left = delete(catalog, "SKEWED_VALUES", "SD_ID_OID = 86 and STRING_LIST_ID_EID = 88")
    assert 88 not in ids(left["SKEWED_STRING_LIST"], "STRING_LIST_ID")
    assert 88 not in ids(left["SKEWED_STRING_LIST_VALUES"], "STRING_LIST_ID")
    assert {87, 89} <= ids(left["SKEWED_STRING_LIST"], "STRING_LIST_ID")


def test_delete_skewed_table(catalog):
    left = delete(catalog, "TBLS", "TBL_ID = 11")
    assert ids(left["SKEWED_STRING_LIST"], "STRING_LIST_ID") == set(range(75, 87))
    assert ids(left["SKEWED_STRING_LIST_VALUES"], "STRING_LIST_ID") == set(range(75, 87))
    assert left["SKEWED_COL_VALUE_LOC_MAP"].count() == 0


def test_delete_database_takes_everything_it_owns(catalog):
    left = delete(catalog, "DBS", "DB_ID = 2")
    for name in ("TBLS", "PARTITIONS", "IDXS", "I_SCHEMA", "SCHEMA_VERSION", "CDS", "TABLE_PARAMS"):
        assert left[name].count() == 0, name


def test_nothing_deleted_leaves_all(catalog):
    left = delete(catalog, "TBLS", "TBL_ID = 99")
    assert all(left[n].count() == catalog[n].count() for n in catalog)
