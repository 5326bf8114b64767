import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import codes, keys, values
from tidemark.sources import feeds, schemas


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"project_iid": 7, "prov_type": {"prov_status": "all"}}', ("ALL", 7)),
        ('{"project_iid": 8, "prov_type": {"prov_status": "State"}}', ("STATE", 8)),
        ('{"project_iid": 9, "prov_type": {"prov_status": "NONE"}}', ("NONE", 9)),
        ('{"project_iid": 9, "prov_type": {"prov_status": "some"}}', None),
        ('{"prov_type": {"prov_status": "ALL"}}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_store_mode(spark, text, expected):
    got = one(spark, text, values.store_mode)
    assert (None if got is None else tuple(got)) == expected


def test_store_mode_strict_fails(spark):
    with pytest.raises(Exception, match="store mode not recognized"):
        one(spark, "not json", values.store_mode_strict)


def test_readable_time_has_no_padding(spark):
    assert one(spark, 1564997115999, values.readable_time, "long") == "2019.Aug.5 9:25:15"


def test_char_text_keeps_blank_strings(spark):
    assert one(spark, "ab  ", values.char_text) == "ab"
    assert one(spark, "   ", values.char_text) == "   "


def test_latin1(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xe9"),)], "v binary")
    assert feeds.normalise(df, latin1_columns=["v"]).first()["v"] == "café"


def test_overloaded_columns_wrap(spark):
    assert one(spark, 65537, values.num_parts, "long") == 1
    assert one(spark, 32768, values.num_parts, "long") == -32768
    assert one(spark, 133, values.namespace, "long") == -123


@pytest.mark.parametrize("text, is_json", [("{}", True), ("1", True), ('"x"', True), ("", False), ("x", False)])
def test_json_or_text(spark, text, is_json):
    assert one(spark, text, values.is_json) is is_json
    as_text = one(spark, text, lambda c: F.to_json(values.json_or_text(c)))
    assert as_text == (text if is_json else f'"{text}"')


def test_names(spark):
    assert one(spark, 11, codes.fs_op_name, "int") == "XAttrAddAll"
    assert one(spark, 5, codes.fs_op_name, "int") == codes.UNKNOWN_NAME
    assert one(spark, 1, codes.admin_target_name, "int") == "Project"


def test_unknown_provenance_op_fails(spark):
    assert one(spark, "OTHER", codes.provenance_op) == "OTHER"
    with pytest.raises(Exception, match="no such operation"):
        one(spark, "TRUNCATE", codes.provenance_op)


def test_keys(spark):
    df = spark.createDataFrame([(1, 2, 3)], "dataset_id long, inode_id long, logical_time int")
    assert df.select(keys.key_string(keys.MUTATION_KEY)).first()[0] == "1-2-3"


def test_all_schemas_parse():
    for ddl in [*schemas.LOGS.values(), *schemas.CATALOG.values(), schemas.INODES, schemas.XATTRS]:
        assert schemas.struct(ddl).names


def test_subscribe_reads_pre_image_of_deletes(spark):
    event = schemas.change_event("CD_ID long")
    df = spark.createDataFrame(
        [("DELETE", 1, (5,), None), ("INSERT", 2, None, (6,)), ("DROP", 3, None, None)], event
    )
    assert rows(feeds.deleted_rows(df, "CDS")) == [(1, 5)]
    assert rows(feeds.subscribe(df, ["INSERT", "DROP"], ["CD_ID"])) == [("INSERT", 2, 6)]
