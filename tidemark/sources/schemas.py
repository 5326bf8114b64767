"""Schemas of change logs, dimensions, catalog tables and document operations."""

from __future__ import annotations

from pyspark.sql import types as T

FS_MUTATION = (
    "dataset_id long, inode_id long, logical_time int, pk1 long, pk2 long, pk3 string, "
    "operation byte, inode_partition_id long, inode_parent_id long, inode_name string"
)
OPS_LOG = (
    "id int, op_id int, op_on byte, op_type byte, project_id int, dataset_id long, inode_id long"
)
FILE_PROV = (
    "inode_id long, inode_operation string, io_logical_time int, io_timestamp long, "
    "io_app_id string, io_user_id int, tb string, i_partition_id long, project_i_id long, "
    "dataset_i_id long, parent_i_id long, i_name string, project_name string, "
    "dataset_name string, i_p1_name string, i_p2_name string, i_parent_name string, "
    "i_user_name string, i_xattr_name string, io_logical_time_batch int, "
    "io_timestamp_batch long, ds_logical_time int, i_xattr_num_parts short"
)
APP_PROV = (
    "id string, state string, timestamp long, name string, user string, "
    "submit_time long, start_time long, finish_time long"
)
INODES = (
    "parent_id long, name string, partition_id long, id long, size long, user_id int, "
    "group_id int, logical_time int, is_dir boolean, num_user_xattrs byte, num_sys_xattrs byte"
)
USERS = "id int, name string"
GROUPS = "id int, name string"
PROJECTS = "id int, projectname string, username string, description string"
DATASETS = (
    "id int, inode_name string, projectId int, description string, "
    "public_ds boolean, searchable byte"
)
XATTRS = (
    "inode_id long, namespace byte, name string, `index` short, value string, num_parts short"
)
XATTR_BUFFER = (
    "inode_id long, namespace byte, name string, inode_logical_time int, "
    "`index` short, value string, num_parts short"
)

# Catalog tables: the columns the cascade rules read.
CATALOG = {
    "DBS": "DB_ID long, SD_ID long, NAME string, CTLG_NAME string",
    "TBLS": "TBL_ID long, DB_ID long, SD_ID long, TBL_NAME string, TBL_TYPE string",
    "PARTITIONS": "PART_ID long, SD_ID long, TBL_ID long, PART_NAME string",
    "IDXS": "INDEX_ID long, SD_ID long, ORIG_TBL_ID long, INDEX_TBL_ID long",
    "SDS": "SD_ID long, CD_ID long, SERDE_ID long, NAME string, PARENT_ID long, PARTITION_ID long",
    "CDS": "CD_ID long",
    "SERDES": "SERDE_ID long, SERDE_TYPE int, NAME string",
    "COLUMNS_V2": "CD_ID long, COLUMN_NAME string, TYPE_NAME string, INTEGER_IDX int",
    "SCHEMA_VERSION": (
        "SCHEMA_VERSION_ID long, SCHEMA_ID long, CD_ID long, SERDE_ID long, VERSION int"
    ),
    "I_SCHEMA": "SCHEMA_ID long, DB_ID long, NAME string",
    "SD_PARAMS": "SD_ID long, PARAM_KEY string, PARAM_VALUE string",
    "SERDE_PARAMS": "SERDE_ID long, PARAM_KEY string, PARAM_VALUE string",
    "TABLE_PARAMS": "TBL_ID long, PARAM_KEY string, PARAM_VALUE string",
    "TAB_COL_STATS": (
        "CS_ID long, TBL_ID long, COLUMN_NAME string, NUM_NULLS long, AVG_COL_LEN double"
    ),
    "PART_COL_STATS": "CS_ID long, PART_ID long, COLUMN_NAME string",
    "SKEWED_STRING_LIST": "STRING_LIST_ID long",
    "SKEWED_STRING_LIST_VALUES": (
        "STRING_LIST_ID long, INTEGER_IDX int, STRING_LIST_VALUE string"
    ),
    "SKEWED_VALUES": "SD_ID_OID long, INTEGER_IDX int, STRING_LIST_ID_EID long",
    "SKEWED_COL_VALUE_LOC_MAP": "SD_ID long, STRING_LIST_ID_KID long, LOCATION string",
}

LOGS = {
    "hdfs_metadata_log": FS_MUTATION,
    "ops_log": OPS_LOG,
    "hdfs_file_provenance_log": FILE_PROV,
    "yarn_app_provenance_log": APP_PROV,
}
# Tables watched for DELETE; their pre-image carries the keys.
DELETE_FEEDS = [
    "CDS",
    "DBS",
    "IDXS",
    "I_SCHEMA",
    "PARTITIONS",
    "SDS",
    "SERDES",
    "SKEWED_COL_VALUE_LOC_MAP",
    "SKEWED_VALUES",
    "TBLS",
]


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def change_event(ddl: str) -> T.StructType:
    """A change of a watched table: kind, row before, row after, commit epoch."""
    row = struct(ddl)
    return (
        T.StructType()
        .add("op", T.StringType())
        .add("commit_epoch", T.LongType())
        .add("pre", row)
        .add("post", row)
    )
