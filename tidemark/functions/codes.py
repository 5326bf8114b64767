"""Closed code domains and their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes and names of the three logs, asset types,
# store modes, document types. They must equal those in stored data.
FS_OPS = {
    0: "Add",
    1: "Delete",
    2: "Update",
    3: "Rename",
    4: "ChangeDataset",
    10: "XAttrAdd",
    11: "XAttrAddAll",
    12: "XAttrUpdate",
    13: "XAttrDelete",
}
FS_ADD, FS_DELETE, FS_UPDATE, FS_RENAME, FS_CHANGE_DATASET = 0, 1, 2, 3, 4
XATTR_ADD, XATTR_ADD_ALL, XATTR_UPDATE, XATTR_DELETE = 10, 11, 12, 13

ADMIN_OPS = {0: "Add", 1: "Delete", 2: "Update"}
ADMIN_TARGETS = {0: "Dataset", 1: "Project"}
# The stored spelling of the name for a code outside the domain.
UNKNOWN_NAME = "Unkown"

PROVENANCE_OPS = [
    "CREATE",
    "DELETE",
    "ACCESS_DATA",
    "MODIFY_DATA",
    "XATTR_ADD",
    "XATTR_UPDATE",
    "XATTR_DELETE",
    "METADATA",
    "OTHER",
]
STORE_MODES = ["NONE", "STATE", "ALL"]
ASSET_TYPES = ["DATASET", "HIVE", "FEATURE", "TRAINING_DATASET", "EXPERIMENT", "MODEL"]
PART_TYPES = ["HIVE_PART", "FEATURE_PART", "TRAINING_DATASET_PART", "EXPERIMENT_PART", "MODEL_PART"]

USER_NAMESPACE = 5
CORE_XATTR = "core"
PROJECT_ID_XATTR = "project_iid"

DOC_DATASET, DOC_PROJECT, DOC_INODE = "ds", "proj", "inode"
MISSING_ID = -1
MISSING_NAME = "-1"
APP_RUNNING, APP_SUBMITTED = "RUNNING", "SUBMITTED"


def _names(code: Column, names: dict[int, str]) -> Column:
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(UNKNOWN_NAME))


def fs_op_name(code: Column) -> Column:
    """name of a file-mutation code."""
    return _names(code, FS_OPS)


def admin_op_name(code: Column) -> Column:
    """name of an admin operation type."""
    return _names(code, ADMIN_OPS)


def admin_target_name(code: Column) -> Column:
    """name of the object an admin operation is on."""
    return _names(code, ADMIN_TARGETS)


def is_inode_op(code: Column) -> Column:
    """P1."""
    return code.isin(FS_ADD, FS_DELETE, FS_UPDATE, FS_RENAME, FS_CHANGE_DATASET)


def needs_inode(code: Column) -> Column:
    """The operations that read the current inode row."""
    return code.isin(FS_ADD, FS_UPDATE, FS_RENAME)


def is_xattr_op(code: Column) -> Column:
    """P2."""
    return code.isin(XATTR_ADD, XATTR_ADD_ALL, XATTR_UPDATE, XATTR_DELETE)


def needs_xattr(code: Column) -> Column:
    """The operations that read the current xattr value."""
    return code.isin(XATTR_ADD, XATTR_ADD_ALL, XATTR_UPDATE)


def is_known_provenance_op(name: Column) -> Column:
    """F11 as a test, for quarantine."""
    return F.coalesce(name.isin(*PROVENANCE_OPS), F.lit(False))


def provenance_op(name: Column) -> Column:
    """F11 fail-fast: the operation name, or an error for an unknown one."""
    unknown = F.raise_error(F.concat(F.lit("no such operation:"), F.coalesce(name, F.lit("null"))))
    return F.when(is_known_provenance_op(name), name).otherwise(unknown.cast("string"))


def has_xattrs(user_count: Column, system_count: Column) -> Column:
    """P3."""
    return (user_count > 0) | (system_count > 0)
