"""Key strings, document ids and collection names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.codes import DOC_DATASET, DOC_INODE

# Collection names.
PROJECTS_INDEX = "projects"
APP_INDEX = "appprovenance"
PROJECT_INDEX_SUFFIX = "__file_prov"

# Primary keys of the logs; these are also the dedup keys.
MUTATION_KEY = ["dataset_id", "inode_id", "logical_time"]
ADMIN_KEY = ["id"]
PROVENANCE_KEY = [
    "inode_id",
    "inode_operation",
    "io_logical_time",
    "io_timestamp",
    "io_app_id",
    "io_user_id",
    "tb",
]
APP_KEY = ["id", "state", "timestamp"]


def key_string(columns: list[str]) -> Column:
    """The key columns joined with dashes."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def operation_doc_id() -> Column:
    """id of an operation document; the tie breaker is not part of it."""
    return key_string(PROVENANCE_KEY[:-1])




def state_doc_id() -> Column:
    """id of a state document."""
    return F.col("inode_id").cast("string")


def app_doc_id(app: Column, state: Column, millis: Column) -> Column:
    """id of an application state document."""
    return F.concat_ws("-", app, state, millis.cast("string"))


def xattr_key(inode: Column, namespace: Column, name: Column) -> Column:
    """unique id of an xattr."""
    return F.concat_ws("-", inode.cast("string"), namespace.cast("string"), name)


def doc_type(inode: Column, dataset: Column) -> Column:
    """F17."""
    return F.when(inode == dataset, DOC_DATASET).otherwise(DOC_INODE)


def project_index(project_inode: Column) -> Column:
    """F18."""
    return F.concat(project_inode.cast("string"), F.lit(PROJECT_INDEX_SUFFIX))
