"""Asset classification of a provenance row from its path columns.

A row is classified in two steps: the dataset it lies in decides the family,
its place below the dataset decides whether it is the asset or a part of one.
The family tests exclude each other because each fixes the dataset name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that mark datasets, folders and files.
README = "README.md"
FEATURE_SUFFIX = "_featurestore.db"
TRAINING_SUFFIX = "_Training_Datasets"
HIVE_SUFFIX = ".db"
EXPERIMENT_DATASET = "Experiments"
MODEL_DATASET = "Models"
FEATURE_RESOURCE_FOLDERS = ["code", "storage_connector_resources"]
TRAINING_RESOURCE_FOLDERS = ["code", "transformation_functions"]
FEATURE_VIEW_FOLDER = ".featureviews"
EXPERIMENT_PREFIX = "application_"
EXPERIMENT_PIECES = 4


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def is_dataset() -> Column:
    """the row is the dataset itself."""
    return F.col("dataset_i_id") == F.col("inode_id")


def is_readme() -> Column:
    """F7."""
    return F.col("i_name") == README


def one_level_deep() -> Column:
    """Directly below the dataset."""
    return ~is_dataset() & (F.col("dataset_i_id") == F.col("parent_i_id"))


def one_plus_levels_deep() -> Column:
    """Below the dataset, but not directly."""
    return ~is_dataset() & (F.col("dataset_i_id") != F.col("parent_i_id"))


def two_levels_deep() -> Column:
    """Exactly two levels below."""
    return one_plus_levels_deep() & (_text("i_p1_name") != "") & (_text("i_p2_name") == "")


def two_plus_levels_deep() -> Column:
    """More than two levels below."""
    return one_plus_levels_deep() & (_text("i_p1_name") != "") & (_text("i_p2_name") != "")


def is_experiment_name(name: Column) -> Column:
    """the prefix and exactly four underscore-separated pieces."""
    return name.startswith(EXPERIMENT_PREFIX) & (F.size(F.split(name, "_")) == EXPERIMENT_PIECES)


def in_hive_store() -> Column:
    """Rows without a project id come from the table store."""
    return F.col("project_i_id") == -1


def family() -> Column:
    """The kind of dataset the row lies in, null for any other dataset."""
    dataset, project, p1 = F.col("dataset_name"), F.col("project_name"), _text("i_p1_name")
    feature = (
        in_hive_store()
        & (dataset == F.concat(F.lower(project), F.lit(FEATURE_SUFFIX)))
        & ~p1.isin(*FEATURE_RESOURCE_FOLDERS)
    )
    training = (dataset == F.concat(project, F.lit(TRAINING_SUFFIX))) & ~p1.isin(
        *TRAINING_RESOURCE_FOLDERS, FEATURE_VIEW_FOLDER
    )
    hive = in_hive_store() & (dataset == F.concat(project, F.lit(HIVE_SUFFIX)))
    return (
        F.when(feature, "FEATURE")
        .when(training, "TRAINING_DATASET")
        .when(dataset == EXPERIMENT_DATASET, "EXPERIMENT")
        .when(dataset == MODEL_DATASET, "MODEL")
        .when(hive, "HIVE")
    )


def asset_type(family_col: Column) -> Column:
    """the type name, given the family of the row."""
    is_asset = (
        F.when(family_col.isin("FEATURE", "TRAINING_DATASET"), one_level_deep())
        .when(family_col == "EXPERIMENT", one_level_deep() & is_experiment_name(F.col("i_name")))
        .when(family_col == "MODEL", two_levels_deep())
        .when(family_col == "HIVE", F.col("dataset_i_id") == F.col("parent_i_id"))
    )
    is_part = (
        F.when(family_col.isin("FEATURE", "TRAINING_DATASET"), one_plus_levels_deep())
        .when(
            family_col == "EXPERIMENT",
            one_plus_levels_deep() & is_experiment_name(_text("i_parent_name")),
        )
        .when(family_col == "MODEL", two_plus_levels_deep())
        .when(family_col == "HIVE", F.col("dataset_i_id") != F.col("parent_i_id"))
    )
    return (
        F.when(is_readme(), "NONE")
        .when(is_asset, family_col)
        .when(is_dataset(), "DATASET")
        .when(is_part, F.concat(family_col, F.lit("_PART")))
        .otherwise("NONE")
    )


def asset_id(type_col: Column) -> Column:
    """F8: the name an asset or part is filed under, empty when it has none."""
    parent, p1, p2 = _text("i_parent_name"), _text("i_p1_name"), _text("i_p2_name")
    owner = F.when(p1 == "", parent).otherwise(p1)
    return (
        F.when(type_col.isin("FEATURE", "TRAINING_DATASET", "EXPERIMENT"), F.col("i_name"))
        .when(type_col == "MODEL", F.concat_ws("_", parent, F.col("i_name")))
        .when(type_col.isin("FEATURE_PART", "TRAINING_DATASET_PART", "EXPERIMENT_PART"), owner)
        .when(
            type_col == "MODEL_PART",
            F.concat_ws("_", p1, F.when(p2 == "", parent).otherwise(p2)),
        )
        .otherwise("")
    )


def with_asset(rows: DataFrame) -> DataFrame:
    """Add `ml_type` and `ml_id` to provenance rows."""
    return (
        rows.withColumn("_family", family())
        .withColumn("ml_type", asset_type(F.col("_family")))
        .withColumn("ml_id", asset_id(F.col("ml_type")))
        .drop("_family")
    )
