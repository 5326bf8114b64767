import pytest

from tidemark.functions.classify import with_asset

COLUMNS = (
    "inode_id long, dataset_i_id long, parent_i_id long, project_i_id long, project_name string, "
    "dataset_name string, i_name string, i_p1_name string, i_p2_name string, i_parent_name string"
)
# name, (inode, dataset, parent, project id), dataset name, inode name, p1, p2, parent name
CASES = [
    ("NONE", "", (2, 1, 1, 5), "Models", "README.md", "", "", ""),
    ("FEATURE", "f", (2, 1, 1, -1), "proj_featurestore.db", "f", "", "", ""),
    ("NONE", "", (2, 1, 1, -1), "proj_featurestore.db", "f", "code", "", ""),
    ("NONE", "", (2, 1, 1, 5), "proj_featurestore.db", "f", "", "", ""),
    ("FEATURE_PART", "p1", (3, 1, 2, -1), "proj_featurestore.db", "x", "p1", "", "par"),
    ("FEATURE_PART", "par", (3, 1, 2, -1), "proj_featurestore.db", "x", "", "", "par"),
    ("TRAINING_DATASET", "t", (2, 1, 1, 5), "Proj_Training_Datasets", "t", "", "", ""),
    ("NONE", "", (2, 1, 1, 5), "Proj_Training_Datasets", "t", ".featureviews", "", ""),
    ("NONE", "", (2, 1, 1, 5), "Proj_Training_Datasets", "t", "transformation_functions", "", ""),
    ("TRAINING_DATASET_PART", "td", (3, 1, 2, 5), "Proj_Training_Datasets", "x", "td", "", "par"),
    ("EXPERIMENT", "application_1_2_3", (2, 1, 1, 5), "Experiments", "application_1_2_3", "", "", ""),
    ("NONE", "", (2, 1, 1, 5), "Experiments", "application_1_2", "", "", ""),
    ("NONE", "", (2, 1, 1, 5), "Experiments", "application_1_2_3_4", "", "", ""),
    ("EXPERIMENT_PART", "e", (3, 1, 2, 5), "Experiments", "x", "e", "", "application_1_2_3"),
    ("NONE", "", (3, 1, 2, 5), "Experiments", "x", "e", "", "other_1_2_3"),
    ("MODEL", "par_1", (3, 1, 2, 5), "Models", "1", "m", "", "par"),
    ("MODEL_PART", "m_1", (4, 1, 3, 5), "Models", "x", "m", "1", "par"),
    ("HIVE", "", (2, 1, 1, -1), "Proj.db", "t", "", "", ""),
    ("HIVE_PART", "", (3, 1, 2, -1), "Proj.db", "t", "", "", ""),
    ("DATASET", "", (1, 1, 0, 5), "Logs", "Logs", "", "", ""),
    ("DATASET", "", (1, 1, 0, 5), "Models", "Models", "", "", ""),
    ("NONE", "", (2, 1, 1, 5), "Logs", "x", "", "", ""),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: f"{c[0]}-{c[3]}-{c[4]}")
def test_classes(spark, case):
    kind, asset_id, (inode, dataset, parent, project), name, inode_name, p1, p2, parent_name = case
    row = (inode, dataset, parent, project, "Proj", name, inode_name, p1, p2, parent_name)
    got = with_asset(spark.createDataFrame([row], COLUMNS)).first()
    assert (got["ml_type"], got["ml_id"]) == (kind, asset_id)
