"""Session settings and the one place where intermediate tables are written."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from tidemark.streaming.files import Files

SETTINGS = {
    # Timestamps are rendered and bucketed in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sizes are those of compressed files and shuffles; ids and clocks shrink twentyfold
    # there, so a task of Spark's default sizes sorts gigabytes.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(cores: int | str = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a given session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's checkpoint folder.

    A temporary folder is used only on a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return root.rstrip("/")


# Folders of the tables that `materialize` wrote, for `discard`.
_WRITTEN: WeakKeyDictionary[DataFrame, tuple[str, str]] = WeakKeyDictionary()


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written files.

    Cuts lineage in loops and pins values (row positions, partition numbers)
    that must not change when an executor is lost and its tasks run again.
    """
    spark = df.sparkSession
    root, name = shared_root(spark), f"{label}-{uuid.uuid4().hex}"
    path = f"{root}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[table] = root, name
    return table


def discard(*tables: DataFrame) -> None:
    """Remove the folders of written tables that nothing reads any more.

    Takes what `materialize` returned; other tables are left alone. What was
    made from them must be written by now.
    """
    for table in tables:
        if table in _WRITTEN:
            root, name = _WRITTEN.pop(table)
            Files(table.sparkSession, root).remove(name)
    if tables:
        collect_shuffles(tables[0].sparkSession)


def collect_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files removed that no plan refers to any more.

    Spark does so once the driver's collector finds such a plan, which on an
    idle driver may take half an hour; it is asked to look now.
    """
    spark._jvm.System.gc()
