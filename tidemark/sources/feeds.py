"""Readers: change feeds (batch and stream), table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import char_text, latin1_text
from tidemark.sources import schemas

CHANGE_KINDS = ["INSERT", "DELETE", "UPDATE"]


def read_changes(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A stored change feed as a batch DataFrame."""
    return spark.read.format(fmt).schema(schemas.change_event(ddl)).load(path)


def stream_changes(
    spark: SparkSession,
    path: str,
    ddl: str,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """The same feed as a stream; `max_files` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schemas.change_event(ddl))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str, ddl: str) -> DataFrame:
    """S1 over a broker topic holding one JSON change event per message."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    event = F.from_json(F.col("value").cast("string"), schemas.change_event(ddl))
    return raw.select(event.alias("e")).select("e.*")


def subscribe(
    changes: DataFrame, kinds: list[str], columns: list[str], image: str = "post"
) -> DataFrame:
    """The watched kinds of change, chosen columns of one image.

    Kinds that are not row changes are dropped. Works on batch and stream.
    """
    watched = [k for k in kinds if k in CHANGE_KINDS]
    return changes.filter(F.col("op").isin(*watched)).select(
        "op", "commit_epoch", *[F.col(f"{image}.{c}").alias(c) for c in columns]
    )


def log_rows(changes: DataFrame, log: str) -> DataFrame:
    """Inserted rows of one of the four logs."""
    columns = schemas.struct(schemas.LOGS[log]).names
    return subscribe(changes, ["INSERT"], columns).drop("op")


def deleted_rows(changes: DataFrame, table: str) -> DataFrame:
    """Rows of a catalog table as they were before their deletion."""
    columns = schemas.struct(schemas.CATALOG[table]).names
    return subscribe(changes, ["DELETE"], columns, image="pre").drop("op")


def scan(spark: SparkSession, path: str, ddl: str | None = None, columns=None) -> DataFrame:
    """A whole table, only the named columns."""
    reader = spark.read if ddl is None else spark.read.schema(schemas.struct(ddl))
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def scan_ordered(df: DataFrame, index: list[str]) -> DataFrame:
    """A scan in index order (range partitioned, then sorted)."""
    return df.orderBy(*index)


def searchable_datasets(datasets: DataFrame) -> DataFrame:
    """The one filter the scans push down."""
    return datasets.filter(F.col("searchable") == 1)


def log_snapshot(log: DataFrame, key: list[str]) -> DataFrame:
    """A log in epoch order, key order inside an epoch."""
    return log.orderBy("commit_epoch", *key)


def normalise(df: DataFrame, char_columns=(), latin1_columns=()) -> DataFrame:
    """Decode single-byte columns and trim fixed-width ones on read."""
    decoded = {c: latin1_text(F.col(c)) for c in latin1_columns}
    df = df.withColumns(decoded) if decoded else df
    trimmed = {c: char_text(F.col(c)) for c in char_columns}
    return df.withColumns(trimmed) if trimmed else df
