"""Column expressions several operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: ASCII white space, written as in the contracts of the queries.
SPACES = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def plain_key(key: str) -> Column:
    """A key as a string that is never null, so that nulls join like other keys."""
    return F.coalesce(F.concat(F.lit("a"), F.col(key).cast("string")), F.lit("b"))


def packed(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The named columns as one struct, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])


@cache
def _archive() -> str:
    """The library as one archive, for executors that do not have it."""
    package = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    return path


@cache
def _shipped(application: str, add: Callable[[str], None]) -> None:
    add(_archive())


# Rows of an Arrow batch: whole texts, several copies of which a worker holds.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Let Python workers import the library: Spark sends it to every executor."""
    context = spark.sparkContext
    _shipped(context.applicationId, context.addPyFile)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_KEPT: list = []


def kept(load: Callable) -> Callable:
    """`cache` for what a task leaves to the worker's next task of the same operator."""
    held = cache(load)
    _KEPT.append(held)
    return held


def let_go(own: str | None = None) -> None:
    """Drop what tasks of other operators left here, all but that of the function `own`."""
    for held in _KEPT:
        if held.__name__ != own:
            held.cache_clear()


def trim() -> None:
    """Give free memory back to the machine, where the allocators can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def arrow_map(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema,
    keeps: str | None = None,
) -> DataFrame:
    """`mapInArrow` with a function of this library, in batches of whole texts.

    `keeps` names the `kept` function whose result the operator's tasks share.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        yield from work(batches)
        # Workers live on; what the task needed goes back to the machine.
        trim()

    return df.mapInArrow(run, schema)
