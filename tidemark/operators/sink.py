"""Sinks: collections by index, quarantine, stored bulk responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_collections(docs: DataFrame, path: str) -> None:
    """Documents into one folder per collection.

    Rows are brought together by collection so that small ones get few files;
    the rebalance splits a large one over as many tasks as its size asks for.
    """
    docs.hint("rebalance", "index").write.mode("overwrite").partitionBy("index").parquet(path)


def split_problems(rows: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined ones; `fail_fast` fails on the first bad row."""
    if fail_fast:
        checked = F.when(
            F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast("boolean")
        ).otherwise(F.lit(True))
        return rows.filter(checked).drop("problem"), rows.limit(0)
    good = rows.filter(F.col("problem").isNull()).drop("problem")
    return good, rows.filter(F.col("problem").isNotNull())


# Fixed value: the sink's answer while it is still starting up.
NOT_READY = "Open Distro Security not initialized."
RESPONSE = (
    "errors boolean, error string, "
    "items array<map<string, struct<_id string, status int, error string>>>"
)


def _error_text(error):
    """`type:reason` of an error object, or the text of a plain one."""
    kind = F.get_json_object(error, "$.type")
    reason = F.get_json_object(error, "$.reason")
    return F.when(kind.isNotNull(), F.concat(kind, F.lit(":"), reason)).otherwise(error)


def parse_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """Outcome of every stored bulk response.

    Successful when it parses and reports no error; retryable while the sink
    is not ready; otherwise `item_errors` lists what failed.
    """
    parsed = responses.withColumn("_r", F.from_json(F.col(column), RESPONSE)).withColumn(
        "_valid", F.try_parse_json(F.col(column)).isNotNull()
    )
    failed_items = F.flatten(
        F.transform(
            F.coalesce(F.col("_r.items"), F.array()),
            lambda item: F.filter(
                F.map_values(item), lambda outcome: outcome["error"].isNotNull()
            ),
        )
    )
    errors = F.when(
        F.col("_r.errors"), F.transform(failed_items, lambda o: _error_text(o["error"]))
    ).when(F.col("_r.errors").isNull() & F.col("_r.error").isNotNull(), F.array(_error_text(F.col("_r.error"))))
    retryable = F.col(column) == NOT_READY
    reports = F.coalesce(F.col("_r.errors"), F.col("_r.errors").isNull() & F.col("_r.error").isNotNull())
    return parsed.select(
        *responses.columns,
        (F.col("_valid") & ~reports & ~retryable).alias("success"),
        retryable.alias("retryable"),
        F.coalesce(errors, F.array().cast("array<string>")).alias("item_errors"),
    )


def error_counts(parsed: DataFrame) -> DataFrame:
    """Number of failed items per error text."""
    return (
        parsed.select(F.explode("item_errors").alias("error"))
        .groupBy("error")
        .agg(F.count(F.lit(1)).alias("n"))
    )
