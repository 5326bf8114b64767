"""Value decoding and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.codes import STORE_MODES


def latin1_text(raw: Column) -> Column:
    """A single-byte encoded string as text."""
    return F.decode(raw, "ISO-8859-1")


def char_text(value: Column) -> Column:
    """A fixed-width string without its padding; all blanks stay."""
    trimmed = F.rtrim(value)
    return F.when(trimmed == "", value).otherwise(trimmed)


def _wrap(value: Column, bits: int) -> Column:
    half = 1 << (bits - 1)
    return (value + F.lit(half)).bitwiseAND(F.lit((1 << bits) - 1)) - F.lit(half)


def num_parts(pk1: Column) -> Column:
    """part count kept in the first overloaded column (low 16 bits)."""
    return _wrap(pk1, 16).cast("short")


def namespace(pk2: Column) -> Column:
    """xattr namespace kept in the second overloaded column (low 8 bits)."""
    return _wrap(pk2, 8).cast("byte")


def readable_time(millis: Column) -> Column:
    """`2019.Aug.5 9:25:15` in UTC."""
    return F.date_format(F.timestamp_millis(millis), "yyyy.MMM.d H:m:s")


def is_json(value: Column) -> Column:
    """F16: the text parses as JSON."""
    return F.try_parse_json(value).isNotNull()


def json_or_text(value: Column) -> Column:
    """F16: the parsed value when the text is JSON, else the text itself."""
    text = F.variant_get(F.parse_json(F.to_json(F.array(value))), "$[0]", "variant")
    return F.coalesce(F.try_parse_json(value), text)


def store_mode(value: Column) -> Column:
    """struct(mode, project_iid) of a store-mode value, null when malformed."""
    doc = F.try_parse_json(value)
    mode = F.upper(F.try_variant_get(doc, "$.prov_type.prov_status", "string"))
    project = F.try_variant_get(doc, "$.project_iid", "long")
    return F.when(
        mode.isin(*STORE_MODES) & project.isNotNull(),
        F.struct(mode.alias("mode"), project.alias("project_iid")),
    )


def store_mode_strict(value: Column) -> Column:
    """F10 fail-fast: an unreadable store mode fails the job."""
    parsed = store_mode(value)
    problem = F.raise_error(F.concat(F.lit("store mode not recognized:"), value))
    return F.when(value.isNotNull() & parsed.isNull(), problem).otherwise(parsed)
