"""Small tables with the cases every operator must handle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; as columns of an input they must not matter.
CLASHING = [
    "_row", "_key", "_id", "_run", "_digest", "_proof", "_doc", "_text", "_hash", "_n", "_norm", "_held",
    "_source", "_cell", "_score", "_label", "_spot", "node", "token", "label", "size", "target", "taken",
    "kept", "quality", "score", "shard", "block", "ids", "n_tokens", "repeats", "component", "value",
]

WORDS = "the of and to in is it with by for on as at this that are was were".split()


def prose(seed: int, n: int) -> str:
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[state % len(WORDS)] + str(state // 7 % 997) if state % 3 else WORDS[state % len(WORDS)])
    return " ".join(out)


def documents() -> list[tuple]:
    near = prose(1, 60).split()
    changed = [*near[:30], "other", *near[31:]]
    rows = [
        (1, prose(1, 60)),
        (2, prose(2, 80)),
        (3, prose(1, 60).replace(" ", "  \n", 3)),
        (4, " ".join(changed)),
        (5, None),
        (6, ""),
        (7, "word"),
        (8, " \t\n"),
        (9, prose(3, 20_000)),
        (10, "MIT License. Licensed under the Apache License, Version 2.0; CC-BY 4.0"),
        (11, "¿Qué? naïve 漢字 😀 l'été it's WE'LL  don't\r\n x ½ ١٢"),
        (12, "word"),
        (12, "word"),
        (12, "another text of this id"),
        (None, "no id here"),
        (None, None),
        (13, "x" * 5000),
        (14, "same same same same same same same same same"),
        (15, prose(2, 80)),
    ]
    return [
        (i, t, "en", None if n % 5 == 4 else f"src{n % 3}", None if t is None else len(t))
        for n, (i, t) in enumerate(rows)
    ]


def frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def clashing(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def same_with_other_columns(operator, df: DataFrame) -> None:
    """The operator's rows do not depend on columns it does not read."""
    plain, extra = operator(df), operator(clashing(df))
    assert plain.columns == extra.columns
    key = lambda r: repr(r)
    assert sorted(map(tuple, plain.collect()), key=key) == sorted(map(tuple, extra.collect()), key=key)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
