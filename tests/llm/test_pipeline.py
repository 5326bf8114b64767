import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_jaccard import brute
from tidemark.llm.mixing import mix
from tidemark.session import materialize

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rows = []
    for i in range(150):
        text = cases.prose(i, 40 + i % 50)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 5 == 0 else text, "en", f"s{i % 4}", len(text)))
    for i in range(20):
        words = rows[i * 5 + 1][1].split()
        rows.append((200 + i, rows[i * 5 + 2][1].replace(" ", "\n", 2), "en", "s0", 0))
        rows.append((300 + i, " ".join([*words[:20], "changed", *words[21:]]), "en", "s1", 0))
    return rows + [(400, None, None, None, None), (401, "", None, None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data"))
    cases.frame(spark, corpus()).write.parquet(f"{path}/documents.parquet")
    marks = [(r[0], int(r[0] % 5 != 0), 0) for r in corpus() if r[0] < 150]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), "stage")
        results.append(docs)
    quality, exact, near, mixture, tokens = results
    assert all(d.columns == DOCUMENTS for d in results[:-1])

    good = {r.doc_id for r in quality.collect()}
    assert {r[0] for r in corpus() if r[0] < 150 and r[0] % 5} <= good
    assert not good & {r[0] for r in corpus() if r[0] < 150 and not r[0] % 5}

    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for r in quality.collect():
        first[norm(r.text)] = min(first.get(norm(r.text), r.doc_id), r.doc_id)
    assert Counter(r.doc_id for r in exact.collect()) == Counter(first.values())

    groups = brute([tuple(r) for r in exact.collect()], corpus_pipeline.SHINGLE, corpus_pipeline.SIMILAR)
    assert Counter(r.doc_id for r in near.collect()) == Counter({c for _, _, c in groups})
    assert near.count() < exact.count() < quality.count()

    times = Counter({r.doc_id: r.repeats for r in mix(near, labels).collect() if r.repeats})
    assert Counter(r.doc_id for r in mixture.collect()) == times
    assert Counter(r.doc_id for r in tokens.collect()) == times
    assert all(len(r.ids) == r.n_tokens for r in tokens.collect())


def test_run(spark, folder):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, folder).drop("ids").collect())) for _ in range(2))
    assert a == b and a


def test_empty_tables(spark, tmp_path):
    cases.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
