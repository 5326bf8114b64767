import zlib

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm.quality import ROWS, features, fit, good, scored, tokens, word_vectors


def corpus(n=240):
    """Plain prose and shouted or broken lines, labelled in turn."""
    rows, marks = [], []
    for i in range(n):
        text = cases.prose(i, 40 + i % 50)
        poor = i % 3 == 0
        text = text.upper().replace(" ", "!! ") if poor and i % 2 else text.replace(" ", " | ") if poor else text
        rows.append((i, text, "en", "s", 0))
        marks.append((i, 0 if poor else 1, 0))
    return rows, marks


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_scored_well(spark):
    rows, marks = corpus()
    got = scored(cases.frame(spark, rows), labels(spark, marks)).collect()
    truth = {m[0]: m[1] for m in marks}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert len(held) > 30
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_change_nothing(spark):
    rows, marks = corpus(120)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in marks]
    a = scored(cases.frame(spark, rows), labels(spark, marks)).collect()
    b = scored(cases.frame(spark, rows), labels(spark, flipped)).collect()
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}


def test_cases_and_other_columns(spark):
    rows, marks = corpus(90)
    rows = cases.documents() + [(1000 + r[0], *r[1:]) for r in rows]
    marks = [(1000 + m[0], *m[1:]) for m in marks] + [(1, None, 0), (None, 1, 0), (9, 1, 0), (9, 0, 0)]
    marked = labels(spark, marks)
    df = cases.frame(spark, rows)
    cases.same_with_other_columns(lambda d: scored(d, marked), df)
    got = scored(df, marked).collect()
    assert len(got) == len(rows)
    by_text = {}
    texts = {r[0]: r[1] for r in rows if r[0] not in (None, 12)}
    for r in got:
        if r.doc_id in texts:
            by_text.setdefault(texts[r.doc_id] or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())
    kept = good(cases.clashing(df), marked)
    assert kept.columns == cases.clashing(df).columns
    assert kept.count() == sum(r.predicted for r in got)


def test_sample_is_bounded(spark):
    rows, marks = corpus(240)
    got = scored(cases.frame(spark, rows), labels(spark, marks), sample=60).collect()
    assert len(got) == 240


def test_without_labels_and_empty_tables(spark):
    none = labels(spark, [])
    assert {r.score for r in scored(cases.frame(spark), none).collect()} == {0.5}
    assert scored(cases.empty(spark), none).collect() == []
    assert good(cases.empty(spark), none).collect() == []


def test_vectors_do_not_depend_on_partitions(spark):
    df = cases.frame(spark)
    assert (word_vectors(df.repartition(1)) == word_vectors(df.repartition(5))).all()
    assert word_vectors(df).shape[0] == ROWS


def test_tokens():
    hashes, shape, offsets = tokens([b"The cat, THE cat!!", b"", b"a 12"])
    assert np.diff(offsets).tolist() == [6, 0, 2]
    assert hashes[0] == hashes[3] and shape[0] != shape[3] and hashes[1] == hashes[4]


def test_pooling_against_plain_means():
    vectors = np.random.default_rng(0).normal(size=(ROWS, 32)).astype(np.float32)
    texts = ["the cat sat", "", "x", cases.prose(1, 500)]
    together = features(texts, vectors)
    apart = np.vstack([features([t], vectors) for t in texts])
    assert np.allclose(together, apart)
    assert not together[1].any()


def test_network_learns_and_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=800)) > 0.5).astype(float)
    net = fit(x[:600], y[:600], np.arange(600) % 5 == 0)
    p = net.scores(x[600:])
    assert ((p > 0.5) == y[600:]).mean() > 0.8
    assert abs(p.mean() - y[600:].mean()) < 0.15
    with pytest.raises(Exception):
        net.scores(np.zeros((1, 4)))
