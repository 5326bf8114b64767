import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import cases
from tidemark.llm.fingerprints import KMER, fingerprints, kmers, numbered, order_fingerprints, pieces, repeated


def chain(spark, rows):
    """Distinct documents in the order of the operator."""
    hashes = {r.t: r.h for r in spark.createDataFrame([(r[1] or "",) for r in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    distinct = {(r[0], r[1] or "") for r in rows}
    return sorted(distinct, key=lambda d: (d[0] is None, -(d[0] or 0), -hashes[d[1]]))


def test_edited_texts(spark):
    rows = cases.documents()
    order = chain(spark, rows)
    times = Counter((r[0], r[1] or "") for r in rows)
    expected = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        lent = len(text) // 3
        new = text[: len(text) - lent] + after[:lent]
        expected[(i, len(text), hashlib.sha256(new.encode()).hexdigest())] += times[i, text]
    assert sum(expected.values()) == len(rows) > len(order)
    got = order_fingerprints(cases.frame(spark)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected


def test_equal_texts_and_likeness(spark):
    got = order_fingerprints(cases.frame(spark)).collect()
    by_text = {}
    texts = {(r[0], r[1] or "") for r in cases.documents()}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        candidates = [t for i, t in texts if i == r.doc_id and len(t) == r.n_chars]
        if len(candidates) == 1:
            by_text.setdefault(candidates[0], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    long = next(r for r in got if r.doc_id == 9)
    assert long.near_edited > long.near_next


def test_likeness_against_sketches_of_the_texts(spark):
    rows = [r for r in cases.documents() if r[0] is not None]
    order = chain(spark, rows)
    texts = []
    for (_, text), (_, after) in zip(order, order[1:] + order[:1]):
        lent = len(text) // 3
        texts.append((len(texts), text))
        texts.append((len(texts), text[: len(text) - lent] + after[:lent]))
    df = spark.createDataFrame(texts, "i long, t string")
    sketch = {r.i: r.sketch for r in fingerprints(df, ["i"], "t").collect()}

    def share(a, b):
        return sum(x == y for x, y in zip(sketch[a], sketch[b])) / len(sketch[a])

    expected = Counter()
    times = Counter((r[0], r[1] or "") for r in rows)
    for at, document in enumerate(order):
        after = 2 * ((at + 1) % len(order))
        near = share(2 * at, 2 * at + 1), share(2 * at, after)
        expected[(document[0], len(document[1]), *near)] += times[document]
    got = order_fingerprints(cases.frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars, r.near_edited, r.near_next) for r in got) == expected


def test_rows_repeated_many_times(spark):
    df = spark.createDataFrame([("a", 1), ("b", 4096), ("c", 9001)], "k string, n long")
    assert {r.k: r["count"] for r in repeated(df, "n").groupBy("k").count().collect()} == {"a": 1, "b": 4096, "c": 9001}


def test_numbering_against_brute_force(spark):
    texts = ["a b a b a b a b a", "x y z", "one", "", "r " * 50 + "s r r r", cases.prose(5, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    parts = df.select("i", pieces(F.col("t")).alias("p"))
    rows = parts.select("i", kmers(F.col("p")).alias("h")).select("i", "h", numbered(F.col("h")).alias("n"))
    for r in rows.collect():
        words = [w[j : j + 8] for w in texts[r.i].split() for j in range(0, len(w), 8)]
        assert len(r.h) == (max(len(words) - KMER + 1, 1) if words else 0)
        seen, first = Counter(), {}
        by_place = {x["place"]: x["value"] for x in r.n}
        assert sorted(by_place) == list(range(len(r.h)))
        for place, h in enumerate(r.h):
            value = first.setdefault((h, seen[h]), by_place[place])
            assert value == by_place[place]
            if not seen[h]:
                assert value == h
            seen[h] += 1
        assert len(set(by_place.values())) == len(by_place)


def test_minima_against_brute_force(spark):
    text = cases.prose(8, 120) + " a b a b a b a b"
    df = spark.createDataFrame([(1, text)], "i long, t string")
    sketch = fingerprints(df, ["i"], "t", sketches=4).first().sketch
    rows = df.select(F.explode(numbered(kmers(pieces(F.col("t"))))).alias("k")).select("k.value", "k.place")
    for s in range(4):
        hashed = rows.withColumn("h", F.xxhash64("value", F.lit(s)).bitwiseAND(F.lit(-(1 << 24)))).collect()
        pick = [min((r.h + min(r.place, (1 << 24) - 1), r.place) for r in hashed if r.value % 2 == odd) for odd in (0, 1)]
        pair = [p[0] >> 24 for p in sorted(pick, key=lambda p: p[1])]
        want = spark.range(1).select(F.xxhash64(F.lit(pair[0]).cast("long"), F.lit(pair[1]).cast("long"))).first()[0]
        assert sketch[s] == want


def test_order_matters(spark):
    words = cases.prose(4, 200).split()
    rows = [(1, " ".join(words)), (2, " ".join(words[100:] + words[:100])), (3, " ".join(words[:190]))]
    df = spark.createDataFrame(rows, "i long, t string")
    got = {r.i: r.sketch for r in fingerprints(df, ["i"], "t", sketches=64).collect()}
    same = lambda a, b: sum(x == y for x, y in zip(got[a], got[b]))
    assert same(1, 3) > same(1, 2)


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(order_fingerprints, cases.frame(spark))
    assert order_fingerprints(cases.empty(spark)).collect() == []
    one = cases.frame(spark, [(1, "only one document", "en", "s", 0)])
    assert order_fingerprints(one).count() == 1
