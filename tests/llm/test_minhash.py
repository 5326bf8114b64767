from collections import Counter

import numpy as np
import pytest

from tests.llm import cases
from tests.llm.test_jaccard import brute, near_copies, shingles
from tidemark.llm import components, minhash
from tidemark.llm.arrays import shingle_sets
from tidemark.llm.minhash import band_keys, least_agreement, minhash_components, minima


def expected(rows, k=3, similar=85):
    return Counter({(i, n, c, i == c): m for (i, n, c), m in brute(rows, k, similar).items()})


def result(df, **options):
    got = minhash_components(df, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return Counter(map(tuple, got.collect()))


def test_cases_against_brute_force(spark):
    rows = cases.documents()
    assert result(cases.frame(spark, rows)) == expected(rows)


@pytest.mark.parametrize("small,block", [(8, 1024), (2, 7)])
def test_groups_of_near_copies(spark, monkeypatch, small, block):
    # One group of many near copies in large buckets, some of them at the border.
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_copies(90, 80, 6) + [(500 + i, r[1], *r[2:]) for i, r in enumerate(near_copies(20, 60, 1, seed=7))]
    want = expected(rows)
    assert len({c for _, _, c, _ in want}) < len(rows) - 40
    assert result(cases.frame(spark, rows)) == want


def test_unlinked_members_of_a_large_bucket(spark, monkeypatch):
    # One row a band: buckets hold many texts that share a passage and are not similar.
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "PICKY_ROUNDS", 1)
    shared = cases.prose(1, 40)
    rows = [(i, f"{shared} {cases.prose(i + 2, 9)}", "en", "s", 0) for i in range(30)]
    rows += [(100 + i, f"{shared} {cases.prose(i + 2, 8)}", "en", "s", 0) for i in range(0, 30, 4)]
    assert result(cases.frame(spark, rows), similar=90, bands=30, rows=1) == expected(rows, 3, 90)


def test_minima_and_bands():
    texts = [cases.prose(i, 50 + i * 400) for i in range(30)]
    sets = list(shingle_sets(texts, 3))
    values = minima(sets, 12)
    a, b = minhash.hash_family(12)
    for i, s in enumerate(sets):
        plain = [min((int(x) * int(a[h]) + int(b[h])) % 2**64 for x in s.tolist()) for h in range(12)]
        assert values[i].tolist() == plain
    keys = band_keys(values, 4, 3)
    assert len(np.unique(keys)) == keys.size
    changed = values.copy()
    changed[:, 4] += np.uint64(1)
    assert ((band_keys(changed, 4, 3) == keys).sum(axis=0) == [30, 0, 30, 30]).all()


def test_estimate_is_near_the_similarity():
    words = cases.prose(5, 900).split()
    a, b = " ".join(words[:800]), " ".join(words[50:850])
    x, y = (minima(list(shingle_sets([t], 3)), 280) for t in (a, b))
    left, right = shingles(a, 3), shingles(b, 3)
    true = len(left & right) / len(left | right)
    assert abs((x == y).mean() - true) < 0.1
    assert 200 < least_agreement(85, 280) < 0.8 * 280


def test_other_columns_empty_table_and_long_text(spark):
    cases.same_with_other_columns(minhash_components, cases.frame(spark))
    assert minhash_components(cases.empty(spark)).collect() == []
    long = cases.prose(1, 200_000)
    rows = [(1, long, "en", "s", 0), (2, long + " end", "en", "s", 0), (3, None, "en", "s", 0)]
    got = result(cases.frame(spark, rows))
    assert {(i, c, k) for i, _, c, k in got} == {(1, 1, True), (2, 1, False), (3, 3, True)}


def written(monkeypatch, *modules):
    """The labels of the tables that the modules write from now on."""
    labels = []
    for module in modules:
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, f=plain: (labels.append(label), f(df, label))[1])
    return labels


def test_what_is_left_is_verified_at_once(spark):
    # The first round verifies ten pairs; the eight that are left, of up to two a class, take one more.
    class Asked:
        turns = []

        def links(self, pairs, similar):
            self.turns.append(pairs.count())
            return pairs.filter("a = 2").selectExpr("of_a a", "of_b b")

    rows = [(a, b, 9 - a) for a, n in ((0, 10), (1, 5), (2, 3)) for b in range(101, 101 + n)]
    labels = spark.createDataFrame([], "node long, component long")
    got, few = minhash._linked(spark.createDataFrame(rows, "a long, b long, agree int"), labels, Asked(), 85)
    assert Asked.turns == [10, 8] and few == 10
    assert sorted(map(tuple, got.collect())) == [(101, 2), (102, 2), (103, 2)]


def test_stars_end_without_a_round_that_only_confirms(spark, monkeypatch):
    labels = written(monkeypatch, components)
    star = [(1, i) for i in range(2, 40)] + [(i, 50) for i in range(60, 90)] + [(7, 7)]
    got = components.components(spark.createDataFrame(star, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted([(i, 1) for i in range(1, 40)] + [(i, 50) for i in [50, *range(60, 90)]])
    assert labels == ["stars"]
    labels.clear()
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
    path = [(i, i + 1) for i in range(0, 60)] + [(5, 30), (12, 3), (3, 12)]
    got = components.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(61)]
