from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tests.llm import cases
from tidemark.llm import jaccard
from tidemark.llm.arrays import shingle_sets
from tidemark.llm.components import components
from tidemark.llm.jaccard import jaccard_components, without_near_copies


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def brute(rows, k, similar):
    sets = [shingles(r[1], k) for r in rows]
    links = [
        (a, b)
        for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b])
    ]
    groups = defaultdict(list)
    for i, root in enumerate(roots(len(rows), links)):
        groups[root].append(i)
    out = Counter()
    for members in groups.values():
        ids = [rows[i][0] for i in members]
        first = None if None in ids else min(ids)
        out.update((rows[i][0], len(sets[i]), first) for i in members)
    return out


def near_copies(n, words, edits, seed=1):
    """Copies of one text with a few words changed each, and unrelated texts."""
    rng, base = np.random.default_rng(seed), cases.prose(seed, words).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.integers(0, words, rng.integers(0, edits + 1)):
            copy[at] = f"edit{rng.integers(0, 10_000)}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    rows += [(n + i, cases.prose(100 + i, words), "en", "s", 0) for i in range(n // 4)]
    return rows


@pytest.mark.parametrize("k,similar", [(3, 90), (5, 80), (1, 50)])
def test_against_brute_force(spark, k, similar):
    rows = cases.documents()
    got = jaccard_components(cases.frame(spark), k=k, similar=similar, bits=14).collect()
    assert Counter(map(tuple, got)) == brute(rows, k, similar)


@pytest.mark.parametrize("n,words,edits,k,similar", [(60, 80, 4, 3, 90), (90, 60, 6, 5, 80), (40, 12, 1, 3, 60)])
def test_groups_of_near_copies(spark, n, words, edits, k, similar):
    rows = near_copies(n, words, edits)
    got = jaccard_components(cases.frame(spark, rows), k=k, similar=similar, bits=14).collect()
    assert Counter(map(tuple, got)) == brute(rows, k, similar)


def test_all_pairs_of_a_bucket_that_stays_open(spark, monkeypatch):
    # Every text shares its rarest shingles with all others, few are similar.
    shared = cases.prose(1, 12)
    rows = [(i, f"{shared} {cases.prose(i + 2, 9)}", "en", "s", 0) for i in range(40)]
    rows += [(100 + i, f"{shared} {cases.prose(i + 2, 8)}", "en", "s", 0) for i in range(0, 40, 5)]
    monkeypatch.setattr(jaccard, "SMALL", 2)
    for limit in (0, 4, 1000):
        monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", limit)
        got = jaccard_components(cases.frame(spark, rows), k=3, similar=60, bits=14).collect()
        assert Counter(map(tuple, got)) == brute(rows, 3, 60)


def test_one_of_each_group_stays(spark):
    rows = near_copies(60, 80, 4) + [(3, None, "en", "s", 0), (3, "", "en", "s", 0), (7, near_copies(60, 80, 4)[7][1], "en", "s", 0)]
    df = cases.clashing(cases.frame(spark, rows))
    got = without_near_copies(df)
    assert got.columns == df.columns
    stay = Counter(r.doc_id for r in got.collect() if r.text)
    expected = {c for _, n, c in brute(rows, 5, 80) if n}
    assert stay == Counter(expected)
    assert sum(1 for r in got.collect() if not r.text) == 2


def test_sets():
    texts = [r[1] for r in cases.documents()] + ["A b  C\td", "a b", "  x", "é É"]
    for k in (1, 3, 5):
        assert [len(s) for s in shingle_sets(texts, k)] == [len(shingles(t, k)) for t in texts]
    a, b = shingle_sets(["The Cat sat ON it", "x the cat SAT on\nit"], 3)
    assert set(a.tolist()) < set(b.tolist()) and len(b) == 4


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    edges = chain + [(300, 301), (302, 301), (5, 2), (400, 401), (401, 400), (500, 500)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {r.node: r.component for r in got}
    assert len(got) == len(groups)
    assert all(groups[i] == 0 for i in range(201))
    assert groups[302] == 300 and groups[401] == 400 and 500 not in groups


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(lambda d: jaccard_components(d, bits=14), cases.frame(spark))
    assert jaccard_components(cases.empty(spark), bits=14).collect() == []
    assert without_near_copies(cases.empty(spark), bits=14).collect() == []
