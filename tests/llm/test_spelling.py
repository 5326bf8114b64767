import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from tidemark.llm import spelling
from tidemark.llm.spelling import PAD, affected, decompose, spelling_variants

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100))
TO_LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """One insertion, deletion or replacement apart, by trying the place."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    a, b = sorted((a, b), key=len)
    return a[i:] == b[i + 1 :]


def brute(rows):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            low = run.translate(TO_LOWER)
            h = crc32(f"{'' if r[0] is None else r[0]}:{low}".encode())
            counts[low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, out = {}, set()
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out.add((w, form[w], len(others)))
    result = set()
    for w, f, k in out:
        root = w
        while form[root] is not None:
            root = form[root]
        result.add((w, f, root, words[w], k, None if f is None else words[f]))
    return result


def edits(rng, word):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    c = rng.choice(LETTERS[:6])
    return [word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]][kind]


def corpus(seed, n):
    """Texts over a small vocabulary of words and their variants."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    words = base + [edits(rng, w) for w in base for _ in range(2)] + ["Élanéé", "NAÏVETÉ", "naïveté", "aaaaaa", "aaaaaaa", "aaaaa"]
    weights = [rng.choice([1, 1, 2, 8]) for _ in words]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 40))) for _ in range(n)]
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def result(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("least", [1, 8, 64])
def test_against_brute_force(spark, least):
    rows = corpus(1, 80)
    expected = brute(rows)
    assert any(f and root not in (w, f) for w, f, root, *_ in expected)
    assert result(spelling_variants(cases.frame(spark, rows), least=least)) == expected


def test_cases_and_repeated_rows(spark):
    rows = cases.documents() + [(5, "l'École ÉCOLE école écoles " * 3 + "x" * 100_000, "en", "s", 0)] * 3
    got = result(spelling_variants(cases.frame(spark, rows)))
    assert got == brute(rows)
    assert ("x" * 100_000) in {r[0] for r in got}


def test_one_code_point_is_deleted(spark):
    key = next(i for i in range(10_000) if crc32(f"{i}:letters".encode()) % 97 == 0)
    rows = [(key, "Letters LETTERS letters", "en", "s", 0), (key + 1, "lettered " * 4, "en", "s", 0)]
    got = result(spelling_variants(cases.frame(spark, rows)))
    assert got == brute(rows) and "letters" not in {r[0] for r in got}


def test_empty_table_and_other_columns(spark):
    assert spelling_variants(cases.empty(spark)).collect() == []
    cases.same_with_other_columns(spelling_variants, cases.frame(spark, corpus(2, 20)))


@settings(max_examples=400, deadline=None)
@given(
    st.text("abcé", min_size=5, max_size=14),
    st.integers(0, 13),
    st.integers(0, 2),
    st.sampled_from("abcé"),
    st.sets(st.text("abcé\u0001", min_size=2, max_size=3)),
)
def test_bound_on_changed_grams(word, at, kind, c, extended):
    """Whatever the dictionary, an edit leaves at least `bound` grams at their place."""
    frequent = frozenset(g for g in extended if len(g) == 2 or g[:2] in extended)
    at = min(at, len(word) - (kind != 1))
    other = [word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]][kind]
    if len(other) < 5:
        return
    a, b = PAD + word + PAD, PAD + other + PAD
    ga, gb = decompose(a, frequent), decompose(b, frequent)
    kept = set(ga) & set(gb) | {(g, s) for g, s in ga if (g, s + len(b) - len(a)) in gb}
    for grams, padded in ((ga, a), (gb, b)):
        bound = len(grams) - affected(grams, len(padded), frequent)
        assert 1 <= bound <= len(kept)


def test_grams_cover_the_word():
    frequent = frozenset({"ab", "abc", "bc"})
    cut = decompose(PAD + "abcd" + PAD, frequent)
    assert ("abcd", 2) in cut and all(g != "bcd" for g, _ in cut)
    assert {i for g, s in cut for i in range(s, s + len(g))} == set(range(8))


def test_frequent_grams_are_bounded(spark):
    words = spark.createDataFrame([(f"{a}{b}xyz", 3) for a in "abcdef" for b in "abcdef"], "word string, n long")
    grams = spelling.frequent_grams(words, 10)
    assert {"xy", "yz", "xyz"} <= grams and "ab" not in grams
    assert len(spelling.frequent_grams(words, 1, share_bits=3)) <= 16
