import random
from collections import Counter

import public_tokenizers

from tests.llm import cases
from tidemark.llm.token_counts import MARK, VOCABULARY, Automaton, WordCounts, pieces, token_counts


def brute(vocabulary, word):
    longest = max(map(len, vocabulary))
    at = total = 0
    while at < len(word):
        for n in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + n] in vocabulary:
                at, total = at + n, total + 1
                break
        else:
            total += len(word[at].encode())
            at += 1
    return total


def test_random_vocabularies():
    rnd = random.Random(3)
    for _ in range(300):
        vocabulary = {"".join(rnd.choice("abcd▁") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 25))}
        automaton = Automaton(vocabulary)
        for _ in range(60):
            word = "".join(rnd.choice("abcdeé▁") for _ in range(rnd.randint(0, 14)))
            assert automaton.count(word) == brute(vocabulary, word)


def test_operator(spark):
    vocabulary = set(pieces(public_tokenizers.path(VOCABULARY)))

    def row(i, text):
        words = (text or "").encode().split()
        return i, len(words), sum(brute(vocabulary, MARK + w.decode()) for w in words)

    got = token_counts(cases.frame(spark)).collect()
    assert Counter(map(tuple, got)) == Counter(row(r[0], r[1]) for r in cases.documents())


def test_cache_starts_anew():
    automaton = Automaton(["ab", "a", "b", MARK])
    small = WordCounts(automaton, size=2)
    words = [b"ab", b"ba", b"aab", b"ab", b"x" * 100]
    assert [small[w] for w in words] == [automaton.count(MARK + w.decode()) for w in words]


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(token_counts, cases.frame(spark))
    assert token_counts(cases.empty(spark)).collect() == []
