import re._constants as code
import re._parser as parser
from collections import Counter
from itertools import product

from tests.llm import cases
from tests.llm.test_licenses import brute
from tidemark.llm.license_rules import ABBREVIATIONS, AT_START, GRANT, LICENSES, STEMS, rules
from tidemark.llm.licenses import licenses


def accepted(parsed):
    """All texts a pattern of groups, choices, options and small classes accepts."""
    parts = []
    for op, arg in parsed:
        if op is code.LITERAL:
            parts.append([chr(arg)])
        elif op is code.IN:
            parts.append([chr(c) for kind, a in arg for c in ([a] if kind is code.LITERAL else range(a[0], a[1] + 1))])
        elif op is code.BRANCH:
            parts.append([t for one in arg[1] for t in accepted(one)])
        elif op is code.SUBPATTERN:
            parts.append(accepted(arg[3]))
        elif op is not code.ASSERT_NOT:
            assert op is code.MAX_REPEAT and arg[:2] == (0, 1)
            parts.append(["", *accepted(arg[2])])
    return ["".join(t) for t in product(*parts)]


def variants(pattern):
    return accepted(parser.parse(pattern))


def test_keywords_and_stems_pass_all_that_the_pattern_accepts():
    for rule in rules():
        for text in variants(rule.pattern.removeprefix(GRANT)):
            assert rule.keyword in f" {text} ", (rule, text)
            inside = any(s.split()[0] in text for s in STEMS if s not in AT_START)
            assert inside or any(f" {s}" in f" {text}" for s in (*AT_START, "cc by")), (rule, text)


def test_rules_with_and_without_gate_agree_on_variants(spark):
    texts = []
    for *_, name in LICENSES + ABBREVIATIONS:
        found = variants(name)
        texts += found[:: max(1, len(found) // 5)][:6] + found[-1:]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = licenses(cases.frame(spark, rows)).collect()
    found = Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in got
    )
    assert found == Counter((r[0], *brute(r[1])) for r in rows)


def test_share_alike_in_two_words(spark):
    rows = [(1, "Creative Commons Attribution-Share Alike", "en", "s", 0)]
    assert licenses(cases.frame(spark, rows)).first().labels == "cc-by-sa"
