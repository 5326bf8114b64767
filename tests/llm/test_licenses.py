import re
from collections import Counter

from tests.llm import cases
from tidemark.llm.license_rules import BASE, STEMS, rules
from tidemark.llm.licenses import licenses

TEXTS = [
    "MIT License\nCopyright (c) 2020",
    "Licensed under the Apache License, Version 2.0 (the License)",
    "CC-BY 4.0 cc by cc by, cc-by-sa 4.0 cc  by",
    "SPDX-License-Identifier: GPL-3.0-only; gnu general public license v3",
    "the GNU General Public License and mİt license Kernel",
    "mit license " * 40 + "x",
    "All rights reserved. Released into the public domain.",
    "gnu lesser general public license 2.1 or gnu general public licence",
    "https://creativecommons.org/licenses/by-nc/4.0/",
]


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    base = []
    for phrase, label in BASE.items():
        parts = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    norm, all_found = " " + " ".join(words) + " ", []
    for rank, rule in enumerate(rules()):
        for m in re.finditer(f"(?<= )({rule.pattern})(?= )", norm):
            first = norm[: m.start()].count(" ") - 1
            last = first + m.group(0).count(" ")
            all_found.append((first, -last, rule.tier, rank, rule.label, rule.confidence))
    kept = [
        d for d in all_found
        if not any(o[0] <= d[0] and o[1] <= d[1] and o[2] <= d[2] and o[:4] < d[:4] for o in all_found)
    ]
    starts = [b[0] for b in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({b[1] for b in base})), ",".join(sorted({b[1] for b in base} | {d[4] for d in kept})),
        max((d[5] for d in kept), default=0.0),
    )


def test_against_brute_force(spark):
    rows = cases.documents() + [(100 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    got = licenses(cases.frame(spark, rows)).collect()
    found = Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in got
    )
    assert found == Counter((r[0], *brute(r[1])) for r in rows)


def test_rules():
    table = rules()
    assert len(table) > 200
    for rule in table:
        re.compile(rule.pattern)
        needed = rule.pattern.replace("licen[cs]e", "licen")
        assert any(s in needed for s in STEMS) or "cc by" in needed or "cc0" in needed


def test_spans_are_words(spark):
    rows = [(1, "see  the\tApache-License 2.0, please", "en", "s", 0)]
    got = licenses(cases.frame(spark, rows)).first()
    assert [tuple(s) for s in got.spans] == [(2, 5, "apache-2.0")]


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(licenses, cases.frame(spark))
    assert licenses(cases.empty(spark)).collect() == []
