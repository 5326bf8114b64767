import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tests.llm import cases
from tidemark.llm.exact_dedup import exact_dedup, without_copies


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids = defaultdict(list)
    for r, n in zip(rows, norm):
        ids[n].append(r[0])
    first = {n: None if None in v else min(v) for n, v in ids.items()}
    return Counter(
        (r[0], first[n], len(ids[n]), hashlib.sha256(n.encode()).hexdigest()) for r, n in zip(rows, norm)
    )


@pytest.mark.parametrize("fan_bits", [1, 2, 4])
def test_against_brute_force(spark, fan_bits):
    got = exact_dedup(cases.frame(spark).repartition(9), fan_bits=fan_bits).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(cases.documents())
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in got}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_large_group(spark):
    rows = [(i, "copy" if i % 3 else f"text {i}", "en", "s", 4) for i in range(3000)]
    got = exact_dedup(cases.frame(spark, rows).repartition(23), fan_bits=2).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected(rows)


def test_rows_that_stay(spark):
    df = cases.clashing(cases.frame(spark))
    got = without_copies(df)
    assert got.columns == df.columns
    texts = Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in got.collect())
    assert set(texts.values()) == {1} and len(texts) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in cases.documents()})


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(lambda d: exact_dedup(d).select("doc_id", "keep_id", "group_size", "text_sha256"), cases.frame(spark))
    assert exact_dedup(cases.empty(spark)).collect() == []
    assert without_copies(cases.empty(spark)).collect() == []
