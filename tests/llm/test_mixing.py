import hashlib
import math
import re
from collections import defaultdict

import pytest

from tests.llm import cases
from tidemark.llm.mixing import mix, mixed


def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (4, 1, 0), (9, 0, 1), (9, 1, 0), (None, 1, 0), (12, None, 0)],
        "doc_id long, quality int, toxic int",
    )


def targets(sizes, weights=(5, 2, 1), budget=1.5, epochs=2):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, free, out = budget * sum(sizes.values()), set(sizes), {}
    while free:
        level = total / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = float(epochs * sizes[s])
            total -= out[s]
        free -= over
    return out


def brute(rows, quality):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for i, text, _, source, _ in rows:
        digest = hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / (1 << 52)
        w = {1: 2.0, 0: 0.5}.get(quality.get(i), 1.0)
        by[source].append((-math.log(u) / w, i is not None, i or 0, i, size(text)))
    sizes = {s: sum(d[4] for d in v) for s, v in by.items()}
    goal, out = targets(sizes), []
    for s, docs in by.items():
        whole = int(goal[s] // sizes[s]) if sizes[s] else 0
        rest, end = goal[s] - whole * sizes[s], 0
        for _, _, _, i, n in sorted(docs, key=lambda d: d[:3]):
            end += n
            repeats = whole + (rest > 0 and 2 * end - n <= 2 * rest)
            out.append((i, n, sizes[s], round(goal[s], 6), repeats, repeats * n))
    return sorted(out, key=repr)


def found(df):
    return sorted(((*r[:3], round(r[3], 6), *r[4:]) for r in map(tuple, df.collect())), key=repr)


QUALITY = {1: 1, 2: 0, 4: 1, 9: 1}


def test_against_brute_force(spark):
    # Rows of one id and text size are alike, so ties cannot show.
    rows = [r for r in cases.documents() if r[:2] != (12, "another text of this id") and r[0] is not None]
    assert found(mix(cases.frame(spark, rows), labels(spark))) == brute(rows, QUALITY)


@pytest.mark.parametrize("seed", [1, 2])
def test_many_documents(spark, seed):
    rows = [
        (i, cases.prose(i + seed, 1 + i * i % 37), "en", "hot" if i % 3 == 0 else f"s{i % 11}", None)
        for i in range(2000)
    ]
    got = mix(cases.frame(spark, rows), labels(spark))
    assert found(got) == brute(rows, QUALITY)
    assert found(got) == found(mix(cases.frame(spark, rows).repartition(7), labels(spark)))


def test_targets_are_met(spark):
    rows = [(i, cases.prose(i, 20), "en", f"s{i % 4}", None) for i in range(800)]
    taken, goal = defaultdict(int), {}
    for r in mix(cases.frame(spark, rows), labels(spark)).collect():
        source = f"s{r.doc_id % 4}"
        taken[source] += r.taken
        goal[source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - goal[s]) <= 10 for s in goal)


def test_mixed_rows(spark):
    df = cases.clashing(cases.frame(spark))
    got = mixed(df, labels(spark))
    assert got.columns == df.columns
    times = {(r.doc_id, r.size): 0 for r in mix(cases.frame(spark), labels(spark)).collect()}
    assert got.count() == sum(r.repeats for r in mix(cases.frame(spark), labels(spark)).collect())
    assert all(t is not None for t in times)


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(lambda d: mix(d, labels(spark)).drop("repeats", "taken"), cases.frame(spark))
    assert mix(cases.empty(spark), labels(spark)).collect() == []
    nothing = [(i, t, "en", "a", 0) for i, t in ((1, None), (2, ""), (3, " "))]
    assert [r.taken for r in mix(cases.frame(spark, nothing), labels(spark)).collect()] == [0, 0, 0]
