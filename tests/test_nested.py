import json
import random

import pytest
from test_fold import OPS

from tidemark.operators import nested
from tidemark.operators.docops import DELETE, MAP_CLEAR, MAP_REMOVE, UPSERT


def merged(old, new):
    """What the document store does with an object on an object."""
    if isinstance(old, dict) and isinstance(new, dict):
        return {**old, **{k: merged(old[k], v) if k in old else v for k, v in new.items()}}
    return new


def value(rng, depth=3):
    kind = rng.randrange(7 if depth else 5)
    if kind >= 3:
        return {k: value(rng, depth - 1) for k in rng.sample(["a", "b", "c.d", 'q"é'], rng.randrange(3))} if depth else {}
    return [rng.randrange(9), "text", [1, {"a": 2}]][kind]


def random_ops(seed, n):
    rng, out = random.Random(seed), []
    for epoch in range(n):
        kind = rng.choices([UPSERT, MAP_REMOVE, MAP_CLEAR, DELETE], [20, 2, 1, 1])[0]
        raw = json.dumps(value(rng)) if rng.random() < 0.9 else rng.choice(["plain", "{broken", "", "NaN", "null"])
        key = f"k{rng.randrange(2)}" if kind in (UPSERT, MAP_REMOVE) else None
        out.append((f"i{rng.randrange(2)}", f"d{rng.randrange(3)}", (epoch, 0), kind, None, key, raw if kind == UPSERT else None, True))
    return out


def brute(ops):
    docs = {}
    for index, doc, _, kind, _, key, raw, _ in sorted(ops, key=lambda o: o[2]):
        entries = docs.setdefault((index, doc), {})
        if kind in (MAP_CLEAR, DELETE):
            entries.clear()
        elif kind == MAP_REMOVE:
            entries.pop(key, None)
        else:
            try:
                new = json.loads(raw, parse_constant=lambda c: 1 / 0)
            except (ValueError, ZeroDivisionError):
                new = raw
            entries[key] = merged(entries[key], new) if key in entries else new
    return {(*d, k): v for d, entries in docs.items() for k, v in entries.items()}


def leaves(v, path=()):
    if isinstance(v, dict) and v:
        return {p: x for k, c in v.items() for p, x in leaves(c, (*path, k)).items()}
    return {path: json.dumps(v, ensure_ascii=False, separators=(",", ":"))}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_against_a_loop(spark, seed):
    ops = random_ops(seed, 150)
    want = brute(ops)
    assert any(isinstance(v, dict) for v in want.values())
    state = nested.nested_state(spark.createDataFrame(random.Random(seed).sample(ops, len(ops)), OPS))
    got = {(r["index"], r["doc_id"], r["xattr_key"]): r["value"] for r in nested.nested_values(state).collect()}
    assert {k: json.loads(v) for k, v in got.items()} == want
    flat = {((r["index"], r["doc_id"], r["xattr_key"]), tuple(r["path"])): r["leaf"] for r in nested.nested_leaves(state).collect()}
    assert flat == {(k, p): x for k, v in want.items() for p, x in leaves(v).items()}


def test_partial_states_merge(spark):
    ops = random_ops(7, 90)
    parts = [nested.nested_state(spark.createDataFrame(ops[i::3], OPS)) for i in range(3)]
    both = nested.merge_nested(parts[0].union(parts[1]).union(parts[2]).union(parts[1]))
    got = {(r["index"], r["doc_id"], r["xattr_key"]): json.loads(r["value"]) for r in nested.nested_values(both).collect()}
    assert got == brute(ops)


def test_no_operations(spark):
    state = nested.nested_state(spark.createDataFrame([], OPS))
    assert nested.nested_values(state).collect() == [] == nested.nested_leaves(state).collect()
