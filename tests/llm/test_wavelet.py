import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm import cases
from tidemark.llm.wavelet import (
    VOCABULARY,
    Shard,
    WaveletMatrix,
    count_token,
    find_token,
    read_documents,
    shard_bytes,
    token_file,
    write_shards,
)

tokenizers = pytest.importorskip("tokenizers")


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [2, 7, 50257, 1 << 20])
def test_matrix(n, top):
    rng = np.random.default_rng(n + top)
    ids = rng.integers(0, top, n)
    matrix = WaveletMatrix(n, *WaveletMatrix.pack(ids))
    assert matrix.ids().tolist() == ids.tolist()
    for i in rng.integers(0, n, 15).tolist() if n else []:
        token = int(ids[i])
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        assert matrix.access(i) == token
        assert matrix.count(token, low, high) == int((ids[low:high] == token).sum())
        assert matrix.occurrences(token) == np.flatnonzero(ids == token).tolist()
        with pytest.raises(IndexError):
            matrix.select(token, matrix.count(token))
    assert matrix.count(1 << 21) == 0


def test_shard_round_trip():
    sequences = [np.array([5, 0], np.uint32), np.array([0], np.uint32), np.array([70_000, 1, 0], np.uint32)]
    shard = Shard(shard_bytes([3, None, -4], sequences))
    assert shard.keys.tolist() == [3, 0, -4] and shard.has_key.tolist() == [1, 0, 1]
    assert shard.lengths.tolist() == [2, 1, 3]
    assert shard.matrix.ids().tolist() == [5, 0, 0, 70_000, 1, 0]
    with pytest.raises(ValueError):
        Shard(b"something else")


def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def expected(rows):
    """Documents by id, null first; those of one id in any order."""
    tool, start, out = library(), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tool.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_against_library(spark, shard_tokens):
    rows = [(r[0], r[1]) for r in cases.documents() if r[0] not in (None, 12)]
    rows += [(20, "it's <|endoftext|> WE'LL  \n\n x"), (21, "!"), (22, "<|endoftext|><|endoftext|>a<|endoftext| >")]
    frame = cases.frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = token_file(frame, shard_tokens=shard_tokens).collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows))


def test_repeated_rows_and_null_ids(spark):
    got = token_file(cases.frame(spark)).collect()
    rows = [(r[0], r[1]) for r in cases.documents()]
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(e[2:] for e in expected(rows))
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))


def test_tokens_are_found_in_the_planes(spark):
    rows = [(i, cases.prose(i, 30), "en", "s", 0) for i in range(20)]
    shards = write_shards(cases.frame(spark, rows), shard_tokens=100)
    docs = {r.doc_id: r.ids for r in read_documents(shards, with_ids=True).collect()}
    token = docs[3][5]
    places = [(d, p) for d, ids in docs.items() for p, t in enumerate(ids) if t == token]
    assert sum(r.occurrences for r in count_token(shards, token).collect()) == len(places)
    assert sorted(map(tuple, find_token(shards, token).collect())) == sorted(places)


def test_other_columns_and_empty_table(spark):
    unique = cases.frame(spark, [r for r in cases.documents() if r[0] not in (None, 12)])
    cases.same_with_other_columns(token_file, unique)
    assert token_file(cases.empty(spark)).collect() == []
