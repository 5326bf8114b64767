import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm import cases
from tidemark.llm import byte_bpe
from tidemark.llm.byte_bpe import RANKS, Codec, SliceTable, encode_texts, encoded, merge, slices, text_groups
from tidemark.llm.common import arrow_map

tiktoken = pytest.importorskip("tiktoken")
ALPHABET = [
    "'", "s", "t", "re", "ve", "ll", "l", "r", "e", "v", "m", "d", " ", "  ", "\n", "\t", "a", "B", "9", "١", "½", "é",
    "漢", "!", "?", "\xa0", "　", "😀", "'s", "'LL", "\x85", "\r\n", "\x1c", "​", "S", "²", "Ⅳ", "́", "\0",
]


@pytest.fixture(scope="module")
def codec():
    return Codec(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_random_texts(codec, library):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(20_000)]
    texts += ["", "'", "'s", " 's", "''s", "x's't", "a" * 300 + "b" * 300, "\n\n x", "  ", "'re've"]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_every_code_point(codec, library):
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000][::7]
    texts = [f"a{chr(p)}a{chr(p)}1{chr(p)} {chr(p)}" for p in points]
    assert all(
        ids.tolist() == library.encode_ordinary(t) for t, ids in zip(texts, codec.encode(texts), strict=True)
    )


def test_long_slices_and_groups(codec, library):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdeé") for _ in range(n)) for n in (65, 1000, 5000)] + [cases.prose(3, 60_000)]
    assert [i.tolist() for i in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert [t for g in text_groups(texts) for t in g] == texts


def test_small_table_gives_the_same_ids(codec, library):
    small = SliceTable(lambda found: [merge(p, codec.ranks) for p in found], bits=4)
    texts = [cases.prose(i, 400) for i in range(6)] * 2
    assert [i.tolist() for i in encode_texts(small, texts)] == [library.encode_ordinary(t) for t in texts]


def test_table_starts_anew(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "POOL", 50)
    small = SliceTable(lambda found: [merge(p, codec.ranks) for p in found], bits=8)
    for i in range(5):
        assert b"".join(codec.decode(x) for x in encode_texts(small, [cases.prose(i, 100)])) == cases.prose(i, 100).encode()


def test_slices_join_to_the_text():
    texts = ["a  b", "", "é's ", "漢字 x"]
    raw, first, last, bounds = slices(texts)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert b"".join(raw[x:y] for x, y in zip(first[a:b], last[a:b])) == text.encode()


def test_offsets(codec):
    ids = next(codec.encode(["l'été à Paris 😀"]))
    offsets = codec.offsets(ids)
    whole = codec.decode(ids)
    for a in range(len(ids)):
        assert codec.decode(ids[a:]) == whole[offsets[a] :]


def test_operator(spark, library):
    rows = cases.documents()
    got = encoded(cases.frame(spark), with_offsets=True).collect()

    def row(i, text):
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, dtype="<u4").tobytes()
        return (i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())

    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(
        row(r[0], r[1]) for r in rows
    )
    assert all(len(r.ids) == len(r.offsets) == r.n_tokens for r in got)


def test_other_columns_and_empty_table(spark):
    cases.same_with_other_columns(lambda d: encoded(d, with_ids=False), cases.frame(spark))
    assert encoded(cases.empty(spark)).collect() == []


def test_vocabulary_file():
    ranks = byte_bpe.load_ranks(public_tokenizers.path(RANKS))
    assert all(bytes([b]) in ranks for b in range(256))
    assert base64.b64encode(b"!").decode() == "IQ=="


def test_workers_let_the_codec_go_when_another_operator_comes(spark):
    df = cases.frame(spark, [(i, cases.prose(i, 10), "en", "s", 0) for i in range(8)])
    assert encoded(df).count() == 8

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([byte_bpe.codec.cache_info().currsize])], names=["n"])

    assert not any(r.n for r in arrow_map(df.select("text"), held, "n long").collect())
