"""Token ids in wavelet-matrix shards.

A shard is one compressed file: the documents of a range of keys, their lengths,
and the bit-planes of their ids. Plane by plane, from the highest bit, ids with
a 0 move stably before those with a 1. Rank and select on the planes give any
token, the number of times an id occurs in a range, and the place of its k-th
occurrence, without the plain ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import SliceTable, encode_texts
from tidemark.llm.common import arrow_map
from tidemark.session import materialize

VOCABULARY = "byte_bpe_50k.json"
END = 0
# A shard is closed once it holds so many tokens.
SHARD_TOKENS = 1 << 20
MAGIC = b"WVM1"
LEVEL = 3
# Words of 64 bits between two entries of a rank directory.
STRIDE = 8


class Plane:
    """One bit per token, with a directory of ones before every STRIDE words."""

    def __init__(self, packed: bytes, n: int):
        size = -(-n // 64) * 8
        self.n = n
        self.words = np.frombuffer(packed.ljust(size, b"\0"), dtype="<u8")

    @cached_property
    def before(self) -> np.ndarray:
        ones = np.bitwise_count(self.words).astype(np.int64)
        ones = np.pad(ones, (0, -len(ones) % STRIDE))
        sums = ones.reshape(-1, STRIDE).sum(axis=1)
        return np.concatenate(([0], np.cumsum(sums)))

    def bit(self, i: int) -> int:
        return int(self.words[i >> 6] >> np.uint64(i & 63)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        word, block = i >> 6, i // (64 * STRIDE)
        total = int(self.before[block]) + int(np.bitwise_count(self.words[block * STRIDE : word]).sum())
        if i & 63:
            total += (int(self.words[word]) & ((1 << (i & 63)) - 1)).bit_count()
        return total

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th bit of that value, from 0."""
        full = np.arange(len(self.before)) * 64 * STRIDE
        sums = self.before if bit else full - self.before
        block = int(np.searchsorted(sums, k, side="right")) - 1
        k -= int(sums[block])
        for word in range(block * STRIDE, len(self.words)):
            value = int(self.words[word])
            value = value if bit else ~value & ((1 << 64) - 1)
            ones = value.bit_count()
            if k < ones:
                for _ in range(k):
                    value &= value - 1
                return (word << 6) + (value & -value).bit_length() - 1
            k -= ones
        raise IndexError(k)

    def unpacked(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(bool)


class WaveletMatrix:
    """Access, rank, select and count over a sequence of ids."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes]):
        self.n, self.zeros = n, zeros
        self.planes = [Plane(p, n) for p in planes]

    @staticmethod
    def pack(ids: np.ndarray) -> tuple[list[int], list[bytes]]:
        bits = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        now = np.asarray(ids, dtype=np.uint16 if bits <= 16 else np.uint32)
        zeros, planes = [], []
        for b in range(bits - 1, -1, -1):
            ones = (now & now.dtype.type(1 << b)) != 0
            planes.append(np.packbits(ones, bitorder="little").tobytes())
            low = now[~ones]
            zeros.append(len(low))
            now = np.concatenate((low, now[ones]))
        return zeros, planes

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.bit(i), plane.rank1(i)
            value = 2 * value + bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the token's occurrences of [lo, hi) lie below the last plane."""
        for depth, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank1(lo), plane.rank1(hi)
            if token >> (len(self.planes) - 1 - depth) & 1:
                lo, hi = zeros + a, zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of the token in [lo, hi)."""
        if token >> len(self.planes):
            return 0
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of the token, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        place = self._range(token, 0, 0)[0] + k
        for depth in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - depth) & 1
            place = self.planes[depth].select(bit, place - self.zeros[depth] if bit else place)
        return place

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the moves from the last plane up."""
        now = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for b, plane in enumerate(reversed(self.planes)):
            ones = plane.unpacked()
            zeros = self.zeros[len(self.planes) - 1 - b]
            above = np.empty_like(now)
            above[~ones] = now[:zeros]
            above[ones] = now[zeros:] | now.dtype.type(1 << b)
            now = above
        return now


class Shard:
    """Reads a shard's bytes; planes are decompressed when they are used."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard")
        docs, n, bits = struct.unpack_from("<QQB", blob, 4)
        at = 4 + struct.calcsize("<QQB")
        zeros = list(struct.unpack_from(f"<{bits}Q", blob, at))
        at += 8 * bits
        sizes = struct.unpack_from(f"<{bits + 1}Q", blob, at)
        at += 8 * (bits + 1)
        parts = []
        for size in sizes:
            parts.append(zstandard.ZstdDecompressor().decompress(blob[at : at + size]))
            at += size
        known = np.frombuffer(parts[0], dtype="<i8").reshape(3, docs)
        self.keys, self.has_key, self.lengths = known
        self.matrix = WaveletMatrix(n, zeros, parts[1:])


def shard_bytes(keys: list[int | None], sequences: list[np.ndarray]) -> bytes:
    """One shard: header, documents, planes; each part compressed on its own."""
    ids = np.concatenate(sequences)
    zeros, planes = WaveletMatrix.pack(ids)
    known = np.array(
        [[k or 0 for k in keys], [k is not None for k in keys], [len(s) for s in sequences]], dtype="<i8"
    )
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    parts = [squeeze.compress(p) for p in (known.tobytes(), *planes)]
    head = MAGIC + struct.pack("<QQB", len(keys), len(ids), len(planes))
    head += struct.pack(f"<{len(zeros)}Q", *zeros) + struct.pack(f"<{len(parts)}Q", *map(len, parts))
    return head + b"".join(parts)


@cache
def tokenizer_table(path: str) -> SliceTable:
    """Slices to ids by the tokenizers library, which sees no added token in them."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    tool.encode_special_tokens = True

    def encode(pieces: list[bytes]) -> list[list[int]]:
        found = tool.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)
        return [f.ids for f in found]

    return SliceTable(encode)


@cache
def added_tokens(path: str) -> dict[str, int]:
    """The file's added tokens, which the library finds in a text before all else."""
    from tokenizers import Tokenizer

    return {token.content: i for i, token in Tokenizer.from_file(path).get_added_tokens_decoder().items()}


def whole_ids(table: SliceTable, added: dict[str, int], texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text: its added tokens, and the encoded text between them.

    The longer of two added tokens at one place is taken.
    """
    if not added:
        yield from encode_texts(table, texts)
        return
    marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    parts = [marks.split(t) for t in texts]
    between = encode_texts(table, [p for cut in parts for p in cut[::2]])
    for cut in parts:
        ids = [next(between)]
        for mark in cut[1::2]:
            ids += [np.array([added[mark]], dtype="<u4"), next(between)]
        yield np.concatenate(ids) if len(ids) > 1 else ids[0]


def write_shards(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end: int = END,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Shards in ascending order of their number: (shard, docs, tokens, blob).

    Documents are range-partitioned and sorted by their integer key, null first,
    then by a hash of the text; a task cuts its documents into shards as they
    stream by, so memory is bounded by a shard and the longest document.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batches) -> Iterator[pa.RecordBatch]:
        table, added = tokenizer_table(path), added_tokens(path)
        number = TaskContext.get().partitionId() << 32
        keys, sequences, held = [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(keys)], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([shard_bytes(keys, sequences)], pa.binary()),
                ],
                names=["shard", "docs", "tokens", "blob"],
            )

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), whole_ids(table, added, texts)):
                keys.append(doc)
                sequences.append(np.append(ids, np.uint32(end)))
                held += len(ids) + 1
                if held >= shard_tokens:
                    yield shard()
                    number += 1
                    keys, sequences, held = [], [], 0
        if keys:
            yield shard()

    docs = df.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    order = [F.col("_key").asc_nulls_first(), F.xxhash64("_text")]
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = arrow_map(placed, work, "shard bigint, docs bigint, tokens bigint, blob binary")
    return materialize(shards, "shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """(shard, shard_start): tokens of all shards before it.

    Shards are summed within the partition that wrote them, and partitions
    before each other, so the one window without a key has a row a partition.
    """
    part = F.shiftright("shard", 32).alias("_part")
    sizes = materialize(shards.select("shard", "tokens", part), "sizes")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("_part").agg(F.sum("tokens").alias("_sum"))
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    local = F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return (
        sizes.withColumn("_local", local)
        .join(offsets, "_part")
        .select("shard", (F.col("_before") + F.col("_local")).alias("shard_start"))
    )


def read_documents(shards: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents as the shards have them: key, start, n_tokens, ids_crc32 (and ids)."""

    def work(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Shard(blob.as_py())
                ids = found.matrix.ids().astype("<u4")
                ends = np.cumsum(found.lengths)
                parts = [ids[a:b] for a, b in zip((ends - found.lengths).tolist(), ends.tolist())]
                data = [
                    pa.array(found.keys, mask=found.has_key == 0),
                    pa.array([number] * len(parts), pa.int64()),
                    pa.array(ends - found.lengths),
                    pa.array(found.lengths),
                    pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                ]
                if with_ids:
                    data.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(data, names=names)

    names = [key, "shard", "_local", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = f"`{key}` bigint, shard bigint, _local bigint, n_tokens bigint, ids_crc32 bigint"
    docs = arrow_map(shards.select("shard", "blob"), work, schema + (", ids array<int>" if with_ids else ""))
    starts = materialize(shard_starts(shards), "starts")
    return docs.join(starts, "shard").select(
        key,
        (F.col("shard_start") + F.col("_local")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """(shard, occurrences) of an id, by rank on the planes alone."""

    def work(batches):
        for batch in batches:
            found = [Shard(b.as_py()).matrix.count(token) for b in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["shard", "occurrences"]
            )

    return arrow_map(shards.select("shard", "blob"), work, "shard bigint, occurrences bigint")


def find_token(shards: DataFrame, token: int, key: str = "doc_id") -> DataFrame:
    """(key, place): every occurrence of an id and its place in its document."""

    def work(batches):
        for batch in batches:
            for blob in batch.column(0):
                found = Shard(blob.as_py())
                at = np.array(found.matrix.occurrences(token), dtype=np.int64)
                ends = np.cumsum(found.lengths)
                doc = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.keys[doc], mask=found.has_key[doc] == 0),
                        pa.array(at - (ends - found.lengths)[doc]),
                    ],
                    names=[key, "place"],
                )

    return arrow_map(shards.select("blob"), work, f"`{key}` bigint, place bigint")


def token_file(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write the shards and read every document back from them.

    One row per input row. Null is the empty text, which has the end id alone;
    repeated rows are documents of their own, next to each other. Other columns
    are ignored; an empty table gives no shards and no rows.
    """
    return read_documents(write_shards(df, key, text, **options), key)
