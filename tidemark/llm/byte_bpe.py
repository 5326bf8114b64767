"""Byte-level BPE encoding and decoding without a regular expression.

Texts of an Arrow batch are laid out as one array of code points. Each code
point has a class, each class a transition function on the few states of the
pre-tokeniser, and an associative scan composes these functions, so that the
state after every code point is known without walking the text. Boundaries
follow from neighbouring states. The slices between them go through cached pair
merging; the cumulative lengths of the tokens are kept, so any range of tokens
can be decoded to its bytes.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import mix, range_hashes
from tidemark.llm.common import arrow_map, kept

RANKS = "byte_bpe_50k.tiktoken"
# Places of a task's table of slices, as a power of two, and the ids it may hold.
TABLE_BITS, POOL = 21, 1 << 23
# Texts are worked on in groups of about so many code points.
GROUP = 1 << 16

# Classes of code points. The letters of the contractions have their own.
LETTER, NUMBER, OTHER, SPACE, BLANK, APOSTROPHE, END1, R, V, L, E, STOP = range(12)
# States: the kind of token the last code point belongs to. QUOTE is an
# apostrophe that may open a contraction, QUOTE_RV and QUOTE_L one followed by
# the first of two letters, DONE the end of a contraction.
S_START, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_BLANK, S_QUOTE, S_RV, S_L, S_DONE = range(10)
N_STATES = 10


def _after(state: int, kind: int) -> int:
    if kind == STOP:
        return S_START
    if kind == SPACE:
        return S_SPACE
    if kind == BLANK:
        return S_BLANK
    if kind == NUMBER:
        return S_NUMBER
    if kind == OTHER:
        return S_OTHER
    if kind == APOSTROPHE:
        # After a plain space the apostrophe is part of " '"; inside other
        # marks it is one of them. Anywhere else it may open a contraction.
        return S_OTHER if state in (S_OTHER, S_QUOTE, S_SPACE) else S_QUOTE
    if state == S_QUOTE:
        if kind == END1:
            return S_DONE
        if kind in (R, V):
            return S_RV
        if kind == L:
            return S_L
    if (state == S_RV and kind == E) or (state == S_L and kind == L):
        return S_DONE
    return S_LETTER


STEP = np.array([[_after(s, k) for s in range(N_STATES)] for k in range(12)], dtype=np.uint8)


@cache
def classes() -> np.ndarray:
    """The class of every code point, by Unicode category and white-space property."""
    table = np.full(sys.maxunicode + 2, OTHER, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    # The code points with the property White_Space.
    for first, last in (
        (0x09, 0x0D), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    ):
        table[first : last + 1] = BLANK
    table[0x20] = SPACE
    table[ord("'")] = APOSTROPHE
    for letters, kind in (("stmd", END1), ("r", R), ("v", V), ("l", L), ("e", E)):
        for letter in letters:
            table[ord(letter)] = kind
    table[-1] = STOP
    return table


def states(kinds: np.ndarray) -> np.ndarray:
    """The state after each code point, by a scan over transition functions.

    Composition is associative, so the functions of all prefixes come from
    doubling: after round i a position holds the composition of the last 2**i
    functions. A function that ignores its argument needs no more rounds; only
    the others are composed on, and these soon run out.
    """
    constant = (STEP == STEP[:, :1]).all(axis=1)
    out = STEP[kinds, 0].copy()
    open_at = np.flatnonzero(~constant[kinds])
    if not len(open_at):
        return out
    # maps[j]: the function composed so far at open_at[j], over `span` code points.
    maps = STEP[kinds[open_at]]
    row = np.full(len(kinds), -1, dtype=np.int64)
    row[open_at] = np.arange(len(open_at))
    done = constant[kinds]
    span = 1
    live = np.arange(len(open_at))
    while len(live):
        at = open_at[live]
        before = at - span
        first = before < 0
        # The text starts in S_START: nothing is left to compose.
        settled = first.copy()
        out[at[first]] = maps[live[first], S_START]
        known = np.zeros(len(live), dtype=bool)
        known[~first] = done[before[~first]]
        out[at[known]] = maps[live[known], out[before[known]]]
        settled |= known
        rest = live[~settled]
        previous = row[open_at[rest] - span]
        composed = np.take_along_axis(maps[rest], maps[previous], axis=1)
        maps[rest] = composed
        flat = (composed == composed[:, :1]).all(axis=1)
        out[open_at[rest[flat]]] = composed[flat, 0]
        done[open_at[live[settled]]] = True
        done[open_at[rest[flat]]] = True
        live = rest[~flat]
        span *= 2
    return out


def starts(points: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; STOP points stand alone."""
    kinds = classes()[points]
    # Contraction letters count as such only within two places of an apostrophe;
    # elsewhere they are letters, whose transition is constant.
    near = np.zeros(len(kinds) + 2, dtype=bool)
    quotes = np.flatnonzero(kinds == APOSTROPHE)
    near[quotes + 1] = near[quotes + 2] = True
    kinds[(kinds >= END1) & (kinds <= E) & ~near[:-2]] = LETTER
    now = states(kinds)
    n = len(points)
    cut = np.ones(n, dtype=bool)
    if n < 2:
        return cut
    prev, this = now[:-1], now[1:]
    blank = (this == S_SPACE) | (this == S_BLANK)
    after_blank = (prev == S_SPACE) | (prev == S_BLANK)
    letters = (this == S_LETTER) | (this == S_RV) | (this == S_L) | (this == S_DONE)
    marks = (this == S_OTHER) | (this == S_QUOTE)
    same = (
        (letters & ((prev == S_LETTER) | (prev == S_RV) | (prev == S_L)))
        | ((this == S_NUMBER) & (prev == S_NUMBER))
        | (marks & ((prev == S_OTHER) | (prev == S_QUOTE)))
        | ((prev == S_SPACE) & ~blank)
    )
    # Of a white-space run before other text, the last one stands apart.
    last = np.zeros(n - 1, dtype=bool)
    last[:-1] = ~blank[1:] & (kinds[2:] != STOP)
    same |= blank & after_blank & ~last
    same &= (kinds[:-1] != STOP) & (kinds[1:] != STOP)
    cut[1:] = ~same
    # A finished contraction is one token: no cut inside it, one after it.
    done = np.flatnonzero(now == S_DONE)
    two = done[(done >= 2) & np.isin(now[np.maximum(done - 1, 0)], (S_RV, S_L))]
    cut[done] = False
    cut[two - 1] = False
    # An apostrophe that opens no contraction ends before the letters.
    quote = np.flatnonzero(now[:-1] == S_QUOTE)
    follow = quote + 1
    plain = follow[np.isin(now[follow], (S_RV, S_L))]
    ends = np.zeros(n, dtype=bool)
    ends[two - 1] = True
    cut[plain[~ends[plain]]] = True
    # Letters after a finished contraction start anew.
    following = done[done + 1 < n] + 1
    cut[following[kinds[following] != STOP]] = True
    return cut


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of lowest rank, first from the left, is merged
    until no pair is in the vocabulary. Long slices use a heap."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
    while True:
        best, at = None, -1
        for i, rank in enumerate(pairs):
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    from heapq import heapify, heappop, heappush

    n = len(piece)
    end = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    alive = bytearray(b"\1") * n
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapify(heap)
    while heap:
        rank, i, middle, stop = heappop(heap)
        # Parts i..middle and middle..stop must still stand as they were.
        if not alive[i] or end[i] != middle or not alive[middle] or end[middle] != stop:
            continue
        end[i], alive[middle] = stop, 0
        if stop < n:
            left[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heappush(heap, (rank, i, stop, end[stop]))
        if i:
            j = left[i]
            rank = ranks.get(piece[j:stop])
            if rank is not None:
                heappush(heap, (rank, j, i, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class SliceTable:
    """Ids of slices met before, by a hash of their bytes and their length.

    A table of fixed size: a slice has two places, and in the second it takes
    that of another one. What the table holds only decides what is merged anew.
    It is looked up for all slices of a group at once.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], bits: int = TABLE_BITS):
        self.encode, self.shift = encode, np.uint64(64 - bits)
        self.hash = np.zeros(1 << bits, dtype=np.uint64)
        self.size, self.at, self.count = (np.zeros(1 << bits, dtype=np.int32) for _ in range(3))
        self.pool = np.empty(1 << 16, dtype="<u4")
        self.used = 0

    def _slots(self, hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Where each slice is, or else where it may go: of its two places the
        second if the first is taken by another slice."""
        slot = (hashes >> self.shift).astype(np.int64)
        taken = np.flatnonzero(((self.hash[slot] != hashes) | (self.size[slot] != size)) & (self.size[slot] > 0))
        second = (mix(hashes[taken], 9) >> self.shift).astype(np.int64)
        slot[taken] = second
        return slot

    def ids(self, raw: bytes, first: np.ndarray, last: np.ndarray, hashes: np.ndarray):
        """All ids of the slices raw[first:last] in a row, and how many each has."""
        if self.used > POOL:
            self.size[:] = 0
            self.used = 0
        size = (last - first).astype(np.int32)
        slot = self._slots(hashes, size)
        at, count = self.at[slot].astype(np.int64), self.count[slot].astype(np.int64)
        new = np.flatnonzero((self.hash[slot] != hashes) | (self.size[slot] != size))
        if len(new):
            _, index, inverse = np.unique(hashes[new], return_index=True, return_inverse=True)
            which = new[index]
            found = self.encode([raw[a:b] for a, b in zip(first[which].tolist(), last[which].tolist())])
            counts = np.array([len(f) for f in found], dtype=np.int64)
            starts = self.used + np.cumsum(counts) - counts
            end = int(self.used + counts.sum())
            if end > len(self.pool):
                grown = np.empty(max(end, 2 * len(self.pool)), dtype="<u4")
                grown[: self.used] = self.pool[: self.used]
                self.pool = grown
            self.pool[self.used : end] = np.concatenate([np.asarray(f, dtype="<u4") for f in found])
            self.used = end
            at[new], count[new] = starts[inverse], counts[inverse]
            own = slot[which]
            # Entries of one group that want the same place: the last one has it.
            self.hash[own], self.size[own] = hashes[which], size[which]
            self.at[own], self.count[own] = starts, counts
        return self.pool[spread(at, count)], count


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for count[0] numbers, then from start[1], and so on."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


def text_groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about GROUP code points; a longer one stands alone."""
    group: list[str] = []
    held = 0
    for text in texts:
        if group and held + len(text) > GROUP:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text) + 1
    if group:
        yield group


def slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 of the joined texts, first and last byte of every pre-token in it,
    and the number of the first pre-token of each text and of the end."""
    stop = sys.maxunicode + 1
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    # Laid out with one STOP after each text.
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    ends = np.cumsum(sizes + 1) - 1
    points[ends] = stop
    raw = joined.encode("utf-8")
    cuts = np.flatnonzero(starts(points))
    at = cuts
    if len(raw) != len(points):
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        width[ends] = 1
        at = (np.cumsum(width) - width)[cuts]
    # Each STOP is a slice of its own, which is left out.
    closing = np.searchsorted(cuts, ends)
    keep = np.ones(len(cuts), dtype=bool)
    keep[closing] = False
    first = at[keep]
    last = np.append(at[1:], len(raw))[keep]
    return raw, first, last, np.concatenate(([0], closing + 1 - np.arange(1, len(texts) + 1)))


def encode_texts(table: SliceTable, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text."""
    for group in text_groups(texts):
        raw, first, last, bounds = slices(group)
        ids, counts = table.ids(raw, first, last, range_hashes(np.frombuffer(raw, dtype=np.uint8), first, last))
        ends = np.concatenate(([0], np.cumsum(counts)))[bounds].tolist()
        for a, b in zip(ends[:-1], ends[1:]):
            yield ids[a:b]


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.table = SliceTable(lambda pieces: [merge(p, self.ranks) for p in pieces])
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.widths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.places = np.cumsum(self.widths) - self.widths
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        return encode_texts(self.table, texts)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each token starts in the decoded bytes, and their number."""
        return np.concatenate(([0], np.cumsum(self.widths[ids])))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[spread(self.places[ids], self.widths[ids])].tobytes()


@kept
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    with_ids: bool = True,
    with_offsets: bool = False,
) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, n_bytes, ids, offsets.

    Ids are those of the vocabulary's pair merging over each pre-token, without
    special tokens; `offsets` has each token's first byte in the decoded text.
    Null is the empty text, which has no ids. Rows are independent: repeated
    rows, null keys and other columns change nothing, and an empty table gives
    no rows. The two arrays are returned as asked for.
    """
    path = path or public_tokenizers.path(RANKS)
    kind = df.schema[key].dataType.simpleString()
    arrays = (["ids"] if with_ids else []) + (["offsets"] if with_offsets else [])
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", *arrays]

    def work(batches):
        tool = codec(path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names[1:]}
            for ids in tool.encode([t or "" for t in batch.column(1).to_pylist()]):
                plain = tool.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(plain).hexdigest())
                out["n_bytes"].append(len(plain))
                if with_ids:
                    out["ids"].append(ids.astype(np.int32))
                if with_offsets:
                    out["offsets"].append(tool.offsets(ids)[:-1])
            columns = [pa.array(out[n], types[n]) for n in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    types = {
        "n_tokens": pa.int64(),
        "ids_sha256": pa.string(),
        "decoded_sha256": pa.string(),
        "n_bytes": pa.int64(),
        "ids": pa.list_(pa.int32()),
        "offsets": pa.list_(pa.int64()),
    }
    fixed = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"
    kinds = {"ids": "array<int>", "offsets": "array<bigint>"}
    schema = ", ".join([f"`{key}` {kind}", fixed, *[f"{a} {kinds[a]}" for a in arrays]])
    small = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return arrow_map(small, work, schema, keeps="codec")
