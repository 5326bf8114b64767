"""Words and shingles of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

# Texts are worked on in groups of about so many bytes.
GROUP = 1 << 18
# Fixed value: ASCII white space.
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Base of the polynomial hash over bytes: odd, so it has an inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that scatters every bit."""
    x = x ^ np.uint64((salt * 0xD1342543DE82EF95) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse below 2**bits, modulo 2**64."""
    out = []
    for base in (BASE, INVERSE):
        table = np.ones(1 << bits, dtype=np.uint64)
        size = 1
        while size < len(table):
            table[size : 2 * size] = table[:size] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
        out.append(table)
    return out[0], out[1]


def range_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [first, last): a polynomial in the bytes,
    taken from running sums and shifted back to the start of each range."""
    n = len(data)
    power, inverse = _powers(max(n - 1, 1).bit_length() + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return mix((total[last] - total[first]) * inverse[first])


def groups(texts: list[str]) -> Iterator[list[bytes]]:
    """UTF-8 texts in groups of about GROUP bytes; a longer text stands alone."""
    group, held = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8")
        if group and held + len(raw) > GROUP:
            yield group
            group, held = [], 0
        group.append(raw)
        held += len(raw) + 1
    if group:
        yield group


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words start.

    The second array has one entry more than there are texts. A word is a run
    of bytes other than ASCII white space.
    """
    joined = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    joined = LOWER[joined]
    n = len(joined)
    space = SPACE[joined]
    edge = np.empty(n, dtype=bool)
    edge[0] = ~space[0]
    np.not_equal(space[1:], space[:-1], out=edge[1:])
    at = np.flatnonzero(edge)
    first, last = at[0::2], at[1::2]
    hashes = range_hashes(joined, first, last)
    ends = np.cumsum([len(r) + 1 for r in raws])
    offsets = np.concatenate(([0], np.searchsorted(first, ends)))
    return hashes, offsets


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """Per text, its distinct k-word shingles as sorted 64-bit hashes.

    Fewer than k words make one shingle of the whole; no words make none.
    """
    for raws in groups(texts):
        words, offsets = word_hashes(raws)
        # The place in the shingle is part of the hash of each of its words.
        runs = mix(words, 1)
        if len(words) >= k:
            runs = runs[: len(words) - k + 1].copy()
            for j in range(1, k):
                runs += mix(words[j : len(words) - k + 1 + j], j + 1)
            runs = mix(runs, k)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= k:
                hashes = np.sort(runs[a : b - k + 1])
                yield hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]
            elif b > a:
                whole = sum(mix(words[a + j : a + j + 1], j + 1) for j in range(b - a))
                yield mix(whole, b - a)
            else:
                yield np.empty(0, dtype=np.uint64)
