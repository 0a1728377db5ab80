"""Word shingles of texts as sorted arrays of 64-bit hashes, for a whole batch at once in numpy."""

from __future__ import annotations

import numpy as np

#: Odd multipliers and a table of random words; any fixed values do.
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:] = _BASE
    out[:1] = 1
    return np.multiply.accumulate(out)


#: Bytes that are hashed at a time; scratch arrays take some thirty times as much.
BLOCK = 1 << 20


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word in a buffer of UTF-8; A-Z count as a-z."""
    hashes, starts, lo = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while lo < len(data):
        hi = min(lo + BLOCK, len(data))
        while hi < len(data) and not (after := np.flatnonzero(_SPACE[data[hi : hi + BLOCK]])).size:
            hi = min(hi + BLOCK, len(data))
        if hi < len(data):
            hi += int(after[0])  # a block ends where a word does
        h, s = _hash_block(data[lo:hi])
        hashes.append(h)
        starts.append(s + lo)
        lo = hi
    return np.concatenate(hashes), np.concatenate(starts)


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = _BYTE[_LOWER[data[~space]]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64)), starts


def shingle_sets(texts: list[bytes | None], size: int = 3) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending; a shorter text's words are one shingle."""
    sets: list[np.ndarray] = []
    whole = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
    hashes, starts = word_hashes(whole)
    bounds = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    cuts = np.searchsorted(starts, bounds)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        w = hashes[lo:hi]
        if not len(w):
            sets.append(np.empty(0, np.uint64))
            continue
        n = max(1, len(w) - size + 1)
        h = np.full(n, len(w) if len(w) < size else size, dtype=np.uint64)
        for k in range(min(size, len(w))):
            h = mix(h * _BASE + w[k : k + n])
        sets.append(np.unique(h))
    return sets
