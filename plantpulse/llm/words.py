"""Words of many texts at once: places in the bytes and hashes, as arrays.

Works on UTF-8 bytes, so separators must be ASCII. A word has two independent
64-bit hashes; operators that decide by hashes use both.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes hashed at once, so that the arrays stay in a processor's cache; longer words are hashed one by one.
HASHED = 1 << 18
LONG = 1 << 16
#: Seed of the byte values, odd multipliers of the two hashes and of the last mixing.
SEED = 20240607
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = 0xD6E8FEB86659FD93

_VALUES = np.random.default_rng(SEED).integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_POWERS = [np.cumprod(np.full(LONG, base, dtype=np.uint64)) for base in BASES]

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space behind each, and where each starts."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8), np.cumsum(sizes) - sizes


def places(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes that are `inside` (by byte value)."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    edges = np.diff(flags)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(MIX)
    values ^= values >> np.uint64(29)
    return values


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; `which` chooses one of two that are independent."""
    out = np.zeros(len(starts), dtype=np.uint64)
    sizes = ends - starts
    long = sizes > LONG
    if long.any():
        for n in np.flatnonzero(long):
            out[n] = xxhash.xxh3_64_intdigest(data[starts[n] : ends[n]].tobytes(), which)
        out[~long] = hashes(data, starts[~long], ends[~long], which)
        return out
    values, powers = _VALUES[which], _POWERS[which]
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + HASHED)))
        size = sizes[first:last]
        before = np.cumsum(size) - size
        offset = np.arange(before[-1] + size[-1]) - np.repeat(before, size)
        letters = data[np.repeat(starts[first:last], size) + offset]
        out[first:last] = np.add.reduceat(values[letters] * powers[offset], before)
        first = last
    return mixed(out ^ sizes.astype(np.uint64) * np.uint64(BASES[1 - which]))
