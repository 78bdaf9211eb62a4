"""Word hashes, minimisers and window digests of a text, for the substring dedup."""

from __future__ import annotations

import numpy as np
import xxhash

#: An odd multiplier and its inverse modulo 2**64, for prefix sums that give the hash of any stretch.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SEEDS = (0, 1)

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, seed) for w in words], dtype=np.uint64)


def prefix_sums(hashes: np.ndarray) -> np.ndarray:
    """Sums of the hashes times the powers of BASE, with a 0 in front."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _power_table(BASE, len(hashes)), out=sums[1:])
    return sums


def stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of the words from each start to before each end."""
    return mixed((sums[ends] - sums[starts]) * _power_table(INVERSE, len(sums))[starts])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by minima to both sides of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def super_kmers(words: list[bytes], window: int, m: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows that share a minimiser, the smallest hash of ``m`` words in
    the window: minimiser, first window, number of windows, and two digests of the words."""
    sums = prefix_sums(word_hashes(words, 0))
    at = np.arange(len(words) - m + 1)
    smallest = sliding_minimum(stretches(sums, at, at + m), window - m + 1)
    starts = np.concatenate(([0], np.flatnonzero(smallest[1:] != smallest[:-1]) + 1))
    counts = np.diff(np.concatenate((starts, [len(smallest)])))
    return smallest[starts], starts, counts, *byte_digests(words, starts, starts + counts + window - 1)


def byte_digests(words: list[bytes], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The halves of a 128-bit hash of the bytes of each stretch of words. Sums of powers are not
    enough for long ones: modulo a power of two, different sequences of 1,024 words can agree for
    every multiplier."""
    joined = b" ".join(words)
    begin = np.cumsum([0, *(len(w) + 1 for w in words)])
    digest = xxhash.xxh3_128_digest
    found = b"".join([digest(joined[a:b]) for a, b in zip(begin[starts].tolist(), (begin[ends] - 1).tolist())])
    halves = np.frombuffer(found, dtype=np.uint64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


#: Words of a window up to which sums of powers tell its words apart.
SHORT = 64


def window_digests(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each window."""
    at = np.arange(len(words) - window + 1)
    if window > SHORT:
        return byte_digests(words, at, at + window)
    return tuple(stretches(prefix_sums(word_hashes(words, seed)), at, at + window) for seed in SEEDS)
