"""Words and hashes of many texts at once, as numpy arrays.

All hashes depend on the bytes alone, never on where a text lies in its batch, so
they are the same in every task.
"""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_LONG = 4096  # a word of more bytes is hashed on its own
_BLOCK = 1 << 20
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int) -> np.ndarray:
    factors = np.full(_BLOCK + 1, base, U)
    factors[0] = 1
    return np.cumprod(factors)


_POWER = _powers(_BASE)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with a line break after each text, and where each text starts."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return buf, np.concatenate([[0], np.cumsum(sizes)])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes outside ``SPACE``; the last byte is a space."""
    inside = ~SPACE[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, base + _BLOCK - _LONG)))
        stop = min(int(ends[j - 1]), base + _BLOCK)
        sums = np.empty(stop - base + 1, U)
        sums[0] = 0
        np.cumsum(_BYTE[buf[base:stop]] * _POWER[: stop - base], out=sums[1:])
        s, e = starts[i:j] - base, np.minimum(ends[i:j], stop) - base
        out[i:j] = (sums[e] - sums[s]) * _INVERSE[s]
        i = j
    out = mix(out)
    for k in np.flatnonzero(ends - starts > _LONG):
        out[k] = xxhash.xxh3_64_intdigest(buf[starts[k] : ends[k]].tobytes())
    return out


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's words begin among all words (one more entry at the end)."""
    return np.searchsorted(starts, offsets)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two neighbouring hashes, in order."""
    return mix(a * U(0xD6E8FEB86659FD93) + (b ^ U(0xA5A5A5A5A5A5A5A5)))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive entries (``len - k + 1`` of them)."""
    if len(words) < k:
        return np.empty(0, U)
    power, width, whole, done = words, 1, None, 0
    while True:
        if k & width:
            n = len(words) - done - width + 1
            whole = power[:n] if whole is None else pair(whole[:n], power[done : done + n])
            done += width
        if done == k:
            return whole
        power = pair(power[:-width], power[width:])
        width *= 2


def leftmost_minimum(values: np.ndarray, k: int) -> np.ndarray:
    """Position of the first smallest among every ``k`` consecutive values."""
    best = np.arange(len(values))
    width = 1
    while width < k:
        step = min(width, k - width)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        width += step
    return best


def bit_counts(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each group of hashes, how many have each of the 64 bits set.

    Group ``i`` is ``hashes[offsets[i]:offsets[i + 1]]``; none is empty. Eight lanes
    of a byte are counted at once, over runs of at most 255 hashes.
    """
    sizes = np.diff(offsets)
    runs = -(-sizes // 255)
    first = np.concatenate([[0], np.cumsum(runs)])
    where = np.repeat(offsets[:-1], runs) + 255 * (
        np.arange(first[-1]) - np.repeat(first[:-1], runs)
    )
    out = np.empty((len(sizes), 8, 8), np.int64)
    for bit in range(8):
        lanes = (hashes >> U(bit)) & U(0x0101010101010101)
        parts = np.add.reduceat(lanes, where).view(np.uint8).reshape(-1, 8)
        out[:, :, bit] = np.add.reduceat(parts.astype(np.int64), first[:-1], axis=0)
    return out.reshape(len(sizes), 64)


def packed_bits(flags: np.ndarray) -> np.ndarray:
    """Rows of 64 flags, bit 0 first, as unsigned 64-bit values."""
    return np.packbits(flags, axis=1, bitorder="little").view(U).reshape(-1)
