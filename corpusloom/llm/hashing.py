"""Vector hashing of bytes, words and shingles with numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
_POWERS = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i up to ``n``; grown by doubling and kept."""
    if len(_POWERS[0]) <= n:
        size = 1 << (n + 1).bit_length()
        with np.errstate(over="ignore"):
            inverse = U(pow(int(BASE), -1, 2**64))
            for k, step in enumerate((BASE, inverse)):
                out = np.full(size, step, U)
                out[0] = 1
                _POWERS[k] = np.cumprod(out)
    return _POWERS[0][: n + 1], _POWERS[1][: n + 1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums S with S[b] - S[a] = BASE**a times the polynomial hash of data[a:b]."""
    out = np.zeros(len(data) + 1, U)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_CODE[data] * powers(len(data))[0][:-1], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), their lengths included."""
    with np.errstate(over="ignore"):
        raw = (sums[end] - sums[start]) * powers(len(sums) - 1)[1][start]
        return mix(raw ^ ((end - start).astype(U) * U(0xA0761D6478BD642F)))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[0x41:0x5B] += 32


def words(text: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with their byte starts and ends, A-Z lower-cased, cut at the bytes marked in ``breaks``."""
    data = LOWER_BYTES[np.frombuffer(text, np.uint8)]
    start, end = runs(~breaks[data])
    return span_hash(prefix_hash(data), start, end), start, end


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; fewer words make one shingle, none makes none."""
    if len(word_hashes) == 0:
        return np.zeros(0, U)
    size = min(size, len(word_hashes))
    n = len(word_hashes) - size + 1
    out = np.full(n, U(size))
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out * U(0x9FB21C651E98DF25) ^ word_hashes[k : k + n])
    return np.unique(out)


def chunks(texts, most_bytes: int = 1 << 20):
    """Join texts (bytes) with spaces into buffers of about ``most_bytes``: (numbers of the texts, buffer, text starts)."""
    held, start, at, first = [], [], 0, 0
    for k, t in enumerate(texts):
        if held and at + len(t) > most_bytes:
            yield np.arange(first, k), b" ".join(held), np.array(start)
            held, start, at, first = [], [], 0, k
        held.append(t)
        start.append(at)
        at += len(t) + 1
    if held:
        yield np.arange(first, first + len(held)), b" ".join(held), np.array(start)


def owners(text_starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Index of the text in which each place of a buffer lies."""
    return np.searchsorted(text_starts, places, side="right") - 1
