"""Vectorised word and byte n-gram hashes over batches of texts, for use inside Spark tasks."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept for the largest n so far up to 8M."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        if size <= 1 << 23:
            _powers.clear()
            _powers[size] = np.cumprod(up), np.cumprod(down)
        else:
            return np.cumprod(up), np.cumprod(down)
    return _powers[size]


def words(text: bytes | bytearray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word of ``text``: runs of ASCII letters and digits and of other
    non-ASCII characters than spaces and punctuation.  A-Z count as a-z."""
    raw = LOWER[np.frombuffer(text, np.uint8)]
    if not len(raw):
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty
    is_word = WORD_BYTE[raw]
    # U+0080-U+00BF (C2 xx) and U+2000-U+206F (E2 80, E2 81): spaces and punctuation.
    two = np.flatnonzero((raw[:-1] == 0xC2) & (raw[1:] < 0xC0))
    is_word[two] = is_word[two + 1] = False
    three = np.flatnonzero((raw[:-2] == 0xE2) & ((raw[1:-1] == 0x80) | (raw[1:-1] == 0x81)))
    for k in range(3):
        is_word[three + k] = False
    edge = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=0, append=0))
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(up[:len(raw)] * (raw.astype(np.uint64) + np.uint64(1)), out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts]), starts, ends


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * BASE + word_hashes[i:i + n]
    return mixed(out)


def chunks(texts: list[bytes], size: int = 2 << 20) -> list[tuple[int, int]]:
    """(first, last) runs of texts of about ``size`` bytes together."""
    out, first, held = [], 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            out.append((first, i))
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        out.append((first, len(texts)))
    return out
