"""Vectorised kernels on UTF-8 bytes: words, rolling hashes, winnowed anchors.

All hashes are 64-bit polynomial hashes modulo 2**64 over a table of random
odd byte codes, finished by a mixing step; those of long words and lines have a
second hash modulo a prime mixed in. Prefix sums make the hash of any
slice two look-ups. Everything works on a run of whole documents at a time.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_MOD = 1 << 64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, _MOD)
_UNIT_BASE = 0xD6E8FEB86659FD93
_UNIT_INV = pow(_UNIT_BASE, -1, _MOD)

#: The word separators of every contract: space and the control characters tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n (kept and grown as needed)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length()) if n else 1
        p = np.ones(size, np.uint64)
        m = 1
        while m < size:
            p[m:2 * m] = p[:m] * U(pow(base, m, _MOD))
            m *= 2
        if size > 1 << 25:
            return p[:n]
        _powers[base] = have = p
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher, so that all bits of a hash can be used."""
    h = h ^ (h >> U(32))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def prefix(codes: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums for :func:`slices`; element i covers codes[:i]."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(base, len(codes)), out=out[1:])
    return out


def slices(pre: np.ndarray, start: np.ndarray, end: np.ndarray, inv: int) -> np.ndarray:
    """Mixed hash of each slice [start, end) of the sequence behind ``pre``."""
    return mix((pre[end] - pre[start]) * powers(inv, len(pre))[start])


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the total) of all words; words end at documents' ends."""
    inside = ~SPACE[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    last = off[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off, side="left")


#: Slices of more bytes get a second hash, modulo a prime: modulo 2**64 there are long texts (Thue-Morse words of 1024
#: letters and more) that collide for every odd base.
LONG_SLICE = 256
_PRIME, _PRIME_BASE = (1 << 31) - 1, 1_181_783_497
_PRIME_INV = pow(_PRIME_BASE, -1, _PRIME)


def prime_powers(base: int, n: int) -> np.ndarray:
    p = np.ones(max(1, 1 << int(max(n - 1, 0)).bit_length()), np.uint64)
    m = 1
    while m < len(p):
        p[m:2 * m] = p[:m] * U(pow(base, m, _PRIME)) % U(_PRIME)
        m *= 2
    return p[:n]


def long_slices(h: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Slice hashes with a second, independent hash mixed in for long slices."""
    long_ = np.flatnonzero(end - start > LONG_SLICE)
    if not len(long_):
        return h
    pre = np.zeros(len(buf) + 1, np.uint64)
    codes = (LOWER_CODE if lower else BYTE_CODE)[buf] % U(_PRIME)
    np.cumsum(codes * prime_powers(_PRIME_BASE, len(buf)) % U(_PRIME), out=pre[1:])
    a, b = start[long_], end[long_]
    second = (pre[b] - pre[a]) % U(_PRIME) * prime_powers(_PRIME_INV, len(buf) + 1)[a] % U(_PRIME)
    out = h.copy()
    out[long_] = mix(out[long_] ^ mix(second + U(1)))
    return out


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    pre = prefix((LOWER_CODE if lower else BYTE_CODE)[buf], _BASE)
    return long_slices(slices(pre, starts, ends, _INV), buf, starts, ends, lower)


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    return prefix(BYTE_CODE[buf], _BASE)


def byte_slices(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return slices(pre, start, end, _INV)


def unit_prefix(units: np.ndarray) -> np.ndarray:
    return prefix(units, _UNIT_BASE)


def unit_slices(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return slices(pre, start, end, _UNIT_INV)


def all_grams(pre: np.ndarray, k: int, inv: int) -> np.ndarray:
    """Mixed hash of every k consecutive units."""
    n = len(pre) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((pre[k:] - pre[:-k]) * powers(inv, n))


def unit_grams(pre: np.ndarray, k: int) -> np.ndarray:
    return all_grams(pre, k, _UNIT_INV)


def byte_grams(pre: np.ndarray, k: int) -> np.ndarray:
    return all_grams(pre, k, _INV)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    span = 1
    while 2 * span <= w:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    rest = w - span
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def valid_windows(first: np.ndarray, m: int) -> np.ndarray:
    """For each unit: whether a window of m units that starts there ends in the same document."""
    n = int(first[-1])
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first[:-1], 1)
    np.add.at(step, np.maximum(first[:-1], first[1:] - m + 1), -1)
    return np.cumsum(step[:-1]) > 0


def anchors(grams: np.ndarray, first: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed anchors of windows of ``m`` units: (anchor, first window, last window).

    A window's anchor is the leftmost of its k-grams with the smallest hash,
    which depends on the window's content alone: equal windows have their
    anchors at equal places. Windows with one anchor are consecutive.
    """
    n = int(first[-1])
    none = np.zeros(0, np.int64)
    if n < m:
        return none, none, none
    bits = max(1, int(len(grams)).bit_length())
    low = U((1 << bits) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(packed, m - k + 1) & low).astype(np.int64)
    win = np.flatnonzero(valid_windows(first, m)[:len(at)])
    if not len(win):
        return none, none, none
    at = at[win]
    new = np.ones(len(win), bool)
    # the first window of a document starts a run of its own: anchors lie inside documents, so places differ
    new[1:] = at[1:] != at[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(win)) - 1
    return at[head], win[head], win[tail]


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenation of start[i] .. start[i] + count[i] - 1."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = count > 0
    s, c = start[keep], count[keep]
    ends = np.cumsum(c)
    out[0] = s[0]
    out[ends[:-1]] = s[1:] - s[:-1] - c[:-1] + 1
    return np.cumsum(out)


def group_min_max(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inverse, counts) of ``keys`` like numpy.unique, without the unique values."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    ids = np.cumsum(new) - 1
    inverse = np.empty(len(s), np.int64)
    inverse[order] = ids
    return inverse, np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
