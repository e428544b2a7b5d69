"""Prefix polynomial hashes over numpy arrays, and minimiser segments of windows."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BITS = 21
#: Units hashed at once; positions have to fit the low bits of a packed key.
MOST_UNITS = 1 << 20
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking word for each byte value.
BYTE_WORDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below ``n``."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["up"], _powers["down"]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums ``H`` with which any range is hashed by ``range_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[1][: len(values)], out=out[1:])
    return out


def range_hash(h: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    """Hash of the ``size`` units from each ``start``; equal ranges hash alike."""
    return (h[start + size] - h[start]) * powers(len(h))[0][start]


def all_ranges(h: np.ndarray, size: int) -> np.ndarray:
    """``range_hash`` of every start."""
    n = len(h) - size
    return (h[size:] - h[:n]) * powers(len(h))[0][:n]


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    return np.minimum(a[: len(a) - (width - have)], a[width - have :]) if have < width else a


def pieces(begins: np.ndarray, ends: np.ndarray, window: int, most: int | None = None):
    """Groups of (number, first unit, end unit) with at most ``most`` units each.

    ``begins`` and ``ends`` are unit offsets. A longer stretch is cut into pieces
    that overlap by ``window - 1`` units, so each window lies in one piece.
    """
    most = most or MOST_UNITS
    group, size = [], 0
    for i, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        while end - begin >= window:
            stop = min(end, begin + most)
            if size + stop - begin > most and group:
                yield group
                group, size = [], 0
            group.append((i, begin, stop))
            size += stop - begin
            if stop == end:
                break
            begin = stop - window + 1
    if group:
        yield group


def segments(values: np.ndarray, sizes: np.ndarray, window: int, gram: int):
    """Runs of consecutive windows that share their minimiser.

    ``values`` are the units of several texts laid end to end, ``sizes`` their
    lengths. The minimiser of a window is its ``gram`` with the least hash, the
    leftmost of equals, so equal windows have equal minimisers at equal places.
    Returns for each run: first window start, number of windows, place of the
    minimiser and its hash.
    """
    n, width = len(values), window - gram + 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, np.zeros(0, np.uint64)
    grams = mix(all_ranges(prefix(values), gram))
    low = np.uint64((1 << _BITS) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(packed, width) & low).astype(np.int64)
    last = np.repeat(np.cumsum(sizes), sizes)[: len(least)]
    valid = np.flatnonzero(np.arange(window, window + len(least)) <= last)
    if not len(valid):
        return none, none, none, np.zeros(0, np.uint64)
    at = least[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (at[1:] != at[:-1]) | (np.diff(valid) != 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(valid)))
    return valid[first], count, at[first], grams[at[first]]
