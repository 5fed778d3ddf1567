"""Anchors: content-defined positions that equal windows share.

Every window of ``span`` units (bytes or words) chooses one of its k-grams, the one of least hash,
the rightmost among equals.  Equal windows choose the same k-gram at the same offset, so windows
that repeat always meet at an equal anchor, and an anchor that occurs once rules out all windows
that chose it.  All work is in numpy over a batch of texts.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all 64 bits."""
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ x >> np.uint64(33)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    held = _POWERS.get(0)
    if held is None or len(held[0]) <= n:
        size = max(n + 1, 1 << 20)
        with np.errstate(over="ignore"):
            held = _POWERS[0] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size, b)]) for b in (_BASE, _INVERSE))
    return held[0][: n + 1], held[1][: n + 1]


def prefix_hash(units: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of 64-bit units, for ``slice_hash``; one longer than units."""
    return np.r_[np.uint64(0), np.cumsum(units * _powers(len(units))[0][: len(units)])]


def slice_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes of units[start:stop]."""
    return _mix((prefix[stop] - prefix[start]) * _powers(len(prefix))[1][start])


def word_units(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and 64-bit hashes of the words of a UTF-8 text (ASCII white space)."""
    raw = np.frombuffer(text, np.uint8)
    blank = np.r_[True, (raw == 32) | ((raw >= 9) & (raw <= 13)), True]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = edge[::2], edge[1::2]
    prefix = prefix_hash(raw.astype(np.uint64) + np.uint64(1))
    return starts, stops, _mix(slice_hash(prefix, starts, stops) + (stops - starts).astype(np.uint64))


def byte_units(text: bytes) -> np.ndarray:
    return _UNIT[np.frombuffer(text, np.uint8)]


_UNIT = _mix(np.arange(1, 257, dtype=np.uint64))


def anchors(units: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, positions, and the first and last window start that chose each.

    Positions ascend; each window start from 0 to len(units) - span belongs to one anchor.
    """
    n = len(units) - span + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    prefix = prefix_hash(units)
    at = np.arange(len(units) - k + 1)
    gram = slice_hash(prefix, at, at + k)
    reach = span - k + 1
    # Least hash of each run of `reach` grams by doubling, and where its rightmost copy stands.
    least, size = gram, 1
    place = at
    while size * 2 <= reach:
        least, place = _lesser(least[:-size], place[:-size], least[size:], place[size:])
        size *= 2
    if size < reach:
        rest = reach - size
        least, place = _lesser(least[: len(least) - rest], place[: len(place) - rest], least[rest:], place[rest:])
    edge = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    chosen = place[edge]
    return gram[chosen], chosen, edge, np.r_[edge[1:], n] - 1


def _lesser(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    right = b <= a
    return np.where(right, b, a), np.where(right, bt, at)
