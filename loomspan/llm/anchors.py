"""Anchors: sampled suffixes such that every window of `span` bytes owns exactly one.

The anchor of a window is the leftmost position in it whose next `GRAM` bytes have the smallest hash. It depends
on nothing but the window's bytes, so equal windows own anchors at the same place. Neighbouring windows mostly
share an anchor; a maximal run of windows of one document with one anchor is a stretch.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

SPAN, GRAM = 50, 24
#: Window starts worked on at once; positions inside a block fit the low bits of a key.
BLOCK, POSITION_BITS = 1 << 17, 18
_RANDOM = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = {n: np.uint64(pow(_BASE, n, 1 << 64)) for n in (1, 2, 4, 8, 16)}
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(_BASE)
    x ^= x >> np.uint64(32)
    return x


class Stretches(NamedTuple):
    """Runs of windows: document index, first and last window start and the anchor (in the batch), two hashes."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    whole: np.ndarray


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unmixed hashes of the GRAM and of the 32 bytes from each position."""
    h = _RANDOM[data]
    n = {1: h}
    for k in (1, 2, 4, 8):
        n[2 * k] = n[k][:-k] * _POWERS[k] + n[k][k:]
    size = len(n[16])
    gram = n[16][: size - 8] * _POWERS[8] + n[8][16:]
    wide = n[16][:-16] * _POWERS[16] + n[16][16:]
    return gram, wide


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    return np.minimum(key[: len(key) - (width - done)], key[width - done :]) if done < width else key


def _blocks(data: np.ndarray, offsets: np.ndarray):
    """Blocks of window starts: first start, document of each start, whether its window fits into it, hashes."""
    for at in range(0, max(len(data) - SPAN + 1, 0), BLOCK):
        end = min(at + BLOCK, len(data) - SPAN + 1)
        starts = np.arange(at, end)
        lo, hi = np.searchsorted(offsets, [at, end - 1], "right") - 1
        inner = offsets[lo + 1 : hi + 1]
        doc = lo + np.cumsum(np.bincount(inner - at, minlength=end - at)[: end - at]) if len(inner) else np.full(end - at, lo)
        valid = starts + SPAN <= offsets[doc + 1]
        yield at, end, doc, valid, _grams(data[at : end + SPAN - 1])


def stretches(data: np.ndarray, offsets: np.ndarray) -> Stretches:
    """All stretches of a batch of documents laid end to end."""
    parts = []
    mask = np.uint64((1 << POSITION_BITS) - 1)
    for at, end, doc, valid, (gram, wide) in _blocks(data, offsets):
        key = (mix(gram) & ~mask) | np.arange(len(gram), dtype=np.uint64)
        place = _smallest(key, SPAN - GRAM + 1)[: end - at] & mask
        turn = np.empty(end - at, bool)
        turn[0] = True
        turn[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(turn)
        last = np.append(first[1:], end - at) - 1
        ok = valid[first]
        first, last = first[ok], last[ok]
        p = place[first].astype(np.int64)
        stop = last + SPAN - 32
        size = (last - first).astype(np.uint64) * np.uint64(64) + (p - first).astype(np.uint64)
        whole = mix(mix(mix(wide[first] + size) + wide[(first + stop) // 2]) + wide[stop])
        parts.append((doc[first], first + at, last + at, p + at, mix(gram[p] + np.uint64(1)), whole))
    if not parts:
        return Stretches(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)))
    return Stretches(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def window_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows at the given ascending starts."""
    out = np.empty(len(starts), np.uint64)
    for at in range(0, max(len(data) - SPAN + 1, 0), BLOCK):
        end = min(at + BLOCK, len(data) - SPAN + 1)
        lo, hi = np.searchsorted(starts, [at, end])
        if hi > lo:
            _, wide = _grams(data[at : end + SPAN - 1])
            s = starts[lo:hi] - at
            out[lo:hi] = mix(mix(wide[s]) + wide[s + SPAN - 32])
    return out
