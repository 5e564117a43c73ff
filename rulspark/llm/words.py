"""Words of many texts at once, as 64-bit hashes, without a Python step per word.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return. Its hash is a polynomial in an odd base over mixed byte values, taken
from prefix sums modulo 2**64 and mixed at the end; it depends on the bytes alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0xD6E8FEB86659FD93) + mix(second))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    fold = np.arange(256)
    fold[65:91] += 32
    return values, values[fold]


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse; the longest made so far is kept."""
    if n > len(_POWERS[0]):
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(n + n // 8, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of each range ``data[start:end]``; ``fold`` lower-cases A-Z first."""
    with np.errstate(over="ignore"):
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_tables()[1 if fold else 0][data] * up[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words in order of their place. ``text``: which text each belongs to; ``bounds``:
    where each text's words begin (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray
    bounds: np.ndarray


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word never crosses from one text into the next."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(len(data) + 1, np.bool_)
    edge[1:-1] = inside[1:] != inside[:-1]
    if len(data):
        edge[0], edge[-1] = inside[0], inside[-1]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    both = cut[inside[cut] & inside[cut - 1]] if len(cut) else cut
    places = np.flatnonzero(edge)
    if len(both):
        # An end and a start at the same place, where two texts meet inside a run.
        places = np.sort(np.concatenate([places, np.repeat(np.unique(both), 2)]))
    return places[0::2], places[1::2]


def words_of(data: np.ndarray, bounds: np.ndarray, fold: bool = True) -> Words:
    starts, ends = word_spans(data, bounds)
    hashes = range_hashes(data, starts, ends, fold)
    where = np.searchsorted(starts, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(where))
    return Words(starts, ends, hashes, text, where)
