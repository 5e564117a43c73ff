"""An n-gram trie of Elias-Fano levels that can be memory-mapped.

Level one holds the words, as a rising sequence of 64-bit hashes. Level two holds, word after
word, the contexts a word was seen after: 32-bit numbers that rise within a word and are
stored relative to it, each word's range lifted by the last value of the range before, so
that the whole level rises. A third rising sequence points from words to their ranges. All
three are Elias-Fano coded; looking up a pair finds the word, reads its two pointers, and
searches the smallest context not below the wanted one inside that range. Probabilities are
16-bit steps of ``1 / STEPS`` of a base-10 logarithm.

All arrays lie in one buffer behind a small header, so a trie is read from a file map as it
is. Every look-up takes arrays of keys; the searches run over all of them at once.
"""

from __future__ import annotations

import mmap

import numpy as np

STEPS, OFFSET = 2_048, 16.0
# 64-bit words of a bit vector between two entries of its directory.
STRIDE = 8
ONE = np.uint64(1)


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((logs + OFFSET) * STEPS), 0, 65_535).astype(np.uint16)


def restored(levels: np.ndarray) -> np.ndarray:
    return levels.astype(np.float64) / STEPS - OFFSET


class Bits:
    """A bit vector with the number of ones before every ``STRIDE`` words."""

    def __init__(self, words: np.ndarray, ones: np.ndarray):
        self.words, self.ones = words, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * (64 * STRIDE) - ones.astype(np.int64)

    @staticmethod
    def parts(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and directory of a vector of ``size`` bits with ones at ``places``."""
        count = -(-max(size, 1) // (64 * STRIDE)) * STRIDE
        flags = np.zeros(count * 64, np.uint8)
        flags[places] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        each = np.bitwise_count(words).astype(np.int64).reshape(-1, STRIDE).sum(axis=1)
        return words, np.concatenate([[0], np.cumsum(each)]).astype(np.uint64)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero."""
        before = self.ones.astype(np.int64) if one else self.zeros
        block = np.searchsorted(before, k, side="right") - 1
        left = k - before[block]
        at = block * STRIDE
        flip = np.uint64(0) if one else ~np.uint64(0)
        found = np.zeros(len(k), bool)
        place = np.zeros(len(k), np.int64)
        chosen = np.zeros(len(k), np.uint64)
        last = len(self.words) - 1
        for i in range(STRIDE):
            word = self.words[np.minimum(at + i, last)] ^ flip
            n = np.bitwise_count(word).astype(np.int64)
            here = ~found & (left < n)
            chosen[here] = word[here]
            place[here] = (at[here] + i) * 64
            found |= here
            left = np.where(found, left, left - n)
        # Halve the word until the bit is alone.
        for width in (32, 16, 8, 4, 2, 1):
            low = chosen & np.uint64((1 << width) - 1)
            n = np.bitwise_count(low).astype(np.int64)
            up = left >= n
            left = np.where(up, left - n, left)
            place += np.where(up, width, 0)
            chosen = np.where(up, chosen >> np.uint64(width), low)
        return place


class EliasFano:
    """A rising sequence of integers: packed low bits and a unary vector of high parts."""

    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.low_bits, self.low = size, low_bits, low
        self.mask = np.uint64((1 << low_bits) - 1)
        self.high = Bits(high, ones)

    @staticmethod
    def parts(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        # One zero ends every value of the high part, up to the largest.
        words, ones = Bits.parts(high + np.arange(n), n + (top >> low_bits) + 2)
        return n, low_bits, _packed(values & np.uint64((1 << low_bits) - 1), low_bits), words, ones

    def lows(self, i: np.ndarray) -> np.ndarray:
        if self.low_bits == 0:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        value = self.low[word] >> shift
        spill = (shift + np.uint64(self.low_bits)) > np.uint64(64)
        over = self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63))
        return np.where(spill, value | over, value) & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self.high.select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self.lows(i)

    def successor(self, keys: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in [start, stop) of the first value not below each key (``stop`` if there is
        none), and whether it equals the key."""
        if not self.size or not len(keys):
            return stop.copy(), np.zeros(len(keys), bool)
        high = (keys >> np.uint64(self.low_bits)).astype(np.int64)
        # Keys above every value have no zero of their own.
        known = high <= int(self.size and self._top_high())
        part = np.where(known, high, 0)
        first = np.where(part > 0, self.high.select(np.maximum(part - 1, 0), False) - part + 1, 0)
        end = self.high.select(part, False) - part
        low = np.maximum(np.where(known, first, stop), start)
        limit = np.minimum(np.where(known, end, stop), stop)
        limit = np.maximum(limit, low)
        want = keys & self.mask
        a, b = low.copy(), limit.copy()
        while True:
            open_ = a < b
            if not open_.any():
                break
            middle = (a + b) >> 1
            smaller = open_ & (self.lows(np.minimum(middle, self.size - 1)) < want)
            a = np.where(smaller, middle + 1, a)
            b = np.where(open_ & ~smaller, middle, b)
        equal = (a < limit) & (self.lows(np.minimum(a, self.size - 1)) == want) & known
        return np.minimum(a, stop), equal

    def _top_high(self) -> int:
        if not hasattr(self, "_top"):
            last = np.array([self.size - 1])
            self._top = int(self.high.select(last, True)[0] - last[0])
        return self._top


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` in ``width`` bits each; one spare word at the end."""
    if width == 0 or not len(values):
        return np.zeros(2, np.uint64)
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    bit = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    np.bitwise_or.at(out, word, values << shift)
    spill = shift + np.uint64(width) > np.uint64(64)
    np.bitwise_or.at(out, word[spill] + 1, values[spill] >> (np.uint64(64) - shift[spill]))
    return out


class Trie:
    """Words, their contexts, and a number per word and per pair, over one buffer."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, np.int64, 20)
        self.arrays, at = [], 20 * 8
        for kind, size in zip(KINDS, head[:12]):
            self.arrays.append(np.frombuffer(buffer, kind, int(size), at))
            at += _padded(int(size) * np.dtype(kind).itemsize)
        sizes = head[12:18]
        a = self.arrays
        self.words = EliasFano(int(sizes[0]), int(sizes[1]), a[0], a[1], a[2])
        self.pointers = EliasFano(int(sizes[2]), int(sizes[3]), a[3], a[4], a[5])
        self.contexts = EliasFano(int(sizes[4]), int(sizes[5]), a[6], a[7], a[8])
        self.counts, self.word_logs, self.pair_logs = a[9], a[10], a[11]

    @staticmethod
    def build(words: np.ndarray, counts: np.ndarray, word_logs: np.ndarray, owners: np.ndarray, contexts: np.ndarray, pair_logs: np.ndarray) -> bytes:
        """``words`` rise; pairs come by word (``owners``: its place) and rising context."""
        ends = np.cumsum(np.bincount(owners, minlength=len(words))) if len(words) else np.zeros(0, np.int64)
        pointers = np.concatenate([[0], ends])
        lift = _lifts(pointers, contexts)
        lifted = contexts.astype(np.uint64) + np.repeat(lift, np.diff(pointers))
        parts, sizes = [], []
        for values in (words, pointers, lifted):
            n, low_bits, low, high, ones = EliasFano.parts(values)
            parts += [low, high, ones]
            sizes += [n, low_bits]
        parts += [counts, quantised(word_logs), quantised(pair_logs)]
        parts = [np.ascontiguousarray(p, dtype=k) for p, k in zip(parts, KINDS)]
        head = np.zeros(20, np.int64)
        head[:12] = [len(p) for p in parts]
        head[12:18] = sizes
        out = [head.tobytes()]
        for p in parts:
            raw = p.tobytes()
            out += [raw, bytes(_padded(len(raw)) - len(raw))]
        return b"".join(out)

    def find_words(self, words: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is not there."""
        n = np.full(len(words), self.words.size)
        at, equal = self.words.successor(words, np.zeros(len(words), np.int64), n)
        return np.where(equal, at, -1)

    def find_pairs(self, at: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Place of each context in the range of the word at ``at``, -1 where it is not there."""
        if not self.contexts.size or not len(at):
            return np.full(len(at), -1)
        word = np.maximum(at, 0)
        start, stop = self.pointers.get(word).astype(np.int64), self.pointers.get(word + 1).astype(np.int64)
        # A range is lifted by the last stored value before it.
        lift = np.where(start > 0, self.contexts.get(np.maximum(start - 1, 0)), np.uint64(0))
        place, equal = self.contexts.successor(contexts.astype(np.uint64) + lift, start, stop)
        return np.where(equal & (at >= 0), place, -1)


KINDS = (
    np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64, np.uint64,
    np.int64, np.uint16, np.uint16,
)


def _padded(size: int) -> int:
    return -(-size // 8) * 8


def _lifts(pointers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """What each range is lifted by: the sum of the last contexts of the ranges before it."""
    stops, some = pointers[1:], np.diff(pointers) > 0
    last = np.zeros(len(stops), np.uint64)
    last[some] = contexts[stops[some] - 1].astype(np.uint64)
    total = np.cumsum(last)
    return np.concatenate([np.zeros(1, np.uint64), total[:-1]]) if len(last) else last


def mapped(raw: bytes) -> Trie:
    """A trie over an anonymous memory map; a file map serves as well."""
    area = mmap.mmap(-1, max(len(raw), 1))
    area[: len(raw)] = raw
    return Trie(area)
