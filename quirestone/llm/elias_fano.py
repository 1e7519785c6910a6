"""Elias-Fano coded monotone sequences, and runs of successors with pointers to them, that are searched where they lie, in memory-mapped files."""

from __future__ import annotations

import numpy as np

_HEAD = 6  # n, bits of a low part, first key, bytes of low parts, words of the high part, check
_MAGIC = 0x51F0
_U = np.uint64
_EACH, _TOP = _U(0x0101010101010101), _U(0x8080808080808080)
#: Place of the r-th one of a byte, at [r, byte] (8 where it has fewer).
_IN_BYTE = np.full((8, 256), 8, np.int64)
for _byte in range(256):
    for _r, _place in enumerate(i for i in range(8) if _byte >> i & 1):
        _IN_BYTE[_r, _byte] = _place
_IN_BYTE = _IN_BYTE.ravel()


def select_in_word(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each 64-bit word: byte sums side by side, then a table."""
    with np.errstate(over="ignore"):
        s = x - ((x >> _U(1)) & _U(0x5555555555555555))
        s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
        sums = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _EACH
        r = r.astype(np.uint64)
        place = np.bitwise_count(((r * _EACH | _TOP) - sums) & _TOP).astype(np.uint64) * _U(8)
        rest = r - (((sums << _U(8)) >> place) & _U(0xFF))
    return place.astype(np.int64) + _IN_BYTE[(rest << _U(8) | ((x >> place) & _U(0xFF))).astype(np.int64)]


def _lowest(x: np.ndarray) -> np.ndarray:
    """Place of the lowest one of each word that isn't 0."""
    return np.bitwise_count((x & (~x + _U(1))) - _U(1)).astype(np.int64)


def encode(keys: np.ndarray) -> bytes:
    """An ascending array of non-negative int64 keys as bytes; those that are searched with ``find`` must differ."""
    n = len(keys)
    first = int(keys[0]) if n else 0
    rest = (keys - first).astype(np.uint64)
    most = int(rest[-1]) + 1 if n else 1
    low_bits = max(0, (most // max(n, 1)).bit_length() - 1)
    high = (rest >> np.uint64(low_bits)).astype(np.int64)
    places = high + np.arange(n)
    bits = np.zeros(-(-(int(places[-1]) + 2 if n else 1) // 64) * 64, np.uint8)  # at least one zero after the last key
    bits[places] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    parts = []
    if low_bits:
        mask, shifts = np.uint64((1 << low_bits) - 1), np.arange(low_bits, dtype=np.uint64)
        for lo in range(0, n, 1 << 16):
            v = rest[lo : lo + (1 << 16)] & mask
            parts.append(np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes())
    low = b"".join(parts)
    low += bytes(-len(low) % 8 + 16)
    zeros = (np.concatenate([[0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))])).astype("<u4")
    head = np.array([n, low_bits, first, len(low), len(words), _MAGIC], "<i8")
    return b"".join([head.tobytes(), low, words.tobytes(), zeros.tobytes()])


class Sequence:
    """A coded sequence over a buffer (bytes or a memory map)."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, "<i8", _HEAD)
        if head[5] != _MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        self.n, self.low_bits, self.first, low, words = (int(x) for x in head[:5])
        at = 8 * _HEAD
        self.low = np.ndarray((low - 8,), "<u8", buffer, at, (1,))  # 8 bytes from every byte on
        self.high = np.frombuffer(buffer, "<u8", words, at + low)
        self.zeros = np.frombuffer(buffer, "<u4", words + 1, at + low + 8 * words)
        self.most_high = words * 64 - self.n
        self.ones = np.arange(words + 1, dtype=np.int64) * 64 - self.zeros

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        return (self.low[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the high part."""
        w = np.searchsorted(self.zeros, k.astype(np.uint32), "right") - 1
        return w * 64 + select_in_word(~self.high[w], k - self.zeros[w])

    def _select_one(self, i: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.ones, i, "right") - 1
        return w * 64 + select_in_word(self.high[w], i - self.ones[w])

    def _after(self, place: np.ndarray, zero: bool) -> tuple[np.ndarray, np.ndarray]:
        """The first zero (or one) at or after each place, and whether it is in the same word (else it isn't looked for)."""
        w = np.minimum(place >> 6, len(self.high) - 1)
        x = (~self.high[w] if zero else self.high[w]) >> (place & 63).astype(np.uint64)
        here = (x != 0) & (place >> 6 == w)
        return place + np.where(here, _lowest(x), 0), here

    def _key(self, place: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (((place - i) << self.low_bits) | self._low(i).astype(np.int64)) + self.first

    def at(self, i: np.ndarray) -> np.ndarray:
        """The keys at places ``i``."""
        return self._key(self._select_one(i), i)

    def at_both(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys at ``i`` and at ``i + 1``, whose one is mostly in the same word."""
        place = self._select_one(i)
        then, here = self._after(place + 1, False)
        far = np.flatnonzero(~here)
        then[far] = self._select_one(i[far] + 1)
        return self._key(place, i), self._key(then, i + 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n:
            return out
        rest = keys.astype(np.int64) - self.first
        high = np.where(rest >= 0, rest >> self.low_bits, -1)
        act = np.flatnonzero((rest >= 0) & (high < self.most_high))
        if not len(act):
            return out
        h = high[act]
        want = rest[act].astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        begin = np.zeros(len(act), np.int64)  # the bucket's keys: ones between two zeros
        later = np.flatnonzero(h > 0)
        begin[later] = self._select_zero(h[later] - 1) + 1
        close, here = self._after(begin, True)
        far = np.flatnonzero(~here)
        close[far] = self._select_zero(h[far])
        lo, hi = begin - h, close - h
        end = hi.copy()
        while True:  # successors of a context fill whole buckets, so they are halved, not walked
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        there = np.flatnonzero(lo < end)
        hit = there[self._low(lo[there]) == want[there]]
        out[act[hit]] = lo[hit]
        return out


def encode_runs(context: np.ndarray, word: np.ndarray) -> bytes:
    """Successors of contexts, sorted by both: a monotone pointer to the first successor of every context from the first
    to the last one, then the successors' ids, each run raised above the one before so that all ascend."""
    first = int(context[0])
    starts = np.searchsorted(context, np.arange(first, int(context[-1]) + 2))
    opens = np.concatenate([[0], np.flatnonzero(np.diff(context)) + 1])
    spans = word[opens[1:] - 1] + 1  # of every run but the last
    raised = word + np.repeat(np.concatenate([[0], np.cumsum(spans)]), np.diff(np.append(opens, len(word))))
    pointers = encode(starts)
    pointers += bytes(-len(pointers) % 8)
    return np.array([first, len(starts) - 1, len(pointers)], "<i8").tobytes() + pointers + encode(raised)


class Runs:
    """Coded successors over a buffer; ``find`` looks for a word inside its context's run."""

    def __init__(self, buffer):
        self.first, self.contexts, size = (int(x) for x in np.frombuffer(buffer, "<i8", 3))
        data = np.frombuffer(buffer, np.uint8)
        self.pointers, self.words = Sequence(data[24 : 24 + size]), Sequence(data[24 + size :])

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each pair, or -1."""
        out = np.full(len(word), -1, np.int64)
        if self.contexts == 1:
            at = np.flatnonzero(context == self.first)
            out[at] = self.words.find(word[at])
            return out
        c = context - self.first
        at = np.flatnonzero((c >= 0) & (c < self.contexts))
        c = c[at]
        opens = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else at  # words of one context mostly come together: its pointers are read once
        begin, end = self.pointers.at_both(c[opens])
        base = np.zeros(len(opens), np.int64)  # a run begins above the last successor of the run before
        later = (begin > 0) & (begin < end)
        base[later] = self.words.at(begin[later] - 1) + 1
        begin, end, base = (np.repeat(x, np.diff(np.append(opens, len(c)))) for x in (begin, end, base))
        some = begin < end
        at, begin, end = at[some], begin[some], end[some]
        place = self.words.find(base[some] + word[at])
        out[at] = np.where((place >= begin) & (place < end), place, -1)
        return out
