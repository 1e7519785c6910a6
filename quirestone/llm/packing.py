"""Packing documents into sequences by minimum bin slack.

Each document is encoded whole, gets its end id, and gives as many full windows as it fills; the rest is
an item. A task keeps a bounded pool of items. For each window it seeds with the longest item and fills
what is left with the multiset of lengths whose sum comes closest: a subset-sum dynamic programme over
the pool's length counts, kept as a bitset (one Python integer; bit s = sum s can be reached), with
counts split in powers of two and the choice backtracked through the layers. A window that can't be
filled exactly waits for more items. At a task's end the windows that still wait are closed at their
least slack, which the start of one more item fills; the last one is cut at powers of two, which need no
padding.

Nothing is shuffled: a scan's partitions are packed where they are read, and a lost task is simply
repeated on the same rows with the same result. Memory: ``pool`` items of less than a window.

Defined cases: null or empty text is the end id alone; rows that repeat are separate documents; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import even, long_ids, texts_by_id
from .encoding import encoder

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length come closest to ``room`` without exceeding it; ``lengths`` ascend."""
    mask = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for i in range(bisect_left(lengths, room + 1) - 1, -1, -1):
        length = lengths[i]
        left, times = counts[length], 1
        while left > 0 and length * times <= room:
            take = min(times, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


class Pool:
    """Items by length; ``windows(final)`` yields lists of items that fill a window exactly."""

    def __init__(self, window: int):
        self.window = window
        self.items: dict[int, list] = {}
        self.lengths: list[int] = []
        self.size = 0

    def add(self, length: int, item) -> None:
        if length not in self.items:
            self.items[length] = []
            insort(self.lengths, length)
        self.items[length].append(item)
        self.size += 1

    def take(self, length: int):
        have = self.items[length]
        item = have.pop()
        if not have:
            del self.items[length]
            self.lengths.pop(bisect_left(self.lengths, length))
        self.size -= 1
        return item

    def windows(self, keep: int, close: bool = False) -> Iterator[list]:
        """Fill windows, longest seeds first, while over ``keep`` items are there.

        A window that no multiset fills exactly waits. With ``close`` it is closed at its least slack, and what is
        still free takes the start of the shortest item left, which is longer, or the fill weren't the best.
        A window that has taken all items and isn't full is given last."""
        skipped = []
        while self.size > keep and self.lengths:
            seed_length = self.lengths[-1]
            seed = self.take(seed_length)
            used = best_fill(self.lengths, {k: len(v) for k, v in self.items.items()} if self.size < 64 else _Counts(self.items), self.window - seed_length)
            slack = self.window - seed_length - sum(k * n for k, n in used.items())
            if slack and not close:
                skipped.append((seed_length, seed))
                continue
            window = [seed, *(self.take(k) for k, n in used.items() for _ in range(n))]
            if slack and self.size:
                length = self.lengths[0]
                doc_id, start, ids, total = self.take(length)
                window.append((doc_id, start, ids[: 4 * slack], total))
                self.add(length - slack, (doc_id, start + slack, ids[4 * slack :], total))
            yield window
        for length, seed in skipped:
            self.add(length, seed)


class _Counts:
    """Lengths of the lists of a dict, without a copy."""

    def __init__(self, items: dict[int, list]):
        self.items = items

    def __getitem__(self, length: int) -> int:
        return len(self.items[length])


def pieces(docs: Iterator[tuple[object, bytes]], window: int = 2048, pool_size: int = 4096) -> Iterator[tuple]:
    """(doc_id, start, ids as bytes, doc_tokens, sequence, offset) for documents of (doc_id, ids as bytes)."""
    wide, pool, sequence = 4 * window, Pool(window), 0

    def laid(items, sequence):
        offset = 0
        for doc_id, start, ids, total in items:
            yield doc_id, start, ids, total, sequence, offset
            offset += len(ids) // 4

    for doc_id, ids in docs:
        total = len(ids) // 4
        at = 0
        while len(ids) - at >= wide:
            yield doc_id, at // 4, ids[at : at + wide], total, sequence, 0
            sequence += 1
            at += wide
        if at < len(ids):
            pool.add((len(ids) - at) // 4, (doc_id, at // 4, ids[at:], total))
        if pool.size >= pool_size:
            for items in pool.windows(pool_size // 2):
                yield from laid(items, sequence)
                sequence += 1
    rest: list = []
    for items in pool.windows(0, close=True):
        left = sum(len(x[2]) for x in items) // 4
        if left < window:
            rest = items
        else:
            yield from laid(items, sequence)
            sequence += 1
    left = sum(len(x[2]) for x in rest) // 4
    room, offset = 0, 0
    for doc_id, start, ids, total in rest:
        while ids:
            if not room:
                room, offset = 1 << (left.bit_length() - 1), 0
                left -= room
            n = min(room, len(ids) // 4)
            yield doc_id, start, ids[: 4 * n], total, sequence, offset
            ids, start, room, offset = ids[4 * n :], start + n, room - n, offset + n
            sequence += not room


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = 2048) -> DataFrame:
    """One row for each piece; ``sequence_id`` holds the partition in its upper bits."""
    end = end_id.to_bytes(4, "little")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, base = encoder(path), TaskContext.get().partitionId() << 40

        def encoded():
            for pdf in batches:
                ids = enc.batch([t or "" for t in pdf["text"]])
                yield from zip(pdf["doc_id"], (x + end for x in ids))

        rows = []
        for doc_id, start, ids, total, sequence, offset in pieces(encoded(), window):
            rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, base + sequence, offset))
            if len(rows) >= 20_000:
                yield pd.DataFrame(rows, columns=COLUMNS)
                rows = []
        yield pd.DataFrame(rows, columns=COLUMNS)

    return long_ids(even(texts_by_id(docs)).mapInPandas(work, SCHEMA))
