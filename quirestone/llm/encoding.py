"""Whole-text encoding with the tokenizers library, through a bounded cache of text chunks.

A text is cut where no pre-token of the vocabularies used here can cross, so that the ids of the chunks,
in order, are the ids of the text; each different chunk is encoded by the library once and cached.

* Texts of ASCII and Latin letters are cut before white space and between letters and other characters
  (an apostrophe keeps the letters after it: contractions are pre-tokens).
* Texts with other characters are cut only before ASCII white space that follows something else.
* Texts with other white space, control characters, combining marks or ``<|`` are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections import Counter, deque

import numpy as np
import xxhash

from .common import only_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LITTLE = sys.byteorder == "little" and array("I").itemsize == 4

_W, _L = r" \t\n\r\x0b\x0c", "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
COARSE = re.compile(f"[{_W}]*[^{_W}]+|[{_W}]+")
FINE = re.compile(f"[{_W}]*[{_L}]+|[{_W}]*[^{_L}{_W}]+(?:(?<=')[{_L}]+)?|[{_W}]+")
#: The same without the white space, for vocabularies that drop it.
FINE_DROPPED = re.compile(f"[{_L}]+|[^{_L}{_W}]+(?:(?<=')[{_L}]+)?")
#: Bytes of ASCII text and of the letters U+00C0 to U+023F in UTF-8: a text without others is fine.
FINE_BYTES = bytes([*range(0x20, 0x7F), *b"\t\n\r\x0b\x0c", *range(0x80, 0xC0), *range(0xC3, 0xC9)])
UNSURE = re.compile("[^\\S \\t\\n\\r\\x0b\\x0c]|[\x00-\x08\x0e-\x1f\x7f-\x9f\u0300-\u036f\u200b-\u200f\ufeff]|<\\|")


#: Texts on which the cuts are tried when a vocabulary is loaded.
PROBES = ("It's we'LL 12.5%, (a-b) x_1  two\n\n\tNaïve Café's don't? ...!! \r\n end ", "漢字 «ёлка» — x½5 1,000 it's\n The  the THE tHe", "a" * 30 + " 1234567890 http://a.b/c?d=e&f")

#: Chunks that are encoded in one go, with line breaks between; or with a mark, for vocabularies that drop white space. Texts with control characters aren't cut, so no chunk has it.
TOGETHER, MARK = 4096, " \x01 "

#: Entries of the small table, and how many chunks are counted to choose them.
COMMON, COMMON_FROM = 12_000, 600_000


_U = np.uint64
#: Keeps the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Bytes from which on a span is hashed alone.
LONG = 64
#: Characters of texts that are cut into chunks side by side (a longer text is cut whole).
SIDE_BY_SIDE = 4_000_000
#: Bytes of white space (0), of letters (1), and others (2), in fine texts.
_KIND = np.full(256, 2, np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """The numbers, each mapped to another one, with every bit spread over all."""
    for shift, by in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> _U(shift))) * _U(by)
    return x ^ (x >> _U(32))


def span_hashes(data: bytes, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of ``data``, which ends with 8 more bytes: side by side, eight bytes at a time."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # 8 bytes from every byte on
    h = _mixed((eight[starts] & _FIRST[np.minimum(size, 8)]) + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    for at in range(8, LONG, 8):
        more = np.flatnonzero((size > at) & (size < LONG))
        if not len(more):
            break
        h[more] = _mixed((h[more] * _U(0x94D049BB133111EB)) ^ (eight[starts[more] + at] & _FIRST[np.minimum(size[more] - at, 8)]))
    for i in np.flatnonzero(size >= LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + size[i]])
    return h


def fine_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what ``FINE_DROPPED`` finds in lower-cased fine text that begins and ends with white space."""
    b = np.frombuffer(data, np.uint8)
    kind = _KIND[b]
    if b"\xc3\x97" in data or b"\xc3\xb7" in data:  # the signs of multiplication and division
        at = np.flatnonzero((b[:-1] == 0xC3) & ((b[1:] == 0x97) | (b[1:] == 0xB7)))
        kind[at] = kind[at + 1] = 2
    opens = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    kinds, ends = kind[opens], np.append(opens[1:], len(data))
    glued = np.flatnonzero((kinds[1:] == 1) & (kinds[:-1] == 2) & (b[opens[1:] - 1] == 0x27)) + 1  # letters after an apostrophe
    ends[glued - 1] = ends[glued]
    kinds[glued] = 0
    return opens[kinds > 0], ends[kinds > 0]


class Generations(dict):
    """A cache that keeps what was used since the last turn over; ``ask`` gathers keys that it doesn't have."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old, self.ask = most, {}, set()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            self.ask.add(key)
            return None
        self[key] = value
        return value

    def ready(self) -> Generations:
        """Turned over if full, with nothing asked for."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        self.ask.clear()
        return self


def joinable(chunk: str) -> bool:
    """No white space but one blank at the start; chunks have white space only there or are nothing else."""
    return not chunk[-1].isspace() and (not chunk[0].isspace() or (chunk[0] == " " and not chunk[1].isspace()))


def filled(got: list, keys: list, cache: dict) -> None:
    """Look up again what was missing, at its places only."""
    at = -1
    while True:
        try:
            at = got.index(None, at + 1)
        except ValueError:
            return
        got[at] = cache[keys[at]]


class ChunkEncoder:
    """``ids(text)``: uint32 little-endian bytes; ``spans(text)``: character start and end of each token.

    The caches have two generations of ``most`` entries (about 200 bytes each): what is used stays when the
    older one goes."""

    def __init__(self, path: str, most: int = 450_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        steps = (rules.get("normalizer") or {}).get("normalizers", [])
        #: lower case and white space dropped: chunks may be cut after lower-casing, without white space
        self.folds = any(x["type"] == "Lowercase" for x in steps) and (rules.get("pre_tokenizer") or {}).get("type") == "Sequence"
        self.cache, self.span_cache = Generations(most), Generations(most)
        self.common: dict[str, bytes] = {}
        self.sample: Counter = Counter()
        self.sampled = 0
        #: a vocabulary whose rules the cuts don't suit encodes whole texts
        self.cuts = True
        self.line: int | None = None
        self.mark: int | None = None
        self.cuts = all(self.ids(t) == self._whole(t) for t in PROBES)
        self.line = self._line_break()
        self.mark = self._own_mark()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _line_break(self) -> int | None:
        """The id of a line break, if chunks with line breaks between have the ids that each has alone, and else None."""
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        if len(line) != 1 or self.folds or not self.cuts:
            return None
        chunks = [c for c in dict.fromkeys(c for t in PROBES for c in self._cut(t) or COARSE.findall(t)) if joinable(c)]
        chunks += [a + b for a in " x" for b in chunks if joinable(a + b)]
        ids = self.tokenizer.encode("\n".join(chunks), add_special_tokens=False).ids
        return line[0] if np.array(ids, "<u4").tobytes() == np.array(line, "<u4").tobytes().join(map(self._whole, chunks)) else None

    def _own_mark(self) -> int | None:
        """The id of ``MARK``, if chunks without white space that have it between them have the ids that each has alone, and else None."""
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        if len(mark) != 1 or not self.folds or not self.cuts:
            return None
        chunks = list(dict.fromkeys(c for t in PROBES for c in [*(self._cut(t) or ()), *COARSE.findall(t)]))
        ids = self.tokenizer.encode(MARK.join(chunks), add_special_tokens=False).ids
        return mark[0] if np.array(ids, "<u4").tobytes() == np.array(mark, "<u4").tobytes().join(map(self._whole, chunks)) else None

    def _learn(self, chunks: list[str], cache: dict) -> None:
        """Put the ids of new chunks into the cache. An Encoding costs as much as a word's merges, so many chunks share one:
        no pre-token crosses a line break between chunks without one, or a mark, whose id then tells them apart."""
        alone = chunks
        between, own = ("\n", self.line) if self.line is not None else (MARK, self.mark)
        if own is not None:
            many, alone = ([], []) if self.line is not None else (chunks, [])
            for c in chunks if self.line is not None else ():
                (many if joinable(c) else alone).append(c)
            groups = [many[i : i + TOGETHER] for i in range(0, len(many), TOGETHER)]
            for group, e in zip(groups, self.tokenizer.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False) if groups else ()):
                ids = np.array(e.ids, "<u4")
                ends = np.append(np.flatnonzero(ids == own), len(ids)) * 4
                if len(ends) != len(group):
                    alone += group
                    continue
                data, lo = ids.tobytes(), 0
                for c, hi in zip(group, ends.tolist()):
                    cache[c] = data[lo:hi]
                    lo = hi + 4
        for c, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False) if alone else ()):
            cache[c] = array("I", e.ids).tobytes() if LITTLE else np.array(e.ids, "<u4").tobytes()

    def _cut(self, text: str) -> list[str] | None:
        if not self.cuts:
            return None
        data = text.encode("utf-8", "surrogatepass")
        if not data.translate(None, FINE_BYTES) and b"<|" not in data:
            if not self.folds:
                return FINE.findall(text)
            low = text.lower()
            if not low.encode("utf-8").translate(None, FINE_BYTES):  # three capitals have small letters outside
                return FINE_DROPPED.findall(low)
        return None if UNSURE.search(text) else COARSE.findall(text)

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0]

    def batch(self, texts: list[str]) -> list[bytes]:
        """``ids`` of many texts; chunks that are new to the cache go to the library together."""
        if not self.folds or not self.cuts:
            return self._one_by_one(texts)
        out: list[bytes] = [b""] * len(texts)
        side, rest, held = [], [], 0
        for i, text in enumerate(texts):
            data = text.lower().encode("utf-8", "surrogatepass")
            if data.translate(None, FINE_BYTES) or b"<|" in data:
                rest.append(i)
                continue
            side.append((i, data))
            held += len(data)
            if held >= SIDE_BY_SIDE:
                self._side_by_side(side, out)
                side, held = [], 0
        if side:
            self._side_by_side(side, out)
        for i, x in zip(rest, self._one_by_one([texts[i] for i in rest])):
            out[i] = x
        return out

    def _side_by_side(self, texts: list[tuple[int, bytes]], out: list[bytes]) -> None:
        """Put the ids of lower-cased fine texts into ``out``, at their numbers.

        Equal chunks have equal hashes and are looked up once; two of the n different ones share a hash with probability under n^2 / 2^65."""
        data = b" " + b" ".join(x for _, x in texts) + b" " * 9
        starts, ends = fine_spans(data)
        h = span_hashes(data, starts, ends - starts)
        order = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        back = np.empty(len(h), np.int64)
        back[order] = np.cumsum(new) - 1
        one = order[new]
        chunks = [data[a:b].decode("utf-8") for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        cache = self.cache.ready()
        got = list(map(cache.__getitem__, chunks))
        self._learn(list(cache.ask), cache)
        filled(got, chunks, cache)
        n = np.fromiter(map(len, got), np.int64, len(got)) // 4
        place = (np.cumsum(n) - n)[back]
        n = n[back]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(got), "<u4")[np.repeat(place - upto[:-1], n) + np.arange(upto[-1])].tobytes()
        bounds = upto[np.searchsorted(starts, np.cumsum([1, *(len(x) + 1 for _, x in texts)]))] * 4
        for (i, _), lo, hi in zip(texts, bounds.tolist(), bounds[1:].tolist()):
            out[i] = ids[lo:hi]

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        """``batch`` for texts that are cut one after the other.

        Lookups cost a cache line or more each, so the commonest chunks sit in a small table before the large one."""
        out: list[bytes] = []
        lo = 0
        while lo < len(texts):
            cut, found, n = [], [], 0
            cache = self.cache.ready()
            common, get = self.common.get, cache.__getitem__
            while lo + len(cut) < len(texts) and (not cut or n < 200_000):
                chunks = self._cut(texts[lo + len(cut)])
                got = list(map(common, chunks or ()))
                if None in got:
                    got = [get(c) if g is None else g for g, c in zip(got, chunks)]
                cut.append(chunks)
                found.append(got)
                n += len(got)
            self._learn(list(cache.ask), cache)
            for i, (chunks, got) in enumerate(zip(cut, found)):
                if chunks is None:
                    out.append(self._whole(texts[lo + i]))
                    continue
                filled(got, chunks, cache)
                out.append(b"".join(got))
            lo += len(cut)
            if self.sampled < COMMON_FROM:
                self.sample.update(c for chunks in cut if chunks for c in chunks)
                self.sampled += n
                if self.sampled >= COMMON_FROM:
                    self.common = {c: get(c) for c, _ in self.sample.most_common(COMMON)}
                    self.sample.clear()
        return out

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data = text.encode("utf-8", "surrogatepass")
        fine = not data.translate(None, FINE_BYTES) and b"<|" not in data
        chunks = None if not self.cuts else FINE.findall(text) if fine else None if UNSURE.search(text) else COARSE.findall(text)
        if chunks is None:
            got = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
            return got[:, 0], got[:, 1]
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cache = self.span_cache.ready()
        got = list(map(cache.__getitem__, chunks))
        if cache.ask:
            ask = list(cache.ask)
            for c, e in zip(ask, self.tokenizer.encode_batch(ask, add_special_tokens=False)):
                o = e.offsets
                cache[c] = (np.array([x[0] for x in o], "<u4").tobytes(), np.array([x[1] for x in o], "<u4").tobytes(), len(o))
            filled(got, chunks, cache)
        starts, ends, counts = zip(*got)
        at = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        at = np.concatenate([[0], at[:-1]])
        base = np.repeat(at, np.array(counts, np.int64))
        return np.frombuffer(b"".join(starts), "<u4") + base, np.frombuffer(b"".join(ends), "<u4") + base


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker; one vocabulary at a time."""
    only_cache("encoder", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
