"""Language-model scoring with an Elias-Fano n-gram trie.

Tokens are words between ASCII white space, with A-Z lower-cased, and one end token for each text.
Level 1 of the trie holds every token of the training fold as a 63-bit hash, in order; a token's id is
its rank. Level n holds, for each entry of level n-1 (a context), a monotone pointer to its run of successor
ids, and the runs, each raised above the one before so that all ids ascend; both are Elias-Fano coded.
A level is a few files over ranges of (context, id), written by Spark tasks to the shared folder and
memory-mapped by those that read them, so all workers of a machine share one copy and no model passes
through the driver. Lookups go down level by level: the rank of a context, its pointers, then the successor
inside their range.

Counts cover all training texts. Higher-order n-grams need a count of ``least`` (2); before level 3 is
counted, n-grams with a part that isn't in level 2 are left out, which loses none with that count.
Probabilities are interpolated with absolute discounting: a kept successor gets
``(c - D) / c(context) + left * P(shorter)``, ``left`` being the mass that kept successors don't take, so
each context's probabilities add up to 1. They, and ``left``, are stored as 16-bit steps of log10
(``STEP``); level 1 keeps exact counts, which also give the base score.

Defined cases: null and empty text is the end token alone; rows that repeat count and are scored again;
with no training rows every token has probability 1 (N = V = 0). Two tokens share a hash with probability
under V^2 / 2^64.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .binary_records import file_system
from .common import doc_hash, even, forget, fresh_path, long_ids, materialize, only_cache, texts_by_id, tidied
from .elias_fano import Runs, encode_runs
from .encoding import span_hashes

DISCOUNT = 0.75
ALPHA = 0.1
LEAST = 2
SHARD_KEYS = 1_000_000
PAIRS = "context long, word long, n long"
#: One step of a stored log10 probability; 16 bits reach down to 1e-19.
STEP = 3e-4
#: Different words, and tokens, that a task gathers before it sends its counts on.
WORDS, FLUSH = 600_000, 1_500_000
#: Characters of texts that are cut into tokens together (a longer text is cut whole).
CUT = 4_000_000
#: Tokens that are scored together (a longer text is scored whole).
SCORED = 600_000
#: Tokens of which one task adds up the n-grams.
SUMMED = 2_000_000


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, ASCII letters lower-cased (bytes.split knows exactly the six ASCII spaces)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


#: The end token can't be a word: it holds a space.
END_HASH = xxhash.xxh3_64_intdigest(b" end") >> 1

_U = np.uint64
_SPACES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the tokens of some texts, one after the other, each text's end token too; and tokens of each text.

    All tokens are cut and hashed side by side, eight bytes at a time; :func:`tokens` says which they are."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b" " + b" ".join(raw).lower() + b" " * 9
    space = _SPACES[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, size = edges[::2], edges[1::2] - edges[::2]
    h = span_hashes(data, starts, size)
    ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in raw], dtype=np.int64) + 1)  # words up to each text's end
    out = np.full(len(starts) + len(texts), END_HASH, np.int64)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))] = h >> _U(1)
    return out, np.diff(ends, prepend=0) + 1


def _cut_in_parts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`token_hashes` of about ``CUT`` characters at a time."""
    lo = held = 0
    for hi, t in enumerate(texts, 1):
        held += len(t or "") + 1
        if held >= CUT or hi == len(texts):
            yield token_hashes(texts[lo:hi])
            lo, held = hi, 0


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of ``n``."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n[order], first) if len(keys) else n


@dataclass
class Level:
    """The files of one level: for each shard its first context and id, the rank of that entry, and a name."""

    contexts: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    ranks: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    n: int = 0


@dataclass
class Trie:
    folder: str
    total: int = 0
    vocabulary: int = 0
    levels: list[Level] = field(default_factory=list)


@functools.lru_cache(maxsize=256)
def _mapped(uri: str, name: str):
    """A file of the shared folder: a memory map where the folder is mounted, else its bytes."""
    files, root = file_system(uri)
    if files.type_name == "local":
        return np.memmap(f"{root}/{name}", np.uint8, "r")
    with files.open_input_file(f"{root}/{name}") as f:
        return f.read_buffer()


@functools.lru_cache(maxsize=256)
def _runs_of(uri: str, name: str) -> Runs:
    return Runs(_mapped(uri, name))


def _save(uri: str, name: str, data: bytes) -> None:
    files, root = file_system(uri)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}") as f:
        f.write(data)


class Reader:
    """Lookups in a trie."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def _shard(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The shard that would hold each pair (-1: before the first)."""
        lv = self.trie.levels[level]
        contexts, words = np.array(lv.contexts, np.int64), np.array(lv.words, np.int64)
        shard = np.searchsorted(contexts, context, "right") - 1
        opens = np.flatnonzero((shard >= 0) & (contexts[shard] == context))  # a shard begins with this context: which word?
        for c in np.unique(context[opens]):
            at = opens[context[opens] == c]
            lo, hi = np.searchsorted(contexts, [c, c + 1])
            shard[at] = lo - 1 + np.searchsorted(words[lo:hi], word[at], "right")
        return shard

    def ranks(self, level: int, context: np.ndarray | None, word: np.ndarray) -> np.ndarray:
        """Rank of each (context, id) in a level, or -1; ``context`` is None for level 1. Pairs are looked up once each, in order, which memory likes."""
        if context is None:
            context = np.zeros(len(word), np.int64)
        if len(word) > 1000:
            context, word, back = unique_pairs(context, word, self.trie.levels[level - 1].n if level else 1)
            return self._ranks(level, context, word)[back]
        return self._ranks(level, context, word)

    def _ranks(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(word), -1, np.int64)
        lv = self.trie.levels[level]
        shard = self._shard(level, context, word)
        for s, at in _by_shard(shard):
            got = _runs_of(self.trie.folder, f"{lv.names[s]}.ef").find(context[at], word[at])
            out[at] = np.where(got >= 0, got + lv.ranks[s], -1)
        return out

    def values(self, level: int, kind: str, ranks: np.ndarray, missing) -> np.ndarray:
        """Stored values (counts, or steps of log10) at ranks of a level; ``missing`` where a rank is -1."""
        lv = self.trie.levels[level]
        out = np.full(len(ranks), missing, np.float64)
        shard = np.searchsorted(np.array(lv.ranks, np.int64), ranks, "right") - 1
        shard[ranks < 0] = -1
        for s, at in _by_shard(shard):
            stored = np.frombuffer(_mapped(self.trie.folder, f"{lv.names[s]}.{kind}"), "<u8" if kind == "count" else "<u2")
            out[at] = stored[ranks[at] - lv.ranks[s]]
        return out

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each token, -1 if training has none; each is looked up once, in order."""
        if not self.trie.levels:
            return np.full(len(hashes), -1, np.int64)
        different, back = np.unique(hashes, return_inverse=True)
        return self._ranks(0, np.zeros(len(different), np.int64), different)[back]

    def base(self, ids: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of each token."""
        t = self.trie
        c = self.values(0, "count", ids, 0.0) if t.levels else np.zeros(len(ids))
        return np.log10((c + ALPHA) / (t.total + ALPHA * (t.vocabulary + 1)))

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank in level 2 of each pair of ids, -1 where one is missing or the pair is."""
        out = np.full(len(a), -1, np.int64)
        ok = np.flatnonzero((a >= 0) & (b >= 0))
        out[ok] = self.ranks(1, a[ok], b[ok])
        return out

    def probability(self, grams: list[np.ndarray], runs: bool = False, base: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of the ids in the last of 2 or 3 columns given those before (-2: no token there).

        ``runs``: rows are texts' consecutive runs, so a row's context is the last pair of the row before. ``base``: :meth:`base` of the last column, if known."""
        order, levels, word = len(grams), len(self.trie.levels), grams[-1]
        score = self.base(word) if base is None else base
        if levels < 2 or order < 2:
            return score
        score, pair = self._with_context(score, 0, grams[-2], word)
        if levels < 3 or order < 3:
            return score
        context = np.where(grams[0] >= 0, np.concatenate([[-1], pair[:-1]]), -1) if runs else self._pairs(grams[0], grams[1])
        return self._with_context(score, 1, context, word)[0]

    def _with_context(self, shorter: np.ndarray, level: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stored probabilities where the n-gram is there, else the context's rest times the shorter one's; and ranks of the n-grams.

        Different pairs are looked up once each, in order, with what is stored of them."""
        out, rank = shorter.copy(), np.full(len(word), -1, np.int64)
        alone = np.flatnonzero((context >= 0) & (word < 0))
        out[alone] -= STEP * self.values(level, "left", context[alone], 0.0)
        both = np.flatnonzero((context >= 0) & (word >= 0))
        if not len(both):
            return out, rank
        c, w, back = unique_pairs(context[both], word[both], self.trie.levels[level].n)
        got = self._ranks(level + 1, c, w)
        rank[both] = got[back]
        there, gone = got >= 0, np.flatnonzero(got < 0)
        stored = np.zeros(len(got))
        stored[there] = self.values(level + 1, "prob", got[there], 0.0)
        stored[gone] = self.values(level, "left", c[gone], 0.0)
        out[both] = np.where(there[back], 0.0, out[both]) - STEP * stored[back]
        return out, rank


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, slice | np.ndarray]]:
    """The shards that occur, -1 aside, and where: a slice where they ascend."""
    if len(shard) and (shard[1:] >= shard[:-1]).all():
        bounds = np.searchsorted(shard, np.arange(shard[0], shard[-1] + 2)).tolist()
        for s, lo, hi in zip(range(int(shard[0]), int(shard[-1]) + 1), bounds, bounds[1:]):
            if s >= 0 and lo < hi:
                yield s, slice(lo, hi)
        return
    for s in np.flatnonzero(np.bincount(shard + 1)[1:]).tolist():
        yield s, np.flatnonzero(shard == s)


def unique_pairs(context: np.ndarray, word: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs in order, and where each pair is among them; ``contexts`` bounds the contexts."""
    width = int(word.max()) + 1 if len(word) else 1
    if contexts <= 1:
        w, back = np.unique(word, return_inverse=True)
        return np.zeros(len(w), np.int64), w, back
    if contexts * width < 1 << 63:
        keys, back = np.unique(context * width + word, return_inverse=True)
        return keys // width, keys % width, back
    names, place = np.unique(context, return_inverse=True)  # one number for both wouldn't fit: contexts by their place here
    place, w, back = unique_pairs(place, word, len(names))
    return names[place], w, back


def fits(contexts: int, vocabulary: int) -> bool:
    """Whether a pair can travel as one number."""
    return contexts * vocabulary < 1 << 63


def counted_pairs(context: np.ndarray, word: np.ndarray, contexts: int, width: int | None) -> pd.DataFrame:
    """Pairs with their counts: as ``key`` (context * ``width`` + word), or as they are where ``width`` is None."""
    if width:
        keys, n = np.unique(context * width + word, return_counts=True)
        return pd.DataFrame({"key": keys, "n": n})
    context, word, back = unique_pairs(context, word, contexts)
    return pd.DataFrame({"context": context, "word": word, "n": np.bincount(back, minlength=len(word)).astype(np.int64)})


#: Multiplies keys of so many bits to others, one to one, that are spread evenly.
SPREAD = 0x9E3779B97F4A7C15


def _halves(keys: np.ndarray) -> bytes:
    """Numbers as their lower and their upper 32 bits, which compress: in order, few of the latter differ."""
    return (keys & _U(0xFFFFFFFF)).astype("<u4").tobytes() + (keys >> _U(32)).astype("<u4").tobytes()


def _joined(data: bytes) -> np.ndarray:
    lower, upper = np.frombuffer(data, "<u4").reshape(2, -1)
    return upper.astype(np.uint64) << _U(32) | lower


def packed_counts(keys: np.ndarray, bits: int, parts: int) -> pd.DataFrame:
    """Counts of keys of at most ``bits`` bits as a row for each of ``parts`` equal ranges of spread keys: those that occur once, the others, and how often those do."""
    spread, n = np.unique((keys.astype(np.uint64) * _U(SPREAD)) & _U((1 << bits) - 1), return_counts=True)
    bounds = np.array([-(-(p << bits) // parts) for p in range(1, parts)], np.uint64)
    once, often, n = spread[n == 1], spread[n > 1], n[n > 1].astype("<u4")
    cuts = zip(*(zip([0, *c], [*c, len(x)]) for x in (once, often) for c in [np.searchsorted(x, bounds).tolist()]))
    rows = [(p, _halves(once[a:b]), _halves(often[c:d]), n[c:d].tobytes()) for p, ((a, b), (c, d)) in enumerate(cuts) if a < b or c < d]
    return pd.DataFrame(rows, columns=["part", "once", "often", "n"])


def unpacked_counts(rows: list[tuple[bytes, bytes, bytes]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sums of the counts of some rows of one part."""
    keys, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for once, often, counts in rows:
        keys += [_joined(once), _joined(often)]
        n += [np.ones(len(once) // 8, np.int64), np.frombuffer(counts, "<u4").astype(np.int64)]
    spread, total = summed(np.concatenate(keys), np.concatenate(n))
    return ((spread * _U(pow(SPREAD, -1, 1 << 64))) & _U((1 << bits) - 1)).astype(np.int64), total


def _steps(p: np.ndarray) -> bytes:
    return np.clip(np.round(-np.log10(np.maximum(p, 1e-30)) / STEP), 0, 65_535).astype("<u2").tobytes()


_READERS: dict[str, Reader] = {}


def _reader(trie: Trie) -> Reader:
    """One reader for each worker and state of a trie."""
    only_cache("ngram", _READERS.clear)
    key = f"{trie.folder}:{len(trie.levels)}:{trie.total}:{sum(len(x.names) for x in trie.levels)}"
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(trie)
    return _READERS[key]


def _word_counts(texts: DataFrame) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, n, held = [], [], 0
        for pdf in batches:
            for hashes, _ in _cut_in_parts(pdf["text"].tolist()):
                k, c = np.unique(hashes, return_counts=True)
                keys.append(k)
                n.append(c)
                held += len(k)
                if held > 2 * WORDS:
                    k, c = summed(np.concatenate(keys), np.concatenate(n))
                    keys, n, held = [k], [c], len(k)
                    if held > WORDS:
                        yield pd.DataFrame({"word": k, "n": c})
                        keys, n, held = [], [], 0
        if held:
            k, c = summed(np.concatenate(keys), np.concatenate(n))
            yield pd.DataFrame({"word": k, "n": c})

    counts = texts.mapInPandas(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.select(F.lit(0).cast("long").alias("context"), "word", "n")


def _encoded(rows: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, held_out, ids of each row: its tokens' ids (-1: none), then the end token's, as 32 (or 64) bit integers.

    Words are looked up once here; counting and scoring read the ids."""
    kind = id_type(trie)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(trie)
        for pdf in batches:
            out = []
            for hashes, n in _cut_in_parts(pdf["text"].tolist()):
                out += [x.tobytes() for x in np.split(reader.ids(hashes).astype(kind), np.cumsum(n)[:-1])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "ids": out})

    return rows.mapInPandas(work, "doc_id string, held_out boolean, ids binary")


def id_type(trie: Trie) -> str:
    return "<i4" if trie.vocabulary < 2**31 else "<i8"


def _runs(parts: list[bytes], kind: str, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The ids of some texts one after the other, with the ids up to ``size - 1`` places before them (-2 before a
    text), furthest first; and the length of each text."""
    n = np.array([len(p) for p in parts], np.int64) // np.dtype(kind).itemsize
    flat = np.frombuffer(b"".join(parts), kind).astype(np.int64)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    columns = []
    for back in range(size - 1, 0, -1):
        shifted = np.full(len(flat), -2, np.int64)
        shifted[back:] = flat[: max(0, len(flat) - back)]
        shifted[place < back] = -2
        columns.append(shifted)
    return [*columns, flat], n


def _gram_counts(encoded: DataFrame, trie: Trie, size: int, least: int = 1) -> DataFrame:
    """Counts, from ``least`` on, of the entries (context, word) of level ``size``, n-grams whose parts are in the level before.

    Where a pair fits into one number, a task's counts travel packed, a row for each task that adds them up."""
    kind, contexts = id_type(trie), trie.levels[size - 2].n
    width = trie.vocabulary if fits(contexts, trie.vocabulary) else None
    bits = (contexts * trie.vocabulary).bit_length()
    parts = max(int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")), trie.total // SUMMED)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(trie)

        def counted(texts: list[bytes]) -> pd.DataFrame:
            runs, _ = _runs(texts, kind, size)
            context, word = runs[-2:]
            ok = context >= 0
            if size == 3:
                # the first pair of a run is the last pair of the run before, so each place's pair is ranked once
                pair = reader._pairs(context, word)
                context = np.where(runs[0] >= 0, np.concatenate([[-1], pair[:-1]]), -1)
                ok = (context >= 0) & (pair >= 0)
            context, word = context[ok], word[ok]
            return packed_counts(context * width + word, bits, parts) if width else counted_pairs(context, word, contexts, None)

        texts, held = [], 0
        for pdf in batches:
            for p in pdf["ids"]:
                texts.append(p)
                held += len(p) // 4
                if held > FLUSH:
                    yield counted(texts)
                    texts, held = [], 0
        if texts:
            yield counted(texts)

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n = unpacked_counts([r for pdf in batches for r in zip(pdf["once"], pdf["often"], pdf["n"])], bits)
        key, n = key[n >= least], n[n >= least]
        yield pd.DataFrame({"context": key // width, "word": key % width, "n": n})

    if not width:
        return encoded.mapInPandas(work, PAIRS).groupBy("context", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return encoded.mapInPandas(work, "part int, once binary, often binary, n binary").repartitionById(parts, "part").mapInPandas(added, PAIRS)


def _write_level(entries: DataFrame, there: int, trie: Trie, value) -> Level:
    """Write the files of ``entries(context, word, n)``, about ``SHARD_KEYS`` entries each; ``value(context, word, n)`` gives the bytes of their values by kind."""
    folder = trie.folder

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in batches if len(p)]
        if parts:
            context, word, n = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("context", "word", "n"))
            parts.clear()
            name = f"level-{uuid.uuid4().hex}"
            _save(folder, f"{name}.ef", encode_runs(context, word))
            for kind, data in value(context, word, n).items():
                _save(folder, f"{name}.{kind}", data)
            yield pd.DataFrame({"context": context[:1], "word": word[:1], "n": [len(n)], "name": [name]})

    ranges = entries.repartitionByRange(max(1, -(-there // SHARD_KEYS)), "context", "word").sortWithinPartitions("context", "word")
    files = materialize(ranges.mapInPandas(work, f"{PAIRS}, name string"), "lm-level")
    level = Level()
    for r in files.orderBy("context", "word").collect():  # one row for each shard
        level.contexts.append(r["context"])
        level.words.append(r["word"])
        level.ranks.append(level.n)
        level.names.append(r["name"])
        level.n += r["n"]
    return level


def _write_left(trie: Trie, level: int, kept: DataFrame, counts) -> None:
    """Write, beside each shard of a level, the mass that the kept successors of each entry leave.

    ``kept(context, word, n)`` is the next level; ``counts(reader, ranks)`` gives the counts of contexts."""
    lv, folder, starts = trie.levels[level], trie.folder, np.array(trie.levels[level].ranks, np.int64)

    @F.pandas_udf("int")
    def shard_of(rank: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, rank.to_numpy(), "right") - 1)

    taken = kept.groupBy(F.col("context").alias("rank")).agg(F.sum(F.col("n") - DISCOUNT).alias("mass")).withColumn("shard", shard_of("rank"))
    sizes = [b - a for a, b in zip(lv.ranks, [*lv.ranks[1:], lv.n])]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        s = int(pdf["shard"].iat[0])
        pdf = pdf[pdf["rank"].notna()]
        rank = pdf["rank"].to_numpy().astype(np.int64)
        left = np.ones(sizes[s])
        left[rank - lv.ranks[s]] = np.maximum(1 - pdf["mass"].to_numpy() / counts(_reader(trie), rank), 1e-12)
        _save(folder, f"{lv.names[s]}.left", _steps(left))  # a repeated task writes the same bytes
        return pd.DataFrame({"shard": [s]})

    spark = kept.sparkSession
    every = spark.range(len(lv.names)).select(F.lit(None).cast("long").alias("rank"), F.lit(None).cast("double").alias("mass"), F.col("id").cast("int").alias("shard"))
    materialize(taken.union(every).groupBy("shard").applyInPandas(work, "shard int"), "lm-left")


def train(rows: DataFrame, order: int = 3, least: int = LEAST) -> tuple[Trie, DataFrame]:
    """A trie of up to three levels over the texts of ``rows(doc_id, text, held_out)`` that aren't held out, and all rows as ids."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = rows.sparkSession
    trie = Trie(fresh_path(spark, "lm-trie"))
    words = materialize(_word_counts(rows.filter("not held_out").select("text")), "lm-words")
    got = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    trie.total, trie.vocabulary = int(got["n"] or 0), int(got["v"])
    if trie.total:
        trie.levels.append(_write_level(words, trie.vocabulary, trie, lambda context, word, n: {"count": n.astype("<u8").tobytes()}))
    forget(spark, words)
    encoded = materialize(_encoded(rows, trie), "lm-ids")
    for size in range(2, order + 1 if trie.total else 2):
        kept = materialize(_gram_counts(encoded.filter("not held_out").select("ids"), trie, size, least), "lm-grams")
        there = kept.count()
        if not there:
            break

        def context_counts(reader: Reader, ranks: np.ndarray, level: int = size - 2) -> np.ndarray:
            return reader.values(level, "count", ranks, 1.0)

        _write_left(trie, size - 2, kept, context_counts)

        def value(context: np.ndarray, word: np.ndarray, n: np.ndarray, size: int = size, now: Trie = trie) -> dict[str, bytes]:
            reader = Reader(now)
            total = reader.values(size - 2, "count", context, 1.0)
            left = 10 ** (-STEP * reader.values(size - 2, "left", context, 0.0))
            if size == 2:
                shorter = reader.base(word)
            else:
                shorter = reader.probability([_second_of(reader, context), word])
            p = (n - DISCOUNT) / total + left * 10**shorter
            return {"prob": _steps(p), "count": n.astype("<u8").tobytes(), "second": word.astype("<u4" if now.vocabulary < 2**32 else "<u8").tobytes()}

        trie.levels.append(_write_level(kept, there, trie, value))
        forget(spark, kept)
    return trie, encoded


def _second_of(reader: Reader, ranks: np.ndarray) -> np.ndarray:
    """The last id of each entry of level 2."""
    lv = reader.trie.levels[1]
    out = np.zeros(len(ranks), np.int64)
    shard = np.searchsorted(np.array(lv.ranks, np.int64), ranks, "right") - 1
    for s in np.unique(shard):
        at = np.flatnonzero(shard == s)
        stored = np.frombuffer(_mapped(reader.trie.folder, f"{lv.names[s]}.second"), "<u4" if reader.trie.vocabulary < 2**32 else "<u8")
        out[at] = stored[ranks[at] - lv.ranks[s]]
    return out


@tidied
def scored(docs: DataFrame, order: int = 3, folds: int = 10, least: int = LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    rows = even(texts_by_id(docs))
    rows = rows.withColumn("held_out", doc_hash("doc_id") % folds == 0)
    trie, encoded = train(rows, order, least)
    kind = id_type(trie)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _reader(trie)
        for pdf in batches:
            lo = 0
            sizes = pdf["ids"].map(len).to_numpy() // np.dtype(kind).itemsize
            while lo < len(pdf):
                hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), SCORED)))
                part = pdf.iloc[lo:hi]
                runs, n = _runs(part["ids"].tolist(), kind, order)
                doc = np.repeat(np.arange(len(part)), n)
                base = reader.base(runs[-1])
                score = reader.probability(runs, runs=True, base=base)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "held_out": part["held_out"].to_numpy(), "n_tokens": n,
                    "n_known": np.bincount(doc, runs[-1] >= 0, len(part)).astype(np.int64), "train_tokens": trie.total,
                    "base_score": np.bincount(doc, base, len(part)), "score": np.bincount(doc, score, len(part)),
                })
                lo = hi

    return long_ids(encoded.mapInPandas(work, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
