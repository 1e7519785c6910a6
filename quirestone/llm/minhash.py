"""MinHash near-duplicates with DartMinHash signatures.

Texts are lower-cased and split at white space; the elements are the distinct runs of five words (the
whole text, if it has fewer), each weighted by how often it occurs. Every element owns regions of a weight x rank plane; hashed darts fall on
them as a Poisson process, drawn in order of rank from the element's hash alone. A document sees the darts
under its weights and below a rank bound that leaves about ``k ln k + 3k`` of them, and keeps the earliest
for each of ``k`` coordinates; the bound is doubled for documents with an empty coordinate. Two documents
agree in a coordinate with probability equal to their weighted Jaccard similarity, in expected time
``elements + k log k``.

Documents with the same words form a class, which is the graph's node and is represented by its smallest
id; ids only choose, so texts under a null or repeated id stay apart. The representatives' bands
(25 of 5 rows: a pair at similarity 0.8 is missed with probability 5e-5) make buckets. Links are sought in
three steps, each under the components of the one before, and none of them makes all pairs of a bucket:

1. stars: a representative and its few smallest bucket centres are verified exactly on whole texts;
2. nearest: in buckets that span several components, the members outside the largest one are compared with all
   members by signature, tile by tile, and each one's nearest in another component is verified;
3. the rest: in buckets where more partners passed the sieve, every pair across components that passes it is
   verified inside the tile, on whole multisets of runs, by one matrix product; only a forest of the links leaves.

Defined cases: null text is empty; texts without words form one class; rows that repeat are members of
their class; null ids stay null and sort before all others; of one id's texts in a component that is
named by it, the one with the smallest hash is kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import even, forget, materialize, only_cache, tidied
from .graph import components, forest

WIDTH = 5
BANDS, ROWS = 25, 5
K = BANDS * ROWS
SIMILARITY = 0.8
#: Signature agreement under which a pair isn't verified: 4.2 standard deviations under 0.8.
SIEVE = 0.65
#: Rows, and units, of one side of a tile.
TILE, UNITS = 1024, 4_000_000
#: Centres that a representative is verified against at first.
CENTRES = 4
NO_ID = -(1 << 62)

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array."""
    with np.errstate(over="ignore"):
        x = x + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: Hashes of words, as 8 bytes each, which join faster than whole numbers.
_WORDS: dict[str, bytes] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORDS) > 300_000:
        _WORDS.clear()
    got = list(map(_WORDS.get, words))
    if None in got:
        for i, g in enumerate(got):
            if g is None:
                got[i] = _WORDS[words[i]] = xxhash.xxh3_64_digest(words[i])
    return np.frombuffer(b"".join(got), ">u8").astype(np.uint64)


def shingles(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the runs of ``width`` words, and how often each occurs; empty for a text without words."""
    h = word_hashes((text or "").lower().split())
    if not len(h):
        return h, np.zeros(0, np.int64)
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(width, len(h))):
            out = out * _U(0xD6E8FEB86659FD93) + h[i : i + n]
    return np.unique(mix(out), return_counts=True)


def units(text: str | None) -> np.ndarray:
    """Sorted hashes of the runs with the number of their occurrence: the Jaccard similarity of two texts' units is the
    weighted one of their runs."""
    elements, n = shingles(text)
    again = np.flatnonzero(n > 1)
    if not len(again):
        return elements
    nth = np.concatenate([np.arange(1, k) for k in n[again]]).astype(np.uint64)
    with np.errstate(over="ignore"):
        more = mix(np.repeat(elements[again], n[again] - 1) + nth * _U(0x8CB92BA72F3D8DD7))
    return np.sort(np.concatenate([elements, more]))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted distinct arrays; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def shared_units(a: list[np.ndarray], b: list[np.ndarray], width: int = 16_384) -> np.ndarray:
    """How many units each of ``a`` shares with each of ``b``: products of 0/1 matrices over ``width`` units at a time."""
    flat = np.concatenate([*a, *b])
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    opens = np.concatenate([[True], flat[1:] != flat[:-1]])
    times = np.diff(np.append(np.flatnonzero(opens), len(flat)))
    common = np.repeat(times > 1, times)  # what one text has alone is shared with none
    column, owner = (np.cumsum(opens) - 1)[common], owner[common]
    column = np.cumsum(np.concatenate([[0], np.diff(column) > 0])) if len(column) else column
    out = np.zeros((len(a), len(b)))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [lo, lo + width]))
        block = np.zeros((len(a) + len(b), width), np.float32)
        block[owner[at], column[at] - lo] = 1
        out += block[: len(a)] @ block[len(a) :].T
    return out


def signatures(elements: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = K) -> np.ndarray:
    """DartMinHash signatures (documents x k, uint32) of hashed elements with non-negative weights (1 if not given)."""
    out = np.zeros((len(elements), k), np.uint32)
    todo = [i for i, e in enumerate(elements) if len(e) and (weights is None or weights[i].sum() > 0)]
    darts = k * math.log(k) + 3 * k
    while todo:
        lens = np.array([len(elements[i]) for i in todo])
        el = np.concatenate([elements[i] for i in todo])
        doc = np.repeat(np.arange(len(todo)), lens)
        w = None if weights is None else np.concatenate([weights[i] for i in todo]).astype(float)
        total = lens.astype(float) if w is None else np.bincount(doc, w, len(todo))
        bound = (darts / total)[doc]
        best = np.full(len(todo) * k, np.iinfo(np.uint64).max, np.uint64)
        low, high, layer, least = 0.0, 1.0, 0, 1.0 if w is None else float(w.min())
        while True:  # layers [0, 1), [1, 2), [2, 4), ... of weight
            act = np.arange(len(el)) if w is None else np.flatnonzero(w > low)
            if not len(act):
                break
            rank = np.zeros(len(act))
            shot = 0
            while len(act):
                with np.errstate(over="ignore"):
                    h = mix(el[act] + _U((shot * 0x9E3779B97F4A7C15 + layer * 0xC2B2AE3D27D4EB4F) % (1 << 64)))
                    g = mix(h ^ _U(0xA0761D6478BD642F))
                rank = rank - np.log(((h >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)) / (high - low)
                alive = rank < bound[act]
                act, rank, g, h = act[alive], rank[alive], g[alive], h[alive]
                hit, at, mark, when = act, g >> _U(32), g & _U(0xFFFFFFFF), rank
                if w is not None and high > least:  # a whole layer needs no test
                    place = low + (high - low) * ((h & _U(0x7FF)).astype(np.float64) + 0.5) / 2048
                    inside = place < w[act]
                    hit, at, mark, when = act[inside], at[inside], mark[inside], rank[inside]
                packed = (when.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | mark
                np.minimum.at(best, doc[hit] * k + (at % _U(k)).astype(np.int64), packed)
                shot += 1
            if w is None:
                break
            low, high, layer = high, 2 * high, layer + 1
        best = best.reshape(len(todo), k)
        full = (best != np.iinfo(np.uint64).max).all(axis=1)
        done = np.flatnonzero(full)
        out[[todo[i] for i in done]] = (best[done] & _U(0xFFFFFFFF)).astype(np.uint32)
        todo = [todo[i] for i in np.flatnonzero(~full)]
        darts *= 2
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each document and band."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key ^ rows[:, :, r])
    return key.view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """id, mark, key (hash of the words), sig (null without words), bands for each row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only_cache("minhash", _WORDS.clear)
        for pdf in batches:
            lo = 0
            texts = pdf["text"].tolist()
            while lo < len(texts):
                sets, counts, keys, size, hi = [], [], [], 0, lo
                while hi < len(texts) and size < 800_000:
                    words = (texts[hi] or "").lower().split()
                    keys.append(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                    elements, n = shingles(texts[hi])
                    sets.append(elements)
                    counts.append(n)
                    size += len(elements)
                    hi += 1
                sig = signatures(sets, counts)
                bands = band_keys(sig)
                yield pd.DataFrame({
                    "id": pdf["id"].to_numpy()[lo:hi], "mark": pdf["mark"].to_numpy()[lo:hi], "key": keys,
                    "sig": [sig[i].tobytes() if len(s) else None for i, s in enumerate(sets)],
                    "bands": [bands[i] if len(s) else None for i, s in enumerate(sets)],
                })
                lo = hi

    return even(docs).mapInPandas(work, "id long, mark binary, key binary, sig binary, bands array<long>")


@F.pandas_udf(DoubleType())
def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of coordinates in which two signatures agree."""
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), np.uint32).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), np.uint32).reshape(len(b), -1)
    return pd.Series((x == y).mean(axis=1))


@F.pandas_udf(DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    only_cache("minhash", _WORDS.clear)
    last, s = None, None
    out = []
    for x, y in zip(a, b):
        if x is not last:
            last, s = x, units(x)
        out.append(similarity(s, units(y)))
    return pd.Series(out, dtype=float)


def _verified(pairs: DataFrame, sigs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs(a, b)`` that pass the sieve, with ``linked``: whether they reach the similarity exactly."""
    left = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    likely = pairs.join(left, "a").join(right, "b").filter(agreement("sig_a", "sig_b") >= SIEVE).select("a", "b")
    likely = materialize(likely, "near-likely")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return materialize(likely.join(right, "b").join(left, "a").select("a", "b", (text_similarity("text_b", "text_a") >= SIMILARITY).alias("linked")), "near-links")


def _unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that span several components of ``found``, with ``component`` and whether that is ``outside`` the bucket's largest."""
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left").select("h", "id", F.coalesce("component", "id").alias("component"))
    placed = materialize(placed, "near-placed")
    largest = placed.groupBy("h", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(F.max(F.struct("n", "component")).alias("x"), F.sum("n").alias("all"))
    largest = materialize(largest.filter("all > x.n").select("h", F.col("x.component").alias("largest")), "near-open")
    return materialize(placed.join(largest, "h").withColumn("outside", F.col("component") != F.col("largest")).drop("largest"), "near-unsettled")


def _tiles(unsettled: DataFrame, data: DataFrame, name: str, most: int, rows: int = TILE) -> DataFrame:
    """Rows of ``unsettled`` with ``name`` of ``data(id, name, size)``, in tiles (h, i, j): outside members (``asks``) of tile ``i`` of theirs
    against members of tile ``j``, each of about ``rows`` rows and ``most`` of size."""
    size = F.col("size").cast("double") / most + F.lit(1.0 / rows)
    u = unsettled.join(data.select("id", "size"), "id")
    n = u.groupBy("h").agg(F.ceil(F.sum(F.when(F.col("outside"), size).otherwise(0.0))).cast("int").alias("rows"), F.ceil(F.sum(size)).cast("int").alias("columns"))
    m = u.drop("size").join(materialize(n, "near-tiles"), "h").join(data.select("id", name), "id").withColumn("x", F.xxhash64("id"))
    i, j = F.pmod("x", F.col("rows")).cast("int"), F.pmod("x", F.col("columns")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda k: F.struct(k.alias("i"), j.alias("j"), F.lit(False).alias("asks")))
    asks = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda k: F.struct(i.alias("i"), k.alias("j"), F.lit(True).alias("asks")))
    keep = ["h", "id", "component", "outside", name]
    return m.select(*keep, F.explode(F.when(F.col("outside"), F.concat(met, asks)).otherwise(met)).alias("t")).select("t.*", *keep)


class _Compared:
    """A tile's asking rows and members by signature; ``of(i)`` are the members in other components that pass the sieve with row ``i``."""

    def __init__(self, rows: dict[str, np.ndarray]):
        self.ids, self.component, asks = rows["id"], rows["component"], rows["asks"].astype(bool)
        self.sig = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(len(asks), -1)
        self.asking, self.members = np.flatnonzero(asks), np.flatnonzero(~asks)
        # one byte of a coordinate refuses most; agreement there is at least that of the whole
        self.low = self.sig.astype(np.uint8)
        self.low_members, self.theirs = self.low[self.members], self.component[self.members]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, agreement)."""
        same = (self.low_members == self.low[i]).sum(1, dtype=np.uint8)
        at = self.members[(same >= SIEVE * K) & (self.theirs != self.component[i])]
        near = (self.sig[at] == self.sig[i]).mean(axis=1)
        return at[near >= SIEVE], near[near >= SIEVE]


def _by_tile(tiles: DataFrame, work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``work`` on the columns of each tile (h, i, j), as arrays; there are many small tiles, so a partition's are cut apart here."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def done(pdf: pd.DataFrame, ends: np.ndarray) -> pd.DataFrame:
            columns = {c: pdf[c].to_numpy() for c in pdf.columns}
            out = [work({c: v[lo:hi] for c, v in columns.items()}) for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends)]
            return pd.DataFrame({c: np.concatenate([x[c] for x in out]) for c in names})

        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            key = pdf[["h", "i", "j"]].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if len(ends):
                yield done(pdf, ends)
                pdf = pdf.iloc[ends[-1] :]
            held = pdf
        if held is not None and len(held):
            yield done(held, np.array([len(held)]))

    return tiles.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInPandas(run, schema)


def _nearest(tiles: DataFrame) -> DataFrame:
    """(h, a, b, more): each asking row's nearest partner in its tile, and whether there are more."""

    def work(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        tile = _Compared(rows)
        ids, pairs, more = tile.ids, [], []
        for i in tile.asking:
            at, near = tile.of(i)
            if len(at):
                best = at[np.lexsort((ids[at], -near))[0]]
                pairs.append((ids[i], ids[best]))
                more.append(len(at) > 1)
        both = np.array(pairs, np.int64).reshape(-1, 2)
        return {"h": np.repeat(rows["h"][:1], len(both)), "a": both.max(axis=1), "b": both.min(axis=1), "more": np.array(more, bool)}

    return _by_tile(tiles, work, "h long, a long, b long, more boolean")


def _live(tiles: DataFrame) -> DataFrame:
    """(h, id, component, outside) of the members of pairs across components that pass the sieve and share no earlier band."""

    def work(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        tile = _Compared(rows)
        band = int(np.argmax(band_keys(tile.sig[:1])[0] == rows["h"][0]))
        flagged = np.zeros(len(rows["h"]), bool)
        for i in tile.asking:
            at, _ = tile.of(i)
            if len(at) and band:
                before = (tile.sig[at, : band * ROWS] == tile.sig[i, : band * ROWS]).reshape(len(at), band, ROWS)
                at = at[~before.all(axis=2).any(axis=1)]
            flagged[at] = True
            flagged[i] |= len(at) > 0
        return {c: rows[c][flagged] for c in ("h", "id", "component", "outside")}

    return _by_tile(tiles, work, "h long, id long, component long, outside boolean").distinct()


def _exact(tiles: DataFrame) -> DataFrame:
    """(a, b): a forest of each tile's links across components."""

    def work(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ids, component, asks = rows["id"], rows["component"], rows["asks"].astype(bool)
        have = [np.frombuffer(x, np.uint64) for x in rows["units"]]
        size = np.array([len(x) for x in have])
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        links = np.zeros((len(a), len(b)), bool)
        if links.size:
            shared = shared_units([have[i] for i in a], [have[i] for i in b])
            links = (shared / (size[a][:, None] + size[b] - shared) >= SIMILARITY) & (component[a][:, None] != component[b])
        edges = np.array(forest(links, ids[a], ids[b]), np.int64).reshape(-1, 2)
        return {"a": edges[:, 0], "b": edges[:, 1]}

    return _by_tile(tiles, work, "a long, b long")


def _settled(members: DataFrame, sigs: DataFrame, texts: DataFrame, tried: DataFrame) -> DataFrame:
    """(node, component) once no pair of ``members(h, id)`` that passes the sieve is both apart and unverified; ``tried(a, b, linked)`` are the stars."""

    @F.pandas_udf("binary")
    def units_of(t: pd.Series) -> pd.Series:
        only_cache("minhash", _WORDS.clear)
        return pd.Series([units(x).tobytes() for x in t], dtype=object)

    links = tried.filter("linked").select("a", "b")
    found = materialize(components(links), "near-found")
    signed = sigs.withColumn("size", F.lit(1))
    near = materialize(_nearest(_tiles(_unsettled(members, found), signed, "sig", 1 << 40)), "near-nearest")
    more = near.filter("more").select("h").distinct()
    fresh = near.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    links = links.union(_verified(fresh, sigs, texts).filter("linked").select("a", "b"))
    found = materialize(components(links), "near-found")
    live = materialize(_live(_tiles(_unsettled(members.join(more, "h"), found), signed, "sig", 1 << 40)), "near-live")
    sets = texts.join(live.select("id").distinct(), "id").select("id", units_of("text").alias("units"))
    sets = materialize(sets.withColumn("size", F.length("units") / 8), "near-units")
    rest = materialize(_exact(_tiles(live, sets, "units", UNITS)), "near-rest")
    if not rest.head(1):
        return found
    return materialize(components(links.union(rest)), "near-found")


def _mark(text: str) -> Column:
    """A hash of a text; with the id it names a row, as ids may be null or repeat."""
    return F.unhex(F.md5(F.concat(F.when(F.col(text).isNull(), "n").otherwise("t"), F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("binary")))


def _grouped(docs: DataFrame) -> DataFrame:
    """id (NO_ID if null), mark, class_id, component_id, kept for each row."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text")).withColumn("mark", _mark("text"))
    sketched = materialize(sketch(rows), "near-sketch")
    # a class is a node of its own number; its row of the smallest id stands for it
    classes = sketched.groupBy("key").agg(F.min(F.struct("id", "mark", "sig", "bands")).alias("x"))
    classes = materialize(classes.select("key", F.monotonically_increasing_id().alias("node"), F.col("x.id").alias("class_id"), "x.mark", "x.sig", "x.bands"), "near-classes")
    sigs = classes.filter("sig is not null").select(F.col("node").alias("id"), "sig")
    banded = classes.filter("sig is not null").select(F.col("node").alias("id"), F.explode("bands").alias("h"))
    buckets = materialize(banded.groupBy("h").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("centre")).filter("members > 1"), "near-buckets")
    members = materialize(banded.join(buckets, "h").select("h", "id", "members", "centre"), "near-members")
    # one text for each node that is in a bucket, however often its row repeats
    wanted = classes.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select("node", F.col("class_id").alias("id"), "mark")
    once = Window.partitionBy("node").orderBy("mark")
    texts = rows.join(wanted, ["id", "mark"]).withColumn("n", F.row_number().over(once)).filter("n = 1").select(F.col("node").alias("id"), "text")
    texts = materialize(texts, "near-texts")
    # a representative first tries its few smallest centres, which near copies share; what that leaves apart is settled below
    near = Window.partitionBy("a").orderBy("b")
    stars = members.filter("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct().withColumn("n", F.row_number().over(near))
    stars = materialize(stars.filter(F.col("n") <= CENTRES).select("a", "b"), "near-stars")
    tried = _verified(stars, sigs, texts)
    forget(spark, stars)
    found = _settled(members.select("h", "id"), sigs, texts, tried)

    # the component's row of the smallest id names it and is kept
    linked = materialize(classes.select("node", "class_id", "mark").join(found, "node"), "near-linked")
    best = linked.groupBy("component").agg(F.min(F.struct("class_id", "mark")).alias("best"))
    best = linked.select("node", "component").join(best, "component").select("node", "best")
    own = F.struct("class_id", "mark")
    labelled = materialize(
        classes.join(best, "node", "left").select("key", "class_id", F.coalesce("best", own).alias("best")).select("key", "class_id", F.col("best.class_id").alias("component_id"), F.col("best.mark").alias("kept_mark")),
        "near-labels",
    )
    out = sketched.select("id", "mark", "key").join(labelled, "key")
    return out.select("id", "mark", "class_id", "component_id", ((F.col("id") == F.col("component_id")) & (F.col("mark") == F.col("kept_mark"))).alias("kept"))


@tidied
def groups(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (same words), component_id (reachable by links), kept for each row."""

    def real(c: str):
        return F.when(F.col(c) != NO_ID, F.col(c))

    return _grouped(docs).select(real("id").alias("doc_id"), real("class_id").alias("class_id"), real("component_id").alias("component_id"), "kept")


@tidied
def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id (one row, if rows repeat it)."""
    names = docs.columns
    keep = _grouped(docs).filter("kept").select(F.col("id").alias("_keep_id"), F.col("mark").alias("_keep_mark")).distinct()
    own = docs.select(*[F.col(c).alias(f"in_{c}") for c in names])
    own = own.withColumn("_keep_id", F.coalesce(F.col("in_doc_id").cast("long"), F.lit(NO_ID))).withColumn("_keep_mark", _mark("in_text"))
    joined = own.join(keep, ["_keep_id", "_keep_mark"], "left_semi")
    first = Window.partitionBy("_keep_id", "_keep_mark").orderBy(F.xxhash64("in_text"))
    return joined.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(*[F.col(f"in_{c}").alias(c) for c in names])
