"""Nearest neighbours by inner product through shifted space-filling curves.

Inner products become distances by one more component: candidates get ``sqrt(M^2 - |x|^2)`` with M the
largest norm, queries get 0. Several random projections to a few dimensions, each with its own shift,
give Hilbert keys; per curve the keys are range-partitioned into blocks of about equal size at quantiles
found by Spark. A query is compared with the blocks within a half-width of its own on every curve, and
the merged candidates are ranked by their exact inner products.

The half-width isn't guessed: for a bounded sample of queries (``CALIBRATION``) the true neighbours are
found by brute force over all rows in blocks, and the smallest half-width that finds at least ``recall``
of them on some curve is taken. Where vectors have no structure, as with random directions in many
dimensions, it comes out wide, and the search is then close to exhaustive; see the README for figures.

Equal vectors are one candidate that carries its ``k + 1`` smallest ids, which is all a top-k can use.
Defined cases: null, zero, empty or non-finite vectors, vectors whose length isn't the commonest one and
null ids take no part; ties go to the smaller id; fewer candidates than ``k`` are all returned; of rows
that repeat an id with different vectors the best counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, materialize, tidied
from .vectors import main_size, read_vectors, stacked

DIMENSIONS, BITS = 6, 10
CALIBRATION = 64
BLOCK_ROWS, LEAST_BLOCKS, QUERY_TILE = 16_384, 32, 4096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of integer points (rows x dimensions) in ``bits`` bits a dimension, as int64."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo excess work of the curve's rotations, from coarse to fine
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Random projections with shifts; ``keys`` gives one Hilbert key for each row and curve."""

    def __init__(self, d: int, most: float, curves: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        dims = min(DIMENSIONS, d + 1)
        self.most, self.curves = most, curves
        self.axes = [np.linalg.qr(rng.normal(size=(d + 1, dims)))[0] for _ in range(curves)]
        self.shifts = rng.uniform(-0.5, 0.5, (curves, dims))

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm2 = (x**2).sum(1)
        scale = np.where(query, self.most / np.sqrt(np.maximum(norm2, 1e-300)), 1.0) if query else np.ones(len(x))
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.most**2 - norm2, 0))
        full = np.column_stack([x * scale[:, None], extra]) / self.most
        out = []
        for axes, shift in zip(self.axes, self.shifts):
            # projections of unit vectors concentrate near 0: spread four deviations over the grid
            y = (full @ axes) * np.sqrt(full.shape[1]) / 4 + shift / 4
            cells = np.clip(((y + 1.25) / 2.5 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            out.append(hilbert(cells, BITS))
        return np.stack(out, axis=1)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Boolean mask of the entries of each row that could be among its ``k`` largest, ties kept."""
    if scores.shape[1] <= k:
        return np.ones_like(scores, bool)
    bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return scores >= bar[:, None] - 1e-9 * np.maximum(1.0, np.abs(bar[:, None]))


def best_of(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: list, k: int):
    """For each query (its id, ids, scores) of the ``k`` best of ``x``, whose rows carry several ids each."""
    for lo in range(0, len(queries), 512):
        q, own = queries[lo : lo + 512], query_ids[lo : lo + 512]
        keep = _top(q @ x.T, k + 1)
        for i in range(len(q)):
            at = np.flatnonzero(keep[i])
            exact = np.einsum("ij,ij->i", np.broadcast_to(q[i], (len(at), q.shape[1])), x[at])
            n = [len(ids[j]) for j in at]
            all_ids, all_scores = np.concatenate([ids[j] for j in at]), np.repeat(exact, n)
            other = all_ids != own[i]
            all_ids, all_scores = all_ids[other], all_scores[other]
            first = np.lexsort((all_ids, -all_scores))[:k]
            yield own[i], all_ids[first], all_scores[first]


PART = "query_id long, ids array<long>, scores array<double>"


def _merge(parts: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query over its partial results: query_id, rank, vec_id, score."""
    pairs = parts.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select("query_id", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@tidied
def search(emb: DataFrame, k: int = 20, every: int = 20, curves: int = 3, recall: float = 0.97) -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = emb.sparkSession
    rows = read_vectors(emb)
    d = main_size(rows)
    rows = rows.filter(F.col("ok") & (F.size("v") == d) & F.col("vec_id").isNotNull()).select("vec_id", "v", F.xxhash64("v").alias("key"))
    few = Window.partitionBy("key", "v").orderBy("vec_id")
    limited = rows.distinct().withColumn("n", F.row_number().over(few)).filter(F.col("n") <= k + 1)
    base = materialize(limited.groupBy("key", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "curve-base")
    queries = materialize(rows.filter(F.col("vec_id") % every == 0).select("vec_id", "v").distinct(), "curve-queries")
    there, asked = base.count(), queries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not there or not asked:
        return spark.createDataFrame([], schema)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    most = base.agg(F.max(norm)).first()[0]
    model = Curves(d, float(most), curves)

    def keyed(query: bool):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    keys = model.keys(stacked(pdf["v"], d), query)
                    who = np.tile(np.arange(len(pdf)), curves)
                    rest = {"query_id": pdf["vec_id"].to_numpy()[who]} if query else {"ids": [pdf["ids"].iat[i] for i in who]}
                    yield pd.DataFrame({"curve": np.repeat(np.arange(curves), len(pdf)), "place": keys.T.ravel(), **rest, "v": [pdf["v"].iat[i] for i in who]})

        return work

    on_curve = materialize(base.select("ids", "v").mapInPandas(keyed(False), "curve int, place long, ids array<long>, v array<double>"), "curve-keys")
    blocks = max(LEAST_BLOCKS, -(-there // BLOCK_ROWS))
    cuts = on_curve.groupBy("curve").agg(F.expr(f"percentile_approx(place, array({','.join(str(i / blocks) for i in range(1, blocks))}), 10000)").alias("cuts"))
    cuts = {r["curve"]: np.array(r["cuts"], np.int64) for r in cuts.collect()}  # blocks - 1 numbers a curve

    @F.pandas_udf("int")
    def block_of(curve: pd.Series, place: pd.Series) -> pd.Series:
        c, p = curve.to_numpy(), place.to_numpy()
        out = np.zeros(len(c), np.int32)
        for i, edges in cuts.items():
            out[c == i] = np.searchsorted(edges, p[c == i])
        return pd.Series(out)

    members = on_curve.withColumn("block", block_of("curve", "place"))
    asking = queries.mapInPandas(keyed(True), "curve int, place long, query_id long, v array<double>").withColumn("block", block_of("curve", "place"))

    half = _half_width(base, queries, model, cuts, blocks, k, recall, d)
    low, high = F.greatest(F.lit(0), F.col("block") - half), F.least(F.lit(blocks - 1), F.col("block") + half)
    asking = materialize(asking.select("curve", F.explode(F.sequence(low, high)).alias("block"), "query_id", "v"), "curve-asking")
    # a block's members travel to as many tiles as its own queries fill, and to none where none asks
    tiles = asking.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / QUERY_TILE).cast("int").alias("tiles"))
    tiles = bounded(tiles, blocks * curves)
    asking = asking.join(tiles, ["curve", "block"]).select("curve", "block", F.pmod(F.xxhash64("query_id"), F.col("tiles")).cast("int").alias("tile"), F.col("query_id").cast("string").alias("query_id"), "v", F.lit(None).cast("array<long>").alias("ids"))
    members = members.join(tiles, ["curve", "block"]).select("curve", "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(None).cast("string").alias("query_id"), "v", "ids")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        is_query = pdf["query_id"].notna()
        q, m = pdf[is_query], pdf[~is_query]
        if not len(q) or not len(m):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "ids": np.zeros(0, object), "scores": np.zeros(0, object)})
        got = list(best_of(stacked(q["v"], d), q["query_id"].astype("int64").to_numpy(), stacked(m["v"], d), m["ids"].tolist(), k))
        return pd.DataFrame(got, columns=["query_id", "ids", "scores"])

    parts = members.unionByName(asking).groupBy("curve", "block", "tile").applyInPandas(meet, PART)
    return _merge(parts, k)


def _half_width(base: DataFrame, queries: DataFrame, model: Curves, cuts: dict, blocks: int, k: int, recall: float, d: int) -> int:
    """Blocks to each side that find ``recall`` of the true neighbours of a sample of queries."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    qv, qid = stacked(some["v"], d), some["vec_id"].to_numpy()

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = stacked(pdf["v"], d)
                keys = model.keys(x, False)
                first = {int(i): j for j, ids in enumerate(pdf["ids"]) for i in ids}
                for own, ids, scores in best_of(qv, qid, x, pdf["ids"].tolist(), k):
                    if not len(ids):  # a batch that holds nothing but the query
                        continue
                    yield pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores, "keys": [keys[first[int(i)]] for i in ids]})

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = base.select("ids", "v").mapInPandas(exact, "query_id long, vec_id long, score double, keys array<long>")
    true = true.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "keys").toPandas()
    if not len(true):
        return blocks
    own = dict(zip(qid.tolist(), model.keys(qv, True)))
    there = np.stack(true["keys"].to_numpy())
    mine = np.stack([own[i] for i in true["query_id"]])
    gap = np.min([np.abs(np.searchsorted(cuts[c], there[:, c]) - np.searchsorted(cuts[c], mine[:, c])) for c in sorted(cuts)], axis=0)
    return int(np.quantile(gap, recall, method="higher"))
