"""Embedding near-duplicates through product quantisation and coarse inverted lists.

Equal vectors are one class. Unit vectors of a bounded sample (``SAMPLE_ROWS``) fit coarse centroids and
residual codebooks; every class is indexed in its nearest list with one code per subspace and its own
quantisation error. Links between vectors at cosine ``c`` or more lie within ``delta = sqrt(2 - 2c)``. The
border of two lists is the hyperplane between their centroids, and a link across it is at least as long as
both its ends' distances from it together, so one end is within ``delta / 2``. A class visits every list whose
border is that near: no link is missed, whatever the vectors' dimension. Where both ends visit each other's
list, the pair counts in the list of the later one only.

In a list, asymmetric distances come from lookup tables (one per visitor and subspace) and pass pairs at
``delta`` plus the member's quantisation error, which by the triangle inequality drops no link; the
cosine of what passes is then taken in double precision from the original vectors. Lists are cut into
tiles of bounded size, so a crowded list is many tasks. A tile gives link counts by class and a forest of
its links, never the pairs.

Defined cases: null, empty or zero vectors, vectors with null or non-finite components, and vectors whose
length isn't the commonest one link with nothing; rows that repeat a vector link with each other; null
ids stay null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidied
from .graph import components, forest
from .vectors import SAMPLE_ROWS, k_means, main_size, nearest, read_vectors, sample, stacked

THRESHOLD = 0.95
MEMBERS, VISITORS = 1024, 4096
NO_ID = -(1 << 62)
PLACED = "list int, visitor boolean, id long, n_same long, v binary, codes binary, error double, home int, visits binary"
TRAVEL = ["id", "n_same", "v", "codes", "error", "home", "visits"]


class Index:
    """Coarse centroids and residual codebooks of unit vectors, fitted on a sample."""

    def __init__(self, x: np.ndarray, lists: int, subspaces: int = 8, codes: int = 64):
        self.coarse = k_means(x, lists)
        d = self.coarse.shape[1]
        self.parts = np.array_split(np.arange(d), min(subspaces, d))
        rest = x - self.coarse[nearest(x, self.coarse)]
        self.books = [k_means(rest[:, p], codes) for p in self.parts]

    def home(self, x: np.ndarray) -> np.ndarray:
        return nearest(x, self.coarse)

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes by subspace, and the distance from each vector to its reconstruction."""
        rest = x - self.coarse[home]
        codes = np.stack([nearest(rest[:, p], b) for p, b in zip(self.parts, self.books)], axis=1)
        error = sum(((rest[:, p] - b[codes[:, i]]) ** 2).sum(1) for i, (p, b) in enumerate(zip(self.parts, self.books)))
        return codes.astype(np.uint8), np.sqrt(error)

    def probes(self, x: np.ndarray, home: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for the other lists whose border with the row's own list is within ``reach``."""
        norms, rows, lists = (self.coarse**2).sum(1), [], []
        for lo in range(0, len(x), 512):
            y, own = x[lo : lo + 512], home[lo : lo + 512]
            d2 = norms - 2 * y @ self.coarse.T  # less |y|^2, which drops out
            gap = np.sqrt(np.maximum(norms[own][:, None] + norms - 2 * self.coarse[own] @ self.coarse.T, 1e-18))
            margin = (d2 - d2[np.arange(len(y)), own][:, None]) / (2 * gap)
            margin[np.arange(len(y)), own] = np.inf
            at, to = np.nonzero(margin <= reach)
            rows.append(at + lo)
            lists.append(to)
        return np.concatenate(rows), np.concatenate(lists)

    def distances(self, visitors: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
        """Squared asymmetric distances of visitors to the coded members of one list."""
        rest = visitors - self.coarse[place]
        total = np.zeros((len(visitors), len(codes)), np.float32)
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            table = ((rest[:, p] ** 2).sum(1)[:, None] + (b**2).sum(1) - 2 * rest[:, p] @ b.T).astype(np.float32)
            total += table[:, codes[:, i]]
        return np.maximum(total, 0)


def _tiles(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members and visitors of each list in tiles (list, i, j): member tile i against visitor tile j, or member tile j when ``own``."""
    k = F.ceil(F.col("members") / MEMBERS).cast("int")
    n = F.ceil(F.col("visitors") / VISITORS).cast("int")
    p = placed.join(sizes, "list").withColumn("k", k).withColumn("n", n)
    mine = F.pmod(F.xxhash64("id"), F.when(F.col("visitor"), F.col("n")).otherwise(F.col("k"))).cast("int")
    p = p.withColumn("t", mine)

    def upto(m):
        return F.sequence(F.lit(0), m - 1)

    none = F.array().cast("array<struct<own:boolean,i:int,j:int,side:int>>")

    def cell(own: bool, i, j, side):
        return F.struct(F.lit(own).alias("own"), i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    t = F.col("t")
    as_visitor = F.when(F.col("k") > 0, F.transform(upto(F.col("k")), lambda i: cell(False, i, t, F.lit(1)))).otherwise(none)
    as_member = F.when(F.col("n") > 0, F.transform(upto(F.col("n")), lambda j: cell(False, t, j, F.lit(0)))).otherwise(none)
    own = F.transform(upto(F.col("k")), lambda o: cell(True, F.least(t, o), F.greatest(t, o), F.when(o < t, 1).otherwise(0)))
    cells = F.when(F.col("visitor"), as_visitor).otherwise(F.concat(as_member, own))
    return p.select("list", *TRAVEL, F.explode(cells).alias("c")).select("list", "c.*", *TRAVEL)


def _twice(home: np.ndarray, member_visits: list[bytes], place: int) -> dict[int, np.ndarray]:
    """For each visitors' list after ``place``: the members that visit it, whose pairs with its visitors count there."""
    visits = [np.frombuffer(v, "<i4") for v in member_visits]
    owner = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
    flat = np.concatenate(visits) if visits else np.zeros(0, np.int32)
    out = {}
    for h in np.unique(home[home > place]):
        mask = np.zeros(len(visits), bool)
        mask[owner[flat == h]] = True
        out[int(h)] = mask
    return out


@tidied
def linked(emb: DataFrame, threshold: float = THRESHOLD, lists: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row."""
    rows = read_vectors(emb)
    d = main_size(rows)
    rows = rows.select(F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "v", (F.col("ok") & (F.size("v") == d)).alias("ok"))
    classes = materialize(rows.filter("ok").withColumn("key", F.xxhash64("v")).groupBy("key", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_same")), "pq-classes")
    there = classes.count()
    spark = emb.sparkSession
    if there:
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        lists = lists or int(max(16, math.sqrt(there) / 2))
        fit = sample(classes.select(F.transform("v", lambda x: x / norm).alias("v")), there, d, max(SAMPLE_ROWS, 4 * lists))
        index = Index(fit, lists)
        shared = spark.sparkContext.broadcast(index)
        delta = math.sqrt(max(0.0, 2 - 2 * threshold))
        reach = delta / 2 + 1e-6

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ix = shared.value
            for pdf in batches:
                if not len(pdf):
                    continue
                x = stacked(pdf["v"], d)
                x /= np.linalg.norm(x, axis=1)[:, None]
                home = ix.home(x)
                codes, error = ix.encode(x, home)
                at, to = ix.probes(x, home, reach)
                visits = [v.astype("<i4").tobytes() for v in np.split(to, np.searchsorted(at, np.arange(1, len(x))))]
                who = np.concatenate([np.arange(len(x)), at])
                visitor = np.repeat([False, True], [len(x), len(at)])
                yield pd.DataFrame({
                    "list": np.concatenate([home, to]), "visitor": visitor, "id": pdf["id"].to_numpy()[who], "n_same": pdf["n_same"].to_numpy()[who],
                    "v": [pdf["v"].iat[i].astype("<f8").tobytes() for i in who], "codes": [codes[i].tobytes() for i in who], "error": error[who],
                    "home": home[who], "visits": [*visits, *[b""] * len(at)],
                })

        placed = materialize(classes.select("id", "n_same", "v").mapInPandas(place, PLACED), "pq-placed")
        sizes = placed.groupBy("list").agg(F.count_if(~F.col("visitor")).alias("members"), F.count_if("visitor").alias("visitors"))

        def tile(pdf: pd.DataFrame) -> pd.DataFrame:
            ix = shared.value
            place_, own, same_tile = int(pdf["list"].iat[0]), bool(pdf["own"].iat[0]), pdf["i"].iat[0] == pdf["j"].iat[0]
            pdf = pdf.sort_values("id", ignore_index=True)
            side = pdf["side"].to_numpy()
            x = np.frombuffer(b"".join(pdf["v"]), "<f8").reshape(len(pdf), d)
            u = x / np.linalg.norm(x, axis=1)[:, None]
            codes = np.frombuffer(b"".join(pdf["codes"]), np.uint8).reshape(len(pdf), -1)
            ids, n, error = pdf["id"].to_numpy(), pdf["n_same"].to_numpy(), pdf["error"].to_numpy()
            members = np.flatnonzero(side == 0)
            visitors = members if own and same_tile else np.flatnonzero(side == 1)
            limit = (delta + error[members] + 1e-5) ** 2
            links = np.zeros((len(visitors), len(members)), bool)
            for lo in range(0, len(visitors), 256):
                who = visitors[lo : lo + 256]
                likely = ix.distances(u[who], place_, codes[members]) <= limit
                r, c = np.nonzero(likely)
                for at in range(0, len(r), 65_536):
                    i, j = r[at : at + 65_536], c[at : at + 65_536]
                    cosine = np.einsum("ij,ij->i", u[who[i]], u[members[j]])
                    links[lo + i, j] = cosine >= threshold
            if not own:
                home = pdf["home"].to_numpy()[visitors]
                for h, mask in _twice(home, pdf["visits"].iloc[members].tolist(), place_).items():
                    links[np.ix_(home == h, mask)] = False
            if own and same_tile:
                links &= ids[visitors][:, None] > ids[members]
            count = np.zeros(len(pdf), np.int64)
            count[visitors] += links @ n[members]
            count[members] += n[visitors] @ links
            edges = forest(links, ids[visitors], ids[members])
            has = np.flatnonzero(count)
            return pd.DataFrame({
                "id": np.concatenate([ids[has], np.array([e[0] for e in edges], np.int64)]),
                "links": np.concatenate([count[has], np.zeros(len(edges), np.int64)]),
                "other": np.concatenate([ids[has], np.array([e[1] for e in edges], np.int64)]),
            })

        found = materialize(_tiles(placed, sizes).groupBy("list", "own", "i", "j").applyInPandas(tile, "id long, links long, other long"), "pq-found")
        reach_by = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
        counts = found.groupBy("id").agg(F.sum("links").alias("links"))
        labelled = classes.join(counts, "id", "left").join(reach_by.withColumnRenamed("node", "id"), "id", "left")
    else:
        labelled = classes.withColumn("links", F.lit(0)).withColumn("component", F.col("id"))
    labelled = materialize(labelled.select("key", "v", (F.coalesce("links", F.lit(0)) + F.col("n_same") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")), "pq-labels")
    good = rows.filter("ok").withColumn("key", F.xxhash64("v")).join(labelled, ["key", "v"]).select("id", "n_links", "component_id")
    rest = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = good.union(rest)

    def real(c: str):
        return F.when(F.col(c) != NO_ID, F.col(c))

    return out.select(real("id").alias("vec_id"), "n_links", real("component_id").alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))
