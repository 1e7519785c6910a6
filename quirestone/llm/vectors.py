"""What the operators on embeddings share: valid vectors, classes of equal vectors, bounded samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Different vectors taken to the driver to fit an index, about so many (kept by a hash of the vector).
SAMPLE_ROWS = 16_384


def is_valid(vector: Column) -> Column:
    """Not null, not empty, without null or non-finite components, and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def read_vectors(emb: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles), ok for each row."""
    v = F.col("embedding").cast("array<double>")
    return emb.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_valid(v).alias("ok"))


def main_size(rows: DataFrame) -> int:
    """The commonest length of valid vectors (the longest, on a tie); 0 if there are none."""
    top = rows.filter("ok").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0]["d"] if top else 0


def stacked(v: pd.Series, d: int) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, d))


def sample(df: DataFrame, there: int, d: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """About ``rows`` vectors of ``df(v)``, chosen by a hash of the vector, in a fixed order."""
    if there > rows:
        df = df.filter(F.pmod(F.xxhash64("v", F.lit(11)), F.lit(1 << 50)) < F.lit(int((1 << 50) * rows / there)))
    got = stacked(df.select("v").toPandas()["v"], d)
    return got[np.lexsort(got.T)] if len(got) else got


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of ``x`` (fewer than ``k`` if there are fewer different rows)."""
    rng = np.random.default_rng(seed)
    x = np.asarray(x, np.float64)
    k = max(1, min(k, len(x)))
    c = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The place of each row's nearest centroid, worked out in blocks of bounded size."""
    out, norms, step = np.zeros(len(x), np.int64), (c**2).sum(1), max(1, (1 << 22) // max(1, len(c)))
    for lo in range(0, len(x), step):
        out[lo : lo + step] = np.argmin(norms - 2 * x[lo : lo + step] @ c.T, axis=1)
    return out
