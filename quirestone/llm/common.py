"""Helpers shared by the operators of this subpackage.

Intermediate tables are cut with :func:`materialize`: Parquet in the shared folder that the session
names in ``spark.checkpoint.dir``, so a lost executor never takes the only copy with it.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table may be broadcast only if it was counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this cluster; a fresh local one where none is set (tests, local mode)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if conf:
        return conf.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quirestone-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Tables written by the operators that are running, the outermost first; see :func:`tidied`.
_MADE: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidied(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator`` that deletes, before it returns its DataFrame, the tables it wrote that the DataFrame doesn't read."""

    @functools.wraps(operator)
    def run(*args, **options) -> DataFrame:
        _MADE.append([])
        try:
            out = operator(*args, **options)
            read = {f.rsplit("/", 2)[-2] for f in out.inputFiles()}
            for path in _MADE[-1]:
                if path.rsplit("/", 1)[1] not in read:
                    _delete(out.sparkSession, path)
                elif len(_MADE) > 1:
                    _MADE[-2].append(path)
            return out
        finally:
            _MADE.pop()

    return run


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    if _MADE:
        _MADE[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, label: str) -> DataFrame:
    """:func:`materialize`, after which the tables of the shared folder that ``df`` read are deleted."""
    spark, out = df.sparkSession, materialize(df, label)

    def plain(path: str) -> str:
        return re.sub(r"^\w+:/+", "/", path)

    root = plain(shared_dir(spark))
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        above, name = path.rsplit("/", 1)
        if plain(above) == root and re.search(r"-[0-9a-f]{32}$", name):
            _delete(spark, path)
    return out


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that no later plan reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, path)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows are few; otherwise Spark's own choice stands."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def texts_by_id(docs: DataFrame) -> DataFrame:
    """doc_id as text, and text, on their way through Python: pandas makes floats of whole numbers where some are null."""
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))


def long_ids(df: DataFrame) -> DataFrame:
    """The rows with ``doc_id`` a whole number again."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def doc_hash(column: str | Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def slots(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def even(df: DataFrame, least: int | None = None) -> DataFrame:
    """Deal rows out evenly when a scan gave fewer partitions than there are task slots."""
    n = least or 2 * slots(df.sparkSession)
    return df.repartition(n) if df.rdd.getNumPartitions() < slots(df.sparkSession) else df


_CACHES: dict[str, Callable[[], object]] = {}


def only_cache(name: str, clear: Callable[[], object]) -> None:
    """Called by an operator's code in a worker before it fills its cache: drops those of other operators.

    Workers live on through the stages of a pipeline; without this each would hold every stage's cache."""
    for other in [k for k in _CACHES if k != name]:
        _CACHES.pop(other)()
    _CACHES[name] = clear
