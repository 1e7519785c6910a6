"""Selection and ordering patterns; every order ends with an ordinal, because Spark's sort isn't stable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, keys: list[str], order: list[Column], k: int = 1, name: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group; ``name`` keeps the rank. Spark limits ranks before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    column = name or "_rank"
    out = df.withColumn(column, rank).filter(F.col(column) <= k)
    return out if name else out.drop(column)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows without those whose keys came before in the order."""
    return top(df, keys, order)


def reading_order(df: DataFrame, order: list[Column], keys: tuple[str, ...] = ("doc_id",), name: str = "reading_order") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def preceding(items: DataFrame, marks: DataFrame, keys: list[str], page: str, y: str, carry: dict[str, str]) -> DataFrame:
    """Each item with columns of the last mark strictly before it in (page, y).

    One union and one window instead of an inequality join: at equal places items sort before marks, and
    among marks at one place the first wins. ``carry`` maps the marks' columns to their new names."""
    order_item = "_item"
    got = marks.groupBy(*keys, page, y).agg(F.min(F.struct(F.col("ord"), *carry)).alias("_mark"))
    left = items.withColumn(order_item, F.lit(0)).withColumn("_mark", F.lit(None).cast(got.schema["_mark"].dataType))
    right = got.withColumn(order_item, F.lit(1))
    both = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(page, y, order_item).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_last", F.last("_mark", ignorenulls=True).over(w)).filter(F.col(order_item) == 0)
    return both.select(*items.columns, *[F.col(f"_last.{c}").alias(n) for c, n in carry.items()])


def forward_fill(df: DataFrame, levels: list[str], keys: list[str], ord: str) -> DataFrame:
    """Hierarchical fill: a value at a level clears the deeper ones; blanks take the value above them."""
    out = df
    for i, level in enumerate(levels):
        group = f"_g{i}"
        seen = F.lit(False)
        for upper in levels[:i]:
            seen = seen | (F.coalesce(F.col(f"_raw_{upper}"), F.lit("")) != "")
        out = out.withColumn(f"_raw_{level}", F.col(level))
        w = Window.partitionBy(*keys).orderBy(ord).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(group, F.sum(seen.cast("int")).over(w))
        inside = Window.partitionBy(*keys, group).orderBy(ord).rowsBetween(Window.unboundedPreceding, 0)
        value = F.last(F.when(F.col(f"_raw_{level}") != "", F.col(f"_raw_{level}")), ignorenulls=True).over(inside)
        out = out.withColumn(level, F.coalesce(value, F.lit("")))
    return out.drop(*[f"_raw_{x}" for x in levels], *[f"_g{i}" for i in range(len(levels))])
