"""Lookup of material by path or title: a cascade of tiers, over one run or the runs of a project."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import text as T
from ..plans.rank import top

FUZZY, GAP = 0.55, 0.15
TIERS = ("exact_path", "normalized_path", "title", "fuzzy")
SCORES = (1.0, 0.98, 0.95)


def index(materials: DataFrame) -> DataFrame:
    """``materials(run_name, material_path, section_path, title, ...)`` with normalised keys."""
    return materials.withColumn("path_key", T.lookup_key(F.col("section_path"))).withColumn("material_key", T.lookup_key(F.col("material_path"))).withColumn("title_key", title_key(F.col("title")))


def title_key(x: Column) -> Column:
    return T.lookup_key(T.strip_numbering(x))


def similarity(query: str, title: str) -> float:
    """1 for equal or contained titles, else the better of difflib's ratio and the share of characters found in order."""
    if not query or not title:
        return 0.0
    if query in title or title in query:
        return 1.0
    at, found = 0, 0
    for c in query:
        place = title.find(c, at)
        if place >= 0:
            found, at = found + 1, place + 1
    return max(SequenceMatcher(None, query, title).ratio(), found / len(query))


@F.pandas_udf(DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x or "", y or "") for x, y in zip(a, b)], dtype=float)


def lookup(materials: DataFrame, requests: DataFrame, k: int = 5) -> DataFrame:
    """``requests(request_id, section_path, title)`` against an index: the matches of the best tier, at most ``k``.

    Exact tiers are equi-joins; only requests that none of them answers reach the fuzzy tier."""
    k = max(1, int(k or 5))
    r = requests.select("request_id", F.trim(F.coalesce("section_path", F.lit(""))).alias("path"), F.trim(F.coalesce("title", F.lit(""))).alias("asked"))
    r = r.withColumn("path_q", T.lookup_key(F.col("path"))).withColumn("title_q", title_key(F.when(F.col("asked") != "", F.col("asked")).otherwise(T.path_leaf(F.col("path")))))
    m = materials.withColumn("len", F.length("title_key"))

    def tier(n: int, left: DataFrame, on: Column, score) -> DataFrame:
        return left.join(m, on).withColumn("tier", F.lit(n)).withColumn("score", F.lit(score) if not isinstance(score, Column) else score)

    paths = r.filter("path <> ''")
    hits = [
        tier(0, paths, F.col("path") == F.col("section_path"), 1.0), tier(0, paths, F.col("path") == F.col("material_path"), 1.0),
        tier(1, paths, F.col("path_q") == F.col("path_key"), 0.98), tier(1, paths, F.col("path_q") == F.col("material_key"), 0.98),
        tier(2, r.filter("title_q <> ''"), F.col("title_q") == F.col("title_key"), 0.95),
    ]
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    left = r.filter("title_q <> ''").join(found.select("request_id").distinct(), "request_id", "left_anti")
    keys = m.select("title_key").distinct().crossJoin(F.broadcast(left.select("title_q").distinct())).withColumn("s", _similarity(F.col("title_q"), F.col("title_key"))).filter(F.col("s") >= FUZZY)
    fuzzy = left.join(keys, "title_q").join(m, "title_key").withColumn("tier", F.lit(3)).withColumn("score", F.col("s")).drop("s")
    found = found.unionByName(fuzzy.select(*found.columns))
    best = found.withColumn("_t", F.min("tier").over(Window.partitionBy("request_id"))).filter("tier = _t").drop("_t")
    once = top(best, ["request_id", "run_name", "section_path", "material_path"], [F.desc("score")])
    ranked = top(once, ["request_id"], [F.desc("score"), F.when(F.col("tier") == 3, F.col("len")).otherwise(0).asc(), F.asc("section_path"), F.asc("run_name")], k, "rank")
    return ranked.select("request_id", "rank", "run_name", "section_path", "material_path", F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("tier") + 1).alias("match_type"), "score")


def status(requests: DataFrame, found: DataFrame) -> DataFrame:
    """matched, ambiguous (several non-fuzzy matches, or a second fuzzy one within 0.15) or not_found, after the cut to k."""
    s = found.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n"), F.first("match_type").alias("match_type"), F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("s1"), F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("s2"),
    )
    close = (F.col("s2") >= FUZZY) & (F.col("s1") - F.col("s2") <= GAP)
    state = F.when(F.col("n").isNull(), "not_found").when(F.coalesce(close, F.lit(False)), "ambiguous").otherwise("matched")
    return requests.select("request_id").join(s, "request_id", "left").select("request_id", state.alias("status"), "match_type", F.coalesce("n", F.lit(0)).alias("n"))


def routed_runs(requests: DataFrame, projects: DataFrame) -> DataFrame:
    """``projects(project_id, file_type, run_name)``: runs of the request's first path part; all runs, if it names none."""
    r = requests.withColumn("root", T.lookup_key(F.coalesce(F.try_element_at(T.path_parts(F.col("section_path")), F.lit(1)), F.lit(""))))
    p = projects.withColumn("type_key", T.lookup_key(F.col("file_type")))
    j = r.join(p, "project_id").withColumn("same", F.col("type_key") == F.col("root"))
    some = F.max("same").over(Window.partitionBy("request_id"))
    return j.withColumn("some", some).filter(~F.col("some") | F.col("same")).drop("some", "same", "type_key", "root")


def project_status(answers: DataFrame) -> DataFrame:
    """One answer for each request from those of its runs ``(request_id, run_name, status, match_type, n)``.

    The only run of the best tier wins; several of them, or candidates without any match, are ambiguous (multi_run); else not_found."""
    tier = F.array_position(F.array(*map(F.lit, TIERS)), F.col("match_type"))
    matched = F.col("status") == "matched"
    rank = F.when(matched, F.when(tier > 0, tier).otherwise(F.lit(len(TIERS) + 1)))
    best = F.min(rank).over(Window.partitionBy("request_id"))
    a = answers.withColumn("_best", F.when(matched & (rank == best), F.struct("run_name", "match_type")))
    g = a.groupBy("request_id").agg(F.count("_best").alias("ties"), F.min("_best").alias("x"), F.coalesce(F.sum("n"), F.lit(0)).alias("found"))
    one = F.col("ties") == 1
    none = (F.col("ties") == 0) & (F.col("found") == 0)
    return g.select("request_id", F.when(one, "matched").when(none, "not_found").otherwise("ambiguous").alias("status"), F.when(one, F.col("x.match_type")).when(none, "not_found").otherwise("multi_run").alias("match_type"), F.when(one, F.col("x.run_name")).alias("run_name"))


def evidence(items: DataFrame) -> DataFrame:
    """Distinct sorted pages of each material, and its items but for texts of tables."""
    rows = F.when((F.col("item_type") != "text") | (F.coalesce("role", F.lit("")) != "table_text"), F.struct("n", "item_type", "page_no", "item_id"))
    return items.groupBy("doc_id", "scope_id").agg(F.sort_array(F.collect_set("page_no")).alias("pages"), F.sort_array(F.collect_list(rows)).alias("evidence"))
