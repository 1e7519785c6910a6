"""Review index tables: project and element columns carried down, references to pages, and folders from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.rank import top

# The index's title, the root of its entries, and elements named by a phrase of the row.
INDEX_TITLE = "商务评审索引表"
ROOT = "商务文件 / 补充文件 / “商务评分标准”涉及的支撑材料"
ROW_ELEMENTS = {"影响评标工作公正性行为": "影响评标工作公正性行为的凭证", "报价文件完整性": "报价质量"}
REFERENCE = r"(?:详见)?第(\d+)页[:：]([^第]+?)(?=(?:详见)?第\d+页[:：]|$)"
SCORES = r"[（(]?\s*[-\d]+(?:\s*[-~—至]\s*[-\d]+)*\s*[)）]?"
EDGES = "：:；;，,"


def clean_label(x: Column) -> Column:
    """A label without white space, score ranges and separators at its ends."""
    t = F.regexp_replace(T.compact(F.coalesce(x, F.lit(""))), r"[（(]\s*[-\d]+(?:\s*[-~—至]\s*[-\d]+)*\s*[)）]?$", "")
    return F.when(t.rlike(f"^{SCORES}$"), "").otherwise(F.btrim(t, F.lit(EDGES)))


def index_key(x: Column) -> Column:
    t = F.regexp_replace(T.compact(F.coalesce(x, F.lit(""))), r"^[\d.]+[、.．]\s*", "")
    t = F.replace(F.replace(t, F.lit("（无）"), F.lit("")), F.lit("(无)"), F.lit(""))
    return F.lower(F.regexp_replace(t, r"[“”\"'‘’、，,。:：；;（）()\\/－—_-]", ""))


def label_variants(x: Column) -> Column:
    t = F.btrim(F.regexp_replace(T.compact(F.coalesce(x, F.lit(""))), r"^[\d.]+[、.．]\s*", ""), F.lit(" " + EDGES))
    tails = [F.when(F.contains(t, F.lit(d)), F.element_at(F.split(t, d), -1)) for d in "-－—"]
    return F.filter(F.array_compact(F.array(t, *tails)), lambda v: v != "")


def carry_down(rows: DataFrame, project: str, element: str, ord: str, keys: list[str], fallback: Column | None = None) -> DataFrame:
    """Blank projects and elements take the last value above; an element may come from the row's text."""
    w = Window.partitionBy(*keys).orderBy(ord).rowsBetween(Window.unboundedPreceding, 0)
    own = F.nullif(F.col(element), F.lit(""))
    if fallback is not None:
        own = F.coalesce(own, F.nullif(fallback, F.lit("")))
    return rows.withColumn(project, F.last(F.nullif(F.col(project), F.lit("")), ignorenulls=True).over(w)).withColumn(element, F.last(own, ignorenulls=True).over(w))


def entries(blocks: DataFrame, tables: DataFrame) -> DataFrame:
    """Entries of documents that have the index's title, from tables on pages 2 to 7, in order."""
    titled = blocks.filter(F.contains(F.coalesce("text", F.lit("")), F.lit(INDEX_TITLE))).select("doc_id").distinct()
    rows = tables.filter(F.col("page_no").between(2, 7)).join(titled, "doc_id", "left_semi").select("doc_id", "page_no", "table_id", F.posexplode("rows").alias("row_no", "r"))
    rows = rows.filter(~(F.contains(F.coalesce(F.try_element_at("r", F.lit(1)), F.lit("")), F.lit("项目")) & F.contains(F.coalesce(F.try_element_at("r", F.lit(2)), F.lit("")), F.lit("评审要素"))))
    whole = T.compact(F.array_join("r", ""))
    named = F.lit("")
    for phrase, element in reversed(ROW_ELEMENTS.items()):
        named = F.when(F.contains(whole, F.lit(phrase)), element).otherwise(named)
    rows = rows.select("doc_id", "page_no", "table_id", "row_no", "r", clean_label(F.try_element_at("r", F.lit(1))).alias("project_label"), clean_label(F.try_element_at("r", F.lit(2))).alias("element_label"), named.alias("named"), F.struct("page_no", "table_id", "row_no").alias("at"))
    rows = carry_down(rows, "project_label", "element_label", "at", ["doc_id"], F.col("named"))
    cells = rows.filter("project_label is not null and element_label is not null").select("doc_id", "at", "project_label", "element_label", F.posexplode(F.slice("r", 3, 1000)).alias("col", "cell"))
    plain = F.regexp_replace(F.coalesce("cell", F.lit("")), r"\n", "")
    refs = cells.select("*", F.posexplode(F.arrays_zip(F.regexp_extract_all(plain, F.lit(REFERENCE), F.lit(1)).alias("page"), F.regexp_extract_all(plain, F.lit(REFERENCE), F.lit(2)).alias("title"))).alias("n", "x"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("at", "col", "n"))
    return refs.select(
        "doc_id", order.alias("ord"), F.concat_ws(" / ", F.lit(ROOT), "project_label", "element_label").alias("section_path"), "project_label", "element_label",
        F.btrim(F.col("x.title"), F.lit(" " + EDGES)).alias("title"), F.col("x.page").cast("int").alias("page_start"),
    )


def score_paths(labels: DataFrame, paths: DataFrame) -> DataFrame:
    """``labels(doc_id, label)`` with the first path (by ``ord``) whose leaf equals a variant, else contains or is contained in one."""
    keys = labels.distinct().select("*", F.transform(label_variants(F.col("label")), index_key).alias("variants"))
    p = paths.select("doc_id", "ord", "section_path", index_key(T.path_leaf(F.col("section_path"))).alias("leaf"))
    j = keys.join(p, "doc_id")
    tier = F.when(F.array_contains("variants", F.col("leaf")), 0).when(F.exists("variants", lambda v: (v != "") & (F.contains(F.col("leaf"), v) | F.contains(v, F.col("leaf")))), 1)
    return top(j.withColumn("tier", tier).filter("tier is not null"), ["doc_id", "label"], [F.asc("tier"), F.asc("ord")]).select("doc_id", "label", "section_path")


def aligned(entries_: DataFrame, paths: DataFrame) -> DataFrame:
    """Entries on their score paths: by title, else by element, else the path that the entry before resolved to."""
    by_title = score_paths(entries_.select("doc_id", F.col("title").alias("label")), paths).select("doc_id", F.col("label").alias("title"), F.col("section_path").alias("by_title"))
    by_element = score_paths(entries_.select("doc_id", F.col("element_label").alias("label")), paths).select("doc_id", F.col("label").alias("element_label"), F.col("section_path").alias("by_element"))
    j = entries_.join(by_title, ["doc_id", "title"], "left").join(by_element, ["doc_id", "element_label"], "left")
    w = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumn("score_path", F.last(F.coalesce("by_title", "by_element"), ignorenulls=True).over(w)).drop("by_title", "by_element")


def title_blocks(entries_: DataFrame, blocks: DataFrame) -> DataFrame:
    """The heading of each entry on its start page: equal, containing or contained; top-most, then shortest."""
    b = blocks.select("doc_id", F.col("page_no").alias("page_start"), "block_id", F.col("bbox")[1].alias("start_y"), T.compact(F.col("text")).alias("line"))
    key = T.compact(F.col("title"))
    hit = (F.col("line") != "") & ((F.col("line") == key) | F.contains("line", key) | F.contains(key, F.col("line")))
    best = top(entries_.join(b, ["doc_id", "page_start"]).filter(hit), ["doc_id", "ord"], [F.asc("start_y"), F.length("line").asc(), F.asc("block_id")])
    return entries_.join(best.select("doc_id", "ord", "block_id", "start_y"), ["doc_id", "ord"], "left")


def folder_ranges(entries_: DataFrame, last_page: Column | None = None, ord: str = "ord") -> DataFrame:
    """Each entry to the next one: up to the page before it, or to its height on that page when both are known."""
    w = Window.partitionBy("doc_id").orderBy("page_start", ord)
    e = entries_.withColumn("next_page", F.lead("page_start").over(w))
    if "start_y" in entries_.columns:
        e = e.withColumn("next_y", F.lead("start_y").over(w))
        precise = F.col("start_y").isNotNull() & F.col("next_y").isNotNull()
        end = F.when(precise, F.col("next_page")).otherwise(F.greatest("page_start", F.col("next_page") - 1))
        e = e.withColumn("end_y", F.when(precise, F.col("next_y")))
    else:
        end = F.greatest("page_start", F.col("next_page") - 1)
    rest = F.col("page_start") if last_page is None else last_page
    return e.withColumn("page_end", F.when(F.col("next_page").isNull(), rest).otherwise(end))


def index_tree(entries_: DataFrame) -> DataFrame:
    """Entries by element, elements by project."""
    by_element = entries_.groupBy("doc_id", "project_label", "element_label").agg(F.min("ord").alias("ord"), F.array_sort(F.collect_list(F.struct("ord", "title", "page_start"))).alias("entries"))
    return by_element.groupBy("doc_id", "project_label").agg(F.array_sort(F.collect_list(F.struct("ord", "element_label", "entries"))).alias("elements"))
