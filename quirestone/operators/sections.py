"""Blocks, tables of contents, sections and their hierarchy."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ids import stable_id
from ..plans.rank import top

BLOCK_SCHEMA = "doc_id long, block_id string, page_no int, block_no int, text string, bbox array<double>, source_type string, font_size double"
#: Prefixes of headings, and titles of pages that list contents.
HEADING_PREFIXES = ("一、", "二、", "三、", "四、", "五、", "（一）", "(一)", "1.", "1.1")
DIRECTORY_TITLES = ("目录", "目次", "目录页")
DIRECTORY_LINE = r"\.{2,}|…{2,}|第?\d+页?$"


def doc_window(*order) -> Window:
    return Window.partitionBy("doc_id").orderBy(*order)


def blocks_from_text(docs: DataFrame, lines_per_page: int = 20) -> DataFrame:
    """Synthetic page blocks of plain texts: a block for each non-blank line, laid out by arithmetic alone."""
    b = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("block_no", "text")).filter(F.trim("text") != "")
    y = (F.col("block_no") % lines_per_page) * 40
    box = F.array(F.lit(72.0), y.cast("double"), (72 + F.least(F.length("text"), F.lit(90)) * 5).cast("double"), (y + 12).cast("double"))
    return b.select(
        "doc_id", F.concat_ws("-", F.col("doc_id").cast("string"), F.col("block_no").cast("string")).alias("block_id"), (F.floor(F.col("block_no") / lines_per_page) + 1).cast("int").alias("page_no"),
        "block_no", "text", box.alias("bbox"), F.lit("pdf_text").alias("source_type"), F.when(F.col("block_no") == 0, 16.0).otherwise((10 + F.length("text") % 3).cast("double")).alias("font_size"),
    )


def add_ocr(blocks: DataFrame, ocr: DataFrame) -> DataFrame:
    """``ocr(doc_id, page_no, ord, text, bbox, confidence)`` numbered after the last block of its page, and added."""
    last = blocks.groupBy("doc_id", "page_no").agg(F.max("block_no").alias("last"))
    rows = ocr.filter(T.clean_text(F.col("text")) != "").join(last, ["doc_id", "page_no"], "left")
    n = F.row_number().over(Window.partitionBy("doc_id", "page_no").orderBy("ord"))
    rows = rows.withColumn("block_no", (F.coalesce("last", F.lit(-1)) + n).cast("int"))
    rows = rows.withColumn("block_id", stable_id("block", F.col("doc_id"), F.lit("ocr"), F.col("page_no"), F.col("block_no"))).withColumn("source_type", F.lit("ocr"))
    return blocks.unionByName(rows.drop("last", "ord"), allowMissingColumns=True)


def toc_leaves(toc: DataFrame) -> DataFrame:
    """``toc(doc_id, ord, level, title, page)`` with ``is_leaf``: the next entry isn't deeper."""
    following = F.lead("level").over(doc_window("ord"))
    return toc.withColumn("is_leaf", following.isNull() | (following <= F.col("level")))


def toc_paths(toc: DataFrame, deepest: int = 9) -> DataFrame:
    """Each entry's path of ancestor titles: for every level the last title since a shallower one, as windows."""
    out, parts = toc, []
    for k in range(1, deepest + 1):
        groups = F.sum((F.col("level") < k).cast("int")).over(doc_window("ord").rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumn(f"_g{k}", groups)
        inside = Window.partitionBy("doc_id", f"_g{k}").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(f"_t{k}", F.last(F.when(F.col("level") == k, F.col("title")), ignorenulls=True).over(inside))
        parts.append(F.when(F.col("level") >= k, F.col(f"_t{k}")))
    out = out.withColumn("section_path", F.array_join(F.array_compact(F.array(*parts)), " / "))
    return out.drop(*[f"_{x}{k}" for x in "gt" for k in range(1, deepest + 1)])


def page_edges(blocks: DataFrame) -> DataFrame:
    """First and last block of each page."""
    return blocks.groupBy("doc_id", "page_no").agg(F.min_by("block_id", "block_no").alias("first_block"), F.max_by("block_id", "block_no").alias("last_block"))


def sections_from_toc(toc: DataFrame, blocks: DataFrame) -> DataFrame:
    last = blocks.groupBy("doc_id").agg(F.max("page_no").alias("last_page"))
    t = toc.join(last, "doc_id", "left").withColumn("next_page", F.coalesce(F.lead("page").over(doc_window("ord")), F.coalesce("last_page", F.lit(1)) + 1))
    title = T.strip(F.col("title"))
    t = t.withColumn("page_start", F.col("page")).withColumn("page_end", F.greatest("page", F.col("next_page") - 1))
    e = page_edges(blocks)
    t = t.join(e.select("doc_id", F.col("page_no").alias("page_start"), F.col("first_block").alias("block_start_id")), ["doc_id", "page_start"], "left")
    t = t.join(e.select("doc_id", F.col("page_no").alias("page_end"), F.col("last_block").alias("block_end_id")), ["doc_id", "page_end"], "left")
    n = (F.row_number().over(doc_window("ord")) - 1).alias("n")
    t = t.select("*", n)
    return t.select(
        "doc_id", stable_id("section", F.lit("toc"), F.col("n"), title).alias("section_id"), title.alias("title"), T.normalize_title(F.col("title")).alias("normalized_title"),
        F.col("level").cast("int").alias("level"), F.col("page_start").cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), "block_start_id", "block_end_id", F.lit("toc").alias("source_type"), F.col("n").cast("int").alias("ord"),
    )


def heading_blocks(blocks: DataFrame, keywords: list[str] = ()) -> DataFrame:
    """Short blocks in larger type than the document's median plus 1, with a known prefix, or named like a rule."""
    size = F.when(F.col("font_size") > 0, F.col("font_size"))
    median = blocks.groupBy("doc_id").agg(F.coalesce(F.median(size) + 1.0, F.lit(12.0)).alias("threshold"))
    text = T.strip(F.coalesce("text", F.lit("")))
    prefix = F.lit(False)
    for p in HEADING_PREFIXES:
        prefix = prefix | F.startswith(text, F.lit(p))
    named = F.lit(False)
    if keywords:
        key = T.normalize_title(F.col("text"))
        named = F.exists(F.array(*[F.lit(k) for k in keywords if k]), lambda k: F.contains(key, k) | F.contains(k, key))
    b = blocks.join(median, "doc_id")
    return b.filter((text != "") & (F.length(text) <= 50) & (F.coalesce(size >= F.col("threshold"), F.lit(False)) | prefix | named)).drop("threshold")


def sections_from_blocks(blocks: DataFrame, keywords: list[str] = ()) -> DataFrame:
    """A section from each heading to the next; a document without headings is one section of all its pages."""
    ends = blocks.groupBy("doc_id").agg(
        F.min_by("page_no", F.struct("page_no", "block_no")).alias("first_page"), F.max("page_no").alias("last_page"),
        F.min_by("block_id", F.struct("page_no", "block_no")).alias("first_block"), F.max_by("block_id", F.struct("page_no", "block_no")).alias("last_block"),
    )
    w = doc_window("page_no", "block_no")
    h = heading_blocks(blocks, keywords).withColumn("np", F.lead("page_no").over(w)).withColumn("nb", F.lead("block_id").over(w)).withColumn("ord", (F.row_number().over(w) - 1).cast("int"))
    text = T.strip(F.col("text"))
    h = h.join(ends, "doc_id").select(
        "doc_id", stable_id("section", F.lit("block"), F.col("page_no"), F.col("block_no"), F.substring("text", 1, 40)).alias("section_id"), text.alias("title"), T.normalize_title(F.col("text")).alias("normalized_title"),
        T.section_level(text).alias("level"), F.col("page_no").alias("page_start"),
        F.when(F.col("np").isNull(), F.col("last_page")).when(F.col("np") == F.col("page_no"), F.col("page_no")).otherwise(F.greatest("page_no", F.col("np") - 1)).alias("page_end"),
        F.col("block_id").alias("block_start_id"), F.coalesce("nb", "last_block").alias("block_end_id"), F.lit("heuristic").alias("source_type"), "ord",
    )
    whole = ends.join(h.select("doc_id").distinct(), "doc_id", "left_anti").select(
        "doc_id", stable_id("section", F.lit("fallback"), F.col("first_page")).alias("section_id"), F.lit("全文").alias("title"), F.lit("全文").alias("normalized_title"), F.lit(1).alias("level"),
        F.col("first_page").alias("page_start"), F.col("last_page").alias("page_end"), F.col("first_block").alias("block_start_id"), F.col("last_block").alias("block_end_id"), F.lit("fallback").alias("source_type"), F.lit(0).alias("ord"),
    )
    return h.unionByName(whole)


def sections(blocks: DataFrame, toc: DataFrame, keywords: list[str] = ()) -> DataFrame:
    """Documents with a table of contents use it; the others use their headings."""
    listed = toc.select("doc_id").distinct()
    return sections_from_toc(toc, blocks).unionByName(sections_from_blocks(blocks.join(listed, "doc_id", "left_anti"), keywords))


def directory_pages(blocks: DataFrame, last_page: int = 20, least: int = 3) -> DataFrame:
    """Early pages with a contents title, or with lines that end like entries of a contents list."""
    line = T.compact(F.coalesce("text", F.lit("")))
    per_page = blocks.filter(F.col("page_no") <= last_page).groupBy("doc_id", "page_no").agg(F.max(line.isin(*DIRECTORY_TITLES)).alias("titled"), F.count_if(line.rlike("(?U)" + DIRECTORY_LINE)).alias("entries"))
    return per_page.filter(F.col("titled") | (F.col("entries") >= least)).select("doc_id", "page_no")


def leaf_bounds(leaves: DataFrame, blocks: DataFrame, toc_pages: DataFrame) -> DataFrame:
    """Leaves ``(doc_id, ord, title, page_start, page_end)`` with the heights of their headings.

    The heading is the shortest, then top-most block of the start page whose compact text equals, contains
    or is contained in the title. A leaf ends at the next leaf's heading if that is on its last page, and
    before the first contents page after its start."""
    key, text = T.compact(F.col("title")), T.compact(F.col("text"))
    pairs = leaves.join(blocks.select("doc_id", F.col("page_no").alias("page_start"), "text", "bbox", "block_id"), ["doc_id", "page_start"])
    pairs = pairs.filter((text != "") & ((text == key) | F.contains(text, key) | F.contains(key, text)))
    head = top(pairs, ["doc_id", "ord"], [F.length(text).asc(), F.col("bbox")[1].asc(), F.col("block_id").asc()]).select("doc_id", "ord", F.col("bbox")[1].alias("start_y"), F.col("block_id").alias("block_start_id"))
    cut = leaves.join(toc_pages.withColumnRenamed("page_no", "toc_page"), "doc_id").filter((F.col("toc_page") > F.col("page_start")) & (F.col("toc_page") <= F.col("page_end"))).groupBy("doc_id", "ord").agg(F.min("toc_page").alias("toc_page"))
    out = leaves.join(head, ["doc_id", "ord"], "left").join(cut, ["doc_id", "ord"], "left")
    out = out.withColumn("page_end", F.when(F.col("toc_page").isNotNull(), F.greatest("page_start", F.col("toc_page") - 1)).otherwise(F.col("page_end"))).drop("toc_page")
    w = doc_window("ord")
    return out.withColumn("end_y", F.when(F.lead("page_start").over(w) == F.col("page_end"), F.lead("start_y").over(w)))


def container(blocks: DataFrame, secs: DataFrame, key: str = "block_id") -> DataFrame:
    """The section that holds each block's page: the one that starts last, then the deepest, then the first."""
    spans = secs.select("doc_id", "section_id", "title", "level", "page_start", "page_end", "ord", F.explode(F.sequence("page_start", "page_end")).alias("page_no"))
    return top(blocks.select("doc_id", key, "page_no").join(spans, ["doc_id", "page_no"]), ["doc_id", key], [F.desc("page_start"), F.desc("level"), F.asc("ord")])


def parents(secs: DataFrame) -> DataFrame:
    """Each section's parent: shallower, its pages around the section's; the deepest, then the latest. Else itself."""
    # a parent's pages hold the child's first page, so pages are the key and no document is crossed with itself
    around = secs.select("doc_id", F.col("section_id").alias("p_id"), F.col("title").alias("p_title"), F.col("level").alias("p_level"), F.col("page_start").alias("p_start"), F.col("page_end").alias("p_end"), F.col("ord").alias("p_ord"), F.explode(F.sequence("page_start", "page_end")).alias("page_start"))
    pairs = secs.join(around, ["doc_id", "page_start"]).filter((F.col("p_id") != F.col("section_id")) & (F.col("p_level") < F.col("level")) & (F.col("p_end") >= F.col("page_end")))
    best = top(pairs, ["doc_id", "section_id"], [F.desc("p_level"), F.desc("p_start"), F.asc("p_ord")]).select("doc_id", "section_id", "p_id", "p_title", "p_start", "p_end")
    own = secs.join(best, ["doc_id", "section_id"], "left")
    return own.select(
        "doc_id", "section_id", F.coalesce("p_id", "section_id").alias("container_id"), F.coalesce("p_title", "title").alias("container_title"),
        F.coalesce("p_start", "page_start").alias("container_start"), F.coalesce("p_end", "page_end").alias("container_end"),
    )


# ---- order-dependent: one page at a time


#: A heading goes on below if it ends like this, or has more of the first than of the second.
OPEN_ENDS = ("、", "，", ",", "；", ";", "：", ":")
PAIRS = ("（）", "()", "《》", "“”")
LONG_LINE, CLOSING_ENDS = 35, ("）", ")", "。")
NUMBERED = re.compile(r"^(\d|[（(]\d|[（(]?[一二三四五六七八九十])")
HEADINGS = [re.compile(p) for p in T.HEADING_PATTERNS]


def merge_heading_lines(blocks: DataFrame) -> DataFrame:
    """A numbered heading takes the line below when it plainly goes on there; a line is used once.

    The line below isn't a heading, starts within max(18, 1.8 line heights), is aligned (left edges within
    40 points, or half its width shared), and the heading has an open bracket, ends with a separator, or is
    long while the rest closes. Lines merge one after the other, so each page is one (small) pandas group."""

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        tops = [b[1] if b is not None and len(b) > 1 else 0.0 for b in pdf["bbox"]]
        rows = pdf.assign(_top=tops).sort_values(["_top", "block_no"], kind="stable").drop(columns="_top").to_dict("records")
        out, used = [], False
        for row, below in zip(rows, [*rows[1:], None]):
            if used:
                used = False
            elif below is not None and goes_on(row, below):
                a, b = row["bbox"], below["bbox"]
                x, y = " ".join((row["text"] or "").split()), " ".join((below["text"] or "").split())
                out.append(row | {"text": x + (" " if x[-1].isascii() and y[0].isascii() else "") + y, "bbox": [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]})
                used = True
            else:
                out.append(row)
        return pd.DataFrame(out, columns=pdf.columns)

    return blocks.groupBy("doc_id", "page_no").applyInPandas(page, blocks.schema)


def goes_on(row: dict, below: dict) -> bool:
    x, y = " ".join((row["text"] or "").split()), " ".join((below["text"] or "").split())
    a, b = row["bbox"], below["bbox"]
    if not x or not y or a is None or b is None or len(a) < 4 or len(b) < 4:
        return False
    if not (NUMBERED.match(x) and any(p.match(x) for p in HEADINGS)) or any(p.match(y) for p in HEADINGS):
        return False
    if b[1] - a[3] > max(18.0, 1.8 * max(1.0, a[3] - a[1])):
        return False
    shared = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) / max(1.0, b[2] - b[0])
    if abs(b[0] - a[0]) > 40 and shared < 0.5:
        return False
    return any(x.count(p[0]) > x.count(p[1]) for p in PAIRS) or x.endswith(OPEN_ENDS) or (len(x) >= LONG_LINE and y.endswith(CLOSING_ENDS))
