"""Packaging: every section's material in reading order, as relations.

``section_scopes`` drives it all: texts, tables, images and stream items meet the scopes once each, on
(document, page), instead of section by section."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..plans.rank import first_by, preceding, reading_order, top
from . import masks as M
from .retrieval import _bounded

#: Texts of table captions, tail notes, form fields.
CAPTION = r"^\s*(?:附?表|续表)\s*[\d一二三四五六七八九十]+"
TAIL_NOTE = r"^\s*(?:注|备注|说明)\s*[:：\d]"
FORM_FIELD = r"^[^：:]{1,20}[：:].*$"
SUMMARY_ROW = r"^(?:合计|总计|小计)"
DATE_MARK = r"20\d{2}"


def scope_pages(scopes: DataFrame) -> DataFrame:
    """Scopes ``(doc_id, scope_id, start_page, start_y, end_page, end_y)`` with a row for each page."""
    end = F.greatest("start_page", F.coalesce("end_page", "start_page"))
    return scopes.withColumn("end_page", end).withColumn("page_no", F.explode(F.sequence("start_page", "end_page")))


def _join(items: DataFrame, scopes: DataFrame) -> DataFrame:
    return items.join(scope_pages(scopes), ["doc_id", "page_no"])


def _inside(y: Column) -> Column:
    return G.in_reading_range(F.col("page_no"), y, F.col("start_page"), F.col("start_y"), F.col("end_page"), F.col("end_y"))


def items_in_scopes(items: DataFrame, scopes: DataFrame, y: str = "top_y") -> DataFrame:
    """Items in every scope that holds their top point."""
    return _join(items, scopes).filter(_inside(F.col(y))).select(*items.columns, "scope_id")


def tables_in_scopes(tables: DataFrame, scopes: DataFrame) -> DataFrame:
    """Tables in every scope that their vertical extent touches, so one table may be in two."""
    hit = G.span_overlaps(F.col("page_no"), F.col("bbox")[1], F.col("bbox")[3], F.col("start_page"), F.col("start_y"), F.col("end_page"), F.col("end_y"))
    return _join(tables, scopes).filter(hit).select(*tables.columns, "scope_id")


def first_scope(items: DataFrame, scopes: DataFrame, key: str = "item_id", y: str = "top_y") -> DataFrame:
    """Items with the first scope (by ``ord``) that holds them."""
    got = _join(items, scopes).filter(_inside(F.col(y)))
    return first_by(got, ["doc_id", key], [F.asc("ord")]).select("doc_id", key, "scope_id")


def outside_children(items: DataFrame, children: DataFrame, key: str = "item_id", y: str = "top_y") -> DataFrame:
    """Items ``(doc_id, parent_id, ...)`` that no child scope ``(doc_id, parent_id, ...)`` holds."""
    hit = items.join(scope_pages(children), ["doc_id", "parent_id", "page_no"]).filter(_inside(F.col(y))).select("doc_id", "parent_id", key).distinct()
    return items.join(hit, ["doc_id", "parent_id", key], "left_anti")


def headings(blocks: DataFrame) -> DataFrame:
    """Heading candidates in reading order: page_no, y, raw_title, title, level, block_id, ord."""
    h = blocks.filter(T.is_heading(F.col("text"))).select(
        "doc_id", "page_no", F.coalesce(F.col("bbox")[1], F.lit(0.0)).alias("y"), T.strip(F.col("text")).alias("raw_title"), T.display_title(F.col("text")).alias("title"), T.heading_level(F.col("text")).alias("level"), "block_id", "block_no",
    )
    return reading_order(h, [F.asc("page_no"), F.asc("y"), F.asc("block_no")], name="ord").drop("block_no")


def nearest_heading(items: DataFrame, heads: DataFrame, y: str = "top_y") -> DataFrame:
    """Items with the title and id of the last heading strictly before them."""
    marks = heads.select("doc_id", "page_no", F.col("y").alias(y), "ord", "title", "block_id")
    return preceding(items, marks, ["doc_id"], "page_no", y, {"title": "heading_title", "block_id": "heading_id"})


def running_titles(items: DataFrame, context: str = "context_title") -> DataFrame:
    """Items numbered within their section and context title, in reading order."""
    n = F.row_number().over(Window.partitionBy("doc_id", "scope_id", context).orderBy("page_no", "top_y", "item_id"))
    return items.withColumn("n", n).withColumn("display_title", F.concat_ws("-", context, F.col("n").cast("string")))


def context_title(heading: Column, container: Column, leaf: Column, page: Column) -> Column:
    """Nearest heading, smallest container, leaf of the path, page."""
    def filled(c: Column) -> Column:
        return F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))

    return F.coalesce(filled(heading), filled(container), filled(leaf), F.concat(F.lit("page-"), page.cast("string")))


def page_container(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """The title of the smallest (then earliest) container around each page."""
    spans = candidates.select("doc_id", "title", "page_start", "page_end", F.explode(F.sequence("page_start", "page_end")).alias("page_no"))
    return top(pages.join(spans, ["doc_id", "page_no"]), ["doc_id", "page_no"], [(F.col("page_end") - F.col("page_start")).asc(), F.asc("page_start"), F.asc("title")]).select("doc_id", "page_no", F.col("title").alias("container_title"))


def precise_scopes(candidates: DataFrame, by: str = "section_path") -> DataFrame:
    """One scope for each path over its candidates: the first page with the least height there, the last page with the largest."""
    k = ["doc_id", by]
    w = Window.partitionBy(*k)
    c = candidates.withColumn("p0", F.min("page_start").over(w)).withColumn("p1", F.max("page_end").over(w))
    return c.groupBy(*k).agg(
        F.first("p0").alias("start_page"), F.min(F.when(F.col("page_start") == F.col("p0"), F.col("start_y"))).alias("start_y"),
        F.first("p1").alias("end_page"), F.max(F.when(F.col("page_end") == F.col("p1"), F.col("end_y"))).alias("end_y"),
    )


def inferred_scopes(paths: DataFrame, blocks: DataFrame) -> DataFrame:
    """Scopes of paths ``(doc_id, section_path)`` from their headings: to the next heading that isn't below them.

    A path's heading is the first one with its number (or title); the end is the least later heading of a
    path that doesn't start with it."""
    h = headings(blocks).withColumn("num", T.number_key(F.col("raw_title"))).withColumn("key", T.normalize_title(F.col("title")))
    p = paths.withColumn("leaf", T.path_leaf(F.col("section_path"))).withColumn("leaf_num", T.number_key(F.col("leaf"))).withColumn("leaf_key", T.normalize_title(F.col("leaf")))
    by_number = p.filter("leaf_num is not null").join(h.filter("num is not null"), (p["doc_id"] == h["doc_id"]) & (F.col("leaf_num") == F.col("num")) & (F.contains("key", F.col("leaf_key")) | F.contains(F.col("leaf_key"), F.col("key")))).select(p["doc_id"], "section_path", "page_no", "y", "ord", "block_id")
    by_title = p.filter("leaf_num is null").join(h.withColumnRenamed("key", "leaf_key"), ["doc_id", "leaf_key"]).select("doc_id", "section_path", "page_no", "y", "ord", "block_id")
    found = top(by_number.unionByName(by_title), ["doc_id", "section_path"], [F.asc("ord")])
    later = found.select("doc_id", F.col("section_path").alias("n_path"), F.col("page_no").alias("end_page"), F.col("y").alias("end_y"), F.col("ord").alias("n_ord"))
    after = found.join(later, "doc_id").filter((F.col("n_ord") > F.col("ord")) & ~F.startswith("n_path", F.concat("section_path", F.lit(" / "))))
    ends = top(after, ["doc_id", "section_path"], [F.asc("n_ord")]).select("doc_id", "section_path", "end_page", "end_y")
    last = blocks.groupBy("doc_id").agg(F.max("page_no").alias("last_page"))
    out = found.join(ends, ["doc_id", "section_path"], "left").join(last, "doc_id")
    return out.select("doc_id", "section_path", F.col("page_no").alias("start_page"), F.col("y").alias("start_y"), F.coalesce("end_page", "last_page").alias("end_page"), "end_y", "block_id")


def under_path(path: Column, anchor: Column) -> Column:
    return (path == anchor) | F.startswith(path, F.concat(anchor, F.lit(" / ")))


def compound_instances(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Candidates below an anchor path: its next path part is the instance, the one after it the child; page ranges of both."""
    c = candidates.join(F.broadcast(anchors.select("anchor")), under_path(F.col("section_path"), F.col("anchor")) & (F.col("section_path") != F.col("anchor")))
    parts, depth = T.path_parts(F.col("section_path")), F.size(T.path_parts(F.col("anchor")))
    c = c.withColumn("instance", F.try_element_at(parts, depth + 1)).withColumn("child", F.try_element_at(parts, depth + 2))
    children = c.groupBy("doc_id", "anchor", "instance", "child").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))
    whole = children.groupBy("doc_id", "anchor", "instance").agg(F.min("page_start").alias("i_start"), F.max("page_end").alias("i_end"), F.count("child").alias("child_count"))
    return children.join(whole, ["doc_id", "anchor", "instance"])


def heading_instances(blocks: DataFrame, pattern: str, child_include: str = ".+", child_exclude: str = "^$", longest: int = 32, least_font: float = 12.0) -> DataFrame:
    """Instances from headings that match a pattern, and child headings inside them, each up to the next one."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "block_no")
    b = blocks.withColumn("t", T.strip(F.col("text"))).withColumn("is_instance", F.col("t").rlike("(?U)" + pattern))
    b = b.withColumn("instance_no", F.sum(F.col("is_instance").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("instance_no > 0")
    child = F.col("t").rlike("(?U)" + child_include) & ~F.col("t").rlike("(?U)" + child_exclude) & (F.length("t") <= longest) & (F.coalesce("font_size", F.lit(0.0)) >= least_font)
    heads = b.filter(F.col("is_instance") | child)
    inside = Window.partitionBy("doc_id", "instance_no").orderBy("page_no", "block_no")
    y = F.coalesce(F.col("bbox")[1], F.lit(0.0))
    heads = heads.withColumn("start_y", y).withColumn("end_page", F.lead("page_no").over(w)).withColumn("end_y", F.lead(y).over(w)).withColumn("child_no", F.row_number().over(inside) - 1)
    return heads.select("doc_id", "instance_no", "child_no", F.col("t").alias("title"), F.col("page_no").alias("start_page"), "start_y", "end_page", "end_y")


def parent_prefaces(scopes: DataFrame, heads: DataFrame) -> DataFrame:
    """Texts before the first child of each parent path: from the parent's last title before that child to the child.

    ``scopes(doc_id, section_path, start_page, start_y)`` are children; the exact title wins over one that contains it."""
    parts = T.path_parts(F.col("section_path"))
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), " / ")))
    kids = scopes.filter(F.size(parts) > 1).select("doc_id", prefix.alias("parent_path"), F.struct("start_page", F.coalesce("start_y", F.lit(0.0)).alias("y")).alias("at"))
    first = kids.groupBy("doc_id", "parent_path").agg(F.min("at").alias("child_at"))
    key = T.normalize_title(T.path_leaf(F.col("parent_path")))
    first = first.withColumn("key", key)
    h = heads.select("doc_id", F.struct(F.col("page_no").alias("start_page"), "y").alias("head_at"), T.normalize_title(F.col("title")).alias("title_key"))
    pairs = first.join(h, "doc_id").filter((F.col("head_at") < F.col("child_at")) & (F.col("key") != "") & F.contains("title_key", F.col("key")))
    best = top(pairs, ["doc_id", "parent_path"], [F.desc(F.col("title_key") == F.col("key")), F.desc("head_at")])
    return best.select("doc_id", "parent_path", F.col("head_at.start_page").alias("start_page"), F.col("head_at.y").alias("start_y"), F.col("child_at.start_page").alias("end_page"), F.col("child_at.y").alias("end_y"))


def page_stream(blocks: DataFrame, tables: DataFrame, images: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """Texts, tables, images (and layout items) as one stream with a reading order."""
    y = F.coalesce(F.col("bbox")[1], F.lit(0.0)).alias("top_y")

    def kind(df: DataFrame, name: str, key: str, text: Column, source: Column) -> DataFrame:
        return df.select("doc_id", F.col(key).alias("item_id"), F.lit(name).alias("item_type"), source.alias("source_type"), "page_no", y, "bbox", text.alias("text"))

    rows = kind(blocks, "text", "block_id", F.col("text"), F.col("source_type"))
    rows = rows.unionByName(kind(tables, "table", "table_id", F.lit(""), F.lit("pdf_table"))).unionByName(kind(images, "image", "image_id", F.lit(""), F.lit("pdf_image")))
    if layout is not None:
        rows = rows.unionByName(layout.select(*rows.columns))
    return reading_order(rows, [F.asc("page_no"), F.asc("top_y"), F.asc("item_type"), F.asc("source_type"), F.asc("item_id")])


def layout_items(layout: DataFrame) -> DataFrame:
    """Items of layout pages: texts, images and tables by label; a text region without text takes the recognised lines inside it."""
    page = F.col("page_index") + 1
    ocr = F.arrays_zip(F.col("overall_ocr_res.rec_texts").alias("t"), F.col("overall_ocr_res.rec_boxes").alias("b"))
    rows = layout.select("doc_id", page.alias("page_no"), ocr.alias("ocr"), F.posexplode("parsing_res_list").alias("n", "x")).filter(F.size("x.block_bbox") >= 4)
    box = F.col("x.block_bbox")
    inside = F.filter("ocr", lambda o: (F.size(o["b"]) >= 4) & G.center_inside(o["b"], box, 4.0))
    text = F.when(F.trim(F.coalesce("x.block_content", F.lit(""))) != "", F.col("x.block_content")).otherwise(F.array_join(F.transform(inside, lambda o: o["t"]), "\n"))
    label = F.col("x.block_label")
    kind = F.when(label.isin("table"), "table").when(label.isin("image", "figure", "seal", "chart"), "image").otherwise("text")
    return rows.filter(~label.isin(*M.MASK_LABELS)).select(
        "doc_id", F.concat_ws("-", F.lit("layout"), F.col("page_no").cast("string"), F.col("n").cast("string")).alias("item_id"), kind.alias("item_type"), F.lit("layout").alias("source_type"), "page_no", box[1].alias("top_y"), box.alias("bbox"),
        F.when(kind == "text", text).otherwise("").alias("text"),
    ).filter((F.col("item_type") != "text") | (F.trim("text") != ""))


def without_repeats(stream: DataFrame, ordered: DataFrame) -> DataFrame:
    """Stream items that aren't among ``ordered`` by id, nor texts at the same place with the same signature."""
    place = [F.round(F.col("bbox")[i], 0) for i in range(4)]
    sig = F.concat_ws("|", F.col("page_no").cast("string"), T.compact(F.col("text")), *[p.cast("string") for p in place])
    left = stream.join(ordered.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti").withColumn("_sig", sig)
    seen = ordered.filter("item_type = 'text'").select("doc_id", sig.alias("_sig")).distinct()
    return left.join(seen, ["doc_id", "_sig"], "left_anti").drop("_sig")


def cell_signatures(tables: DataFrame) -> DataFrame:
    cells = tables.select("doc_id", "table_id", "page_no", F.explode(F.flatten("rows")).alias("cell")).select("doc_id", "table_id", "page_no", T.cell_signature(F.col("cell")).alias("sig"))
    return cells.filter("length(sig) >= 6").distinct()


def _cell_tables(texts: DataFrame, tables: DataFrame) -> DataFrame:
    """``texts`` with the first table of their page that has a cell like them, or null; equal texts and cells are compared once."""
    once = texts.select("doc_id", "page_no", "text").distinct().withColumn("own", T.cell_signature(F.col("text"))).filter("length(own) >= 6")
    sigs = cell_signatures(tables).groupBy("doc_id", "page_no", "sig").agg(F.min("table_id").alias("table_id"))
    pairs = once.join(sigs, ["doc_id", "page_no"]).filter(F.contains("own", F.col("sig")) | F.contains("sig", F.col("own")))
    return texts.join(_bounded(pairs.groupBy("doc_id", "page_no", "text").agg(F.min("table_id").alias("table_id"))), ["doc_id", "page_no", "text"], "left")


def cell_texts(texts: DataFrame, tables: DataFrame, key: str = "item_id") -> DataFrame:
    """Texts of at least six signature characters that equal, contain or are contained in a cell on their page."""
    met = _cell_tables(texts.select("doc_id", "page_no", key, "text"), tables).filter("table_id is not null").select("doc_id", key, "table_id")
    # few rows share an id, so nothing is to be gained by sorting before the shuffle
    return first_by(met.repartition("doc_id", key), ["doc_id", key], [F.asc("table_id")])


def roles(texts: DataFrame, tables: DataFrame, images: DataFrame, key: str = "item_id") -> DataFrame:
    """``role`` of each text: in a table by place (captions stay), in one by its cells, in an image, else body."""
    def regions(df: DataFrame, name: str) -> DataFrame:
        return df.select("doc_id", "page_no", F.col(name).alias("region_id"), "bbox", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no", name)).alias("ord"))

    by_place = M.in_regions(texts, regions(tables, "table_id"), 0.15, key=key).withColumnRenamed("region_id", "in_table")
    by_cell = cell_texts(texts, tables, key).withColumnRenamed("table_id", "cell_table")
    by_image = M.in_regions(texts, regions(images, "image_id"), 0.8, both=True, key=key).withColumnRenamed("region_id", "in_image")
    j = texts.join(by_place, ["doc_id", key], "left").join(by_cell, ["doc_id", key], "left").join(by_image, ["doc_id", key], "left")
    caption = F.col("text").rlike("(?U)" + CAPTION)
    role = F.when(F.col("in_table").isNotNull() & ~caption, "table_text").when(F.col("cell_table").isNotNull() & ~caption, "table_text").when(F.col("in_image").isNotNull(), "image_text").otherwise("body_text")
    return j.withColumn("role", role).drop("in_table", "cell_table", "in_image")


def table_bounds(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """Vertical bounds of tables from the texts of their cells, kept inside their boxes."""
    t = texts.select("doc_id", "page_no", "item_id", "text", F.col("bbox")[1].alias("y0"), F.col("bbox")[3].alias("y1"))
    rows = _cell_tables(t, tables).select("doc_id", "item_id", "table_id", "y0", "y1").repartition("doc_id", "item_id")
    # an id's rows all belong to its first table
    items = rows.groupBy("doc_id", "item_id").agg(F.min("table_id").alias("table_id"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    b = items.filter("doc_id is not null and item_id is not null").groupBy("doc_id", "table_id").agg(F.min("y0").alias("top"), F.max("y1").alias("bottom"))
    out = tables.join(b, ["doc_id", "table_id"], "left")
    return out.select("doc_id", "table_id", F.greatest(F.col("bbox")[1], F.coalesce("top", F.col("bbox")[1])).alias("top"), F.least(F.col("bbox")[3], F.coalesce("bottom", F.col("bbox")[3])).alias("bottom"))


def material_items(scopes: DataFrame, blocks: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """Everything in every scope, without decoration, with roles and a running order: the ordered material."""
    clean = M.without_decoration(blocks)
    bad = M.decorative_images(images) if "xref" in images.columns else None
    pictures = images.join(bad, ["doc_id", "image_id"], "left_anti") if bad is not None else images
    stream = page_stream(clean, tables, pictures)
    point = items_in_scopes(stream.filter("item_type <> 'table'"), scopes)
    boxes = tables_in_scopes(stream.filter("item_type = 'table'"), scopes)
    texts = roles(stream.filter("item_type = 'text'"), tables, pictures).select("doc_id", "item_id", "role")
    both = point.unionByName(boxes).join(texts, ["doc_id", "item_id"], "left").withColumn("role", F.coalesce("role", "item_type"))
    return reading_order(both, [F.asc("page_no"), F.asc("top_y"), F.asc("item_type"), F.asc("item_id")], ("doc_id", "scope_id"), "n")


def dirnames(paths: DataFrame) -> DataFrame:
    """A directory name for each path; of siblings with one name the first keeps it, later ones get a hash."""
    p = paths.select("doc_id", "section_path").distinct()
    parts = T.path_parts(F.col("section_path"))
    p = p.withColumn("parent", F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " / ")).withColumn("base", T.safe_name(T.path_leaf(F.col("section_path"))))
    n = F.row_number().over(Window.partitionBy("doc_id", "parent", "base").orderBy("section_path"))
    return p.withColumn("dirname", F.when(n == 1, F.col("base")).otherwise(F.concat_ws("_", "base", F.substring(F.sha1(F.col("section_path").cast("binary")), 1, 8)))).drop("base")


def index_links(paths: DataFrame) -> DataFrame:
    """For every prefix of every path its direct children, sorted: folder index pages."""
    parts = T.path_parts(F.col("section_path"))
    ups = paths.select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i - 1), " / ").alias("parent"), F.element_at(parts, i).alias("child")))).alias("x")).select("doc_id", "x.*").distinct()
    return ups.groupBy("doc_id", "parent").agg(F.array_sort(F.collect_list("child")).alias("children"))


def render(items: list[dict]) -> str:
    """Markdown of one material: texts as paragraphs, runs of two or more ``name: value`` lines as a table, tables and images inline."""
    out: list[str] = []
    buffer: list[str] = []
    seen: set[tuple] = set()

    def flush():
        nonlocal buffer
        pairs = [re.split(r"[:：]", x, maxsplit=1) for x in buffer]
        if len(buffer) >= 2 and all(re.match(FORM_FIELD, x) for x in buffer):
            out.append("\n".join(["| 字段 | 内容 |", "| --- | --- |", *(f"| {k.strip()} | {v.strip()} |" for k, v in pairs)]))
        elif buffer:
            out.extend(buffer)
        buffer = []

    for i in items:
        if i["item_type"] == "text":
            key = (i["page_no"], "".join((i["text"] or "").split()), tuple(round(v) for v in (i["bbox"] if i["bbox"] is not None else [])))
            if i["role"] != "body_text" or key in seen or not (i["text"] or "").strip():
                continue
            seen.add(key)
            buffer.append(i["text"].strip())
        else:
            flush()
            out.append(i.get("markdown") or f"![{i['item_id']}]({i['item_id']})")
    flush()
    return "\n\n".join(out)


def material_markdown(items: DataFrame) -> DataFrame:
    """One Markdown text for each material; a material is the unit, never a whole document collection."""
    cols = [c for c in ("item_id", "item_type", "page_no", "text", "bbox", "role", "n", "markdown") if c in items.columns]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("n")[cols].to_dict("records")
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iat[0]], "scope_id": [pdf["scope_id"].iat[0]], "markdown": [render(rows)]})

    return items.groupBy("doc_id", "scope_id").applyInPandas(one, f"doc_id long, scope_id {items.schema['scope_id'].dataType.simpleString()}, markdown string")


def covered_paths(planned: DataFrame, grouped: DataFrame, covered: DataFrame) -> DataFrame:
    """(planned or grouped) without the paths that compound packages cover."""
    return planned.select("doc_id", "section_path").union(grouped.select("doc_id", "section_path")).distinct().join(covered.select("doc_id", "section_path"), ["doc_id", "section_path"], "left_anti")


def counts(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id", "scope_id").agg(F.count_if(F.col("item_type") == "text").alias("texts"), F.count_if(F.col("item_type") == "table").alias("tables"), F.count_if(F.col("item_type") == "image").alias("images"))
