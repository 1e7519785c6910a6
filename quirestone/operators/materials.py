"""Finishing materials: attachments, text items, tail notes of tables, images by kind and place, layout tables,
image references in cells, whole documents and the tree of packages.

Everything meets on (document, page) or (document, material); orders end with an ordinal or id. Null texts and boxes count as empty."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType

from ..functions import geometry as G
from ..functions import text as T
from ..functions.ids import stable_id
from ..plans.rank import reading_order, top
from . import masks as M
from . import packaging as P
from . import tables as TB

# Words, names and patterns that decide.
AUTHORIZATION_ROOT = "法定代表人授权委托书"
IDENTITY_WORDS = ("身份证", "扫描件", "有效身份证件")
ROLE_TERMS = ("法定代表人", "被授权人", "制造商", "投标人")
DOCUMENT_TERMS = ("身份证", "营业执照", "保函", "基本账户证明", "税务登记")
NOTE_STARTS = ("编制说明", "说明")
NOTE_MARKERS = ("投标人须", "证明材料", "合同关键页", "发票", "按顺序编制")
SUMMARY_STARTS = ("合计", "总计")
HEADER_WORDS = ("NI.INF", "理工能科", "商务投标文件", "测控及在线监测系统")
PICTURE_CELL = "[图片]"
EXPLICIT_KINDS = {
    "seal_or_stamp": ("seal", "stamp", "seal_or_stamp", "signature_stamp"),
    "watermark": ("watermark", "background_watermark"),
    "decorative_image": ("decorative", "decoration", "decorative_image"),
    "content_image": ("content", "content_image", "figure", "photo", "diagram", "screenshot"),
}
LABEL_KINDS = {
    "seal_or_stamp": ("seal", "stamp", "sealorstamp", "signaturestamp", "印章", "签章", "公章"),
    "watermark": ("watermark", "backgroundwatermark", "水印"),
    "decorative_image": ("decorative", "decoration", "decorativeimage", "background"),
}
TITLE_NUMBER = r"^[（(]?\d+(?:\.\d+)*[）)]?[、.．]?$"
TITLE_START = r"^[（(]?\d+(?:\.\d+)+[）)]?[、.．]?"
ANCHOR_DROPPED = r"[（()）/、，,：:\-\s'‘’“”]+"
KEY_DROPPED = r"[^\w一-鿿]+"
IMAGE_TYPES = ("png", "jpg", "jpeg", "webp")


def _any(words: tuple[str, ...], test) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | test(w)
    return hit


def _has(x: Column, words: tuple[str, ...]) -> Column:
    return _any(words, lambda w: F.contains(x, F.lit(w)))


def _starts(x: Column, words: tuple[str, ...]) -> Column:
    return _any(words, lambda w: F.startswith(x, F.lit(w)))


def _filled(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def _top(box: str = "bbox") -> Column:
    return F.coalesce(F.try_element_at(F.col(box), F.lit(2)), F.lit(0.0))


def _left(box: str = "bbox") -> Column:
    return F.coalesce(F.try_element_at(F.col(box), F.lit(1)), F.lit(0.0))


# ---- attachments


def attachment_key(x: Column) -> Column:
    """What attachment titles are compared by: no marker, only word characters, lower case."""
    return F.lower(F.regexp_replace(T.display_title(T.attachment_title(x)), "(?U)" + KEY_DROPPED, ""))


def anchor_key(x: Column) -> Column:
    return F.lower(F.regexp_replace(_filled(x), "(?U)" + ANCHOR_DROPPED, ""))


def is_authorization_leaf(path: Column) -> Column:
    """A path below the authorization letter whose leaf names an identity paper."""
    parts = T.path_parts(path)
    return (F.size(parts) >= 2) & (F.try_element_at(parts, F.lit(1)) == AUTHORIZATION_ROOT) & _has(T.path_leaf(path), IDENTITY_WORDS)


def attachment_scopes(paths: DataFrame, blocks: DataFrame) -> DataFrame:
    """Scopes of authorization leaves: from the first attachment heading that matches the leaf to the next heading of the kind.

    Without a later heading the scope ends with the document's last page (``end_y`` null)."""
    marks = blocks.filter(T.is_attachment_heading(F.col("text"))).select("doc_id", "page_no", _top().alias("y"), "block_no", "block_id", attachment_key(F.col("text")).alias("key"))
    w = Window.partitionBy("doc_id").orderBy("page_no", "y", "block_no", "block_id")
    marks = marks.select("*", F.row_number().over(w).alias("ord"), *[F.lead(c).over(w).alias(f"next_{c}") for c in ("page_no", "y", "block_id")])
    leaves = paths.filter(is_authorization_leaf(F.col("section_path"))).select("doc_id", "section_path", attachment_key(T.path_leaf(F.col("section_path"))).alias("target"))
    hit = (F.col("key") != "") & (F.col("target") != "") & (F.contains("target", F.col("key")) | F.contains("key", F.col("target")))
    first = top(leaves.join(marks, "doc_id").filter(hit), ["doc_id", "section_path"], [F.asc("ord")])
    last = blocks.groupBy("doc_id").agg(F.max("page_no").alias("last_page"))
    return first.join(last, "doc_id").select(
        "doc_id", "section_path", F.col("page_no").alias("start_page"), F.col("y").alias("start_y"), F.coalesce("next_page_no", "last_page").alias("end_page"),
        F.col("next_y").alias("end_y"), F.col("block_id").alias("start_block_id"), F.col("next_block_id").alias("end_block_id"),
    )


def is_identity_card(box: Column, width: Column, height: Column) -> Column:
    """An image as large and as wide as a scanned card; unknown pixel sizes don't count against it."""
    w, h = F.abs(box[2] - box[0]), F.abs(box[3] - box[1])
    pixels = F.coalesce(width, F.lit(0)).cast("long") * F.coalesce(height, F.lit(0))
    shown = (F.size(box) >= 4) & (w >= 120) & (h >= 70) & (w * h >= 15000) & ((pixels == 0) | (pixels >= 120000))
    return F.coalesce(shown & (w / h).between(1.2, 8.0), F.lit(False))


def limited_identity_images(images: DataFrame, most: int = 2) -> DataFrame:
    """In authorization leaves only the first ``most`` card-like images stay; elsewhere all of them."""
    leaf = is_authorization_leaf(F.col("section_path"))
    cards = images.filter(leaf & is_identity_card(F.col("bbox"), F.col("width"), F.col("height")))
    cards = top(cards, ["doc_id", "section_path"], [F.asc("page_no"), _top().asc(), _left().asc(), F.asc("image_id")], most)
    return images.filter(~leaf).unionByName(cards)


def bigram_overlap(a: Column, b: Column) -> Column:
    """Share of the pairs of neighbouring characters of ``a`` that ``b`` has; 1 where one text holds the other, 0 for an empty one."""
    def pairs(x: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(2))))

    shared = F.size(F.array_intersect(pairs(a), pairs(b))) / F.size(pairs(a))
    return F.when((a == "") | (b == ""), 0.0).when(F.contains(b, a) | F.contains(a, b), 1.0).when((F.length(a) < 2) | (F.length(b) < 2), 0.0).otherwise(shared)


def anchor_matches(title: Column, text: Column) -> Column:
    """Whether a line may be the anchor of a titled candidate: the title's roles and papers are named, and enough bigrams agree."""
    t, x = _filled(title), _filled(text)
    ok = F.lit(True)
    for term in dict.fromkeys(ROLE_TERMS + DOCUMENT_TERMS):
        ok = ok & (~F.contains(t, F.lit(term)) | F.contains(x, F.lit(term)))
    a, b = anchor_key(title), anchor_key(text)
    return ok & ((a == "") | (b == "") | (bigram_overlap(a, b) >= 0.35))


def is_anchor_line(text: Column) -> Column:
    """Attachment marks, numbered lines and lines of at most 40 characters; never blank ones."""
    t = T.strip(_filled(text))
    return (t != "") & (F.contains(t, F.lit("附")) | F.contains(t, F.lit("扫描件")) | t.rlike(r"(?U)^\d+(?:\.\d+)*[、.．]") | (F.length(t) <= 40))


def anchor_images(anchors: DataFrame, images: DataFrame, boundaries: DataFrame | None = None) -> DataFrame:
    """Images below an anchor ``(doc_id, page_no, anchor_id, y)`` and above the next boundary of its page, numbered by rows of 40 points."""
    edges = (anchors if boundaries is None else boundaries).select("doc_id", "page_no", "y", F.lit(True).alias("edge"))
    places = edges.unionByName(anchors.select("doc_id", "page_no", "y", F.lit(False).alias("edge"))).groupBy("doc_id", "page_no", "y").agg(F.bool_or("edge").alias("edge"))
    after = Window.partitionBy("doc_id", "page_no").orderBy("y").rowsBetween(1, Window.unboundedFollowing)
    places = places.select("doc_id", "page_no", "y", F.min(F.when(F.col("edge"), F.col("y"))).over(after).alias("next_y"))
    j = anchors.join(places, ["doc_id", "page_no", "y"]).join(images.select("doc_id", "page_no", "image_id", F.col("bbox").alias("image_box")), ["doc_id", "page_no"])
    y = F.col("image_box")[1]
    j = j.filter((y > F.col("y")) & (F.col("next_y").isNull() | (y < F.col("next_y"))))
    return reading_order(j, [F.bround(y / 40.0).asc(), F.col("image_box")[0].asc(), y.asc(), F.asc("image_id")], ("doc_id", "anchor_id"), "n").select("doc_id", "page_no", "anchor_id", "image_id", "n")


def paired_images(candidates: DataFrame, images: DataFrame) -> DataFrame:
    """The n-th candidate ``(doc_id, page_no, candidate_id, ord)`` of a page with its n-th image from the top; the rest stay alone."""
    c = reading_order(candidates, [F.asc("ord"), F.asc("candidate_id")], ("doc_id", "page_no"), "n").select("doc_id", "page_no", "n", "candidate_id")
    i = reading_order(images, [_top().asc(), _left().asc(), F.asc("image_id")], ("doc_id", "page_no"), "n").select("doc_id", "page_no", "n", "image_id")
    return c.join(i, ["doc_id", "page_no", "n"]).drop("n")


def asset_name(title: Column, anchor: Column | None = None) -> Column:
    """The file name of an attachment: its anchor without the mark, else the title; illegal characters become "_"."""
    t = T.strip(_filled(anchor if anchor is not None else F.lit("")))
    t = T.strip(F.regexp_replace(t, "^附：", ""))
    base = F.when(t == "", _filled(title)).otherwise(t)
    clean = T.strip(F.regexp_replace(F.regexp_replace(T.strip(base), r'[\\/:*?"<>|]+', "_"), r"(?U)\s+", " "))
    return F.when(clean == "", "未命名附件").otherwise(clean)


def attachment_manifest(candidates: DataFrame, lines: DataFrame, images: DataFrame) -> DataFrame:
    """Which image each attachment candidate ``(doc_id, candidate_id, title, page_start, page_end, ord)`` is exported as.

    A candidate of one page takes the image at its place among those of the page; one of several pages takes the images
    under its anchors in ``lines(doc_id, page_no, line_id, text, y)``, or all of its pages where no anchor has any. Images that
    are too small don't count. Equal names are numbered. Candidates without pages or images stay, with their status."""
    keys = ["doc_id", "candidate_id"]
    large = images.filter(M.is_meaningful_image(F.col("width"), F.col("height"), F.col("bbox")))
    placed = candidates.filter("page_start is not null").withColumn("page_end", F.greatest("page_start", F.coalesce("page_end", "page_start")))
    single = placed.filter("page_end = page_start").withColumn("page_no", F.col("page_start"))
    pairs = paired_images(single, large).join(candidates.select(*keys, "title"), keys).select(*keys, "page_no", "image_id", asset_name(F.col("title")).alias("base"), F.lit(None).cast("int").alias("n"))

    wide = placed.filter("page_end > page_start").select(*keys, "title", F.explode(F.sequence("page_start", "page_end")).alias("page_no"))
    named = lines.filter(is_anchor_line(F.col("text")))
    mark = F.contains("text", F.lit("附")) | F.contains("text", F.lit("扫描件"))
    anchors = wide.join(named, ["doc_id", "page_no"]).filter(anchor_matches(F.col("title"), F.col("text"))).withColumn("anchor_id", F.struct("candidate_id", "line_id"))
    under = anchor_images(anchors, large, named.filter(mark)).join(anchors.select("doc_id", "anchor_id", "title", "text"), ["doc_id", "anchor_id"])
    under = under.select("doc_id", F.col("anchor_id.candidate_id").alias("candidate_id"), "page_no", "image_id", asset_name(F.col("title"), F.col("text")).alias("base"), "n")
    rest = wide.join(under.select(*keys).distinct(), keys, "left_anti").join(large.select("doc_id", "page_no", "image_id", "bbox"), ["doc_id", "page_no"])
    rest = reading_order(rest, [F.asc("page_no"), _top().asc(), _left().asc(), F.asc("image_id")], ("doc_id", "candidate_id"), "n").select(*keys, "page_no", "image_id", asset_name(F.col("title")).alias("base"), "n")

    found = pairs.unionByName(under).unionByName(rest).withColumn("base", F.concat_ws("_", "base", F.col("n").cast("string")))
    again = F.row_number().over(Window.partitionBy("doc_id", "base").orderBy("page_no", "candidate_id", "image_id"))
    found = found.withColumn("asset", F.when(again == 1, F.col("base")).otherwise(F.concat_ws("_", "base", again.cast("string")))).drop("base", "n")
    status = F.when(F.col("page_start").isNull(), "source_page_not_found").when(F.col("image_id").isNull(), "no_meaningful_embedded_image_found").otherwise("exported_embedded_image")
    return candidates.join(found, keys, "left").select(*keys, status.alias("export_status"), "page_no", "image_id", "asset")


# ---- images by kind


def image_kind(explicit: Column, role: Column, labels: list[Column], red_stamp: Column | None = None) -> Column:
    """seal_or_stamp, watermark, decorative_image or content_image: by the stated kind, the role, the labels, then the pixels' verdict."""
    stated = F.lower(T.strip(_filled(explicit)))
    out = None
    for kind, words in EXPLICIT_KINDS.items():
        out = F.when(stated.isin(*words), kind) if out is None else out.when(stated.isin(*words), kind)
    out = out.when(F.lower(T.strip(_filled(role))).isin("decorative_image", "image_text"), "decorative_image")
    keys = F.transform(F.array(*[_filled(x) for x in labels]), lambda x: F.lower(T.cell_signature(x)))
    for kind, words in LABEL_KINDS.items():
        out = out.when(F.arrays_overlap(keys, F.array(*map(F.lit, words))), kind)
    if red_stamp is not None:
        out = out.when(F.coalesce(red_stamp, F.lit(False)), "seal_or_stamp")
    return out.otherwise("content_image")


def _is_red_stamp(pixels: bytes | None, w: float, h: float) -> bool:
    if not pixels or not w or not h or not 0.55 <= w / max(h, 1.0) <= 1.8 or max(w, h) > 280:
        return False
    p = np.frombuffer(pixels, np.uint8)[: len(pixels) // 4 * 4].reshape(-1, 4).astype(np.int32)
    colour, clear = p[:, :3], p[:, 3] <= 20
    rest = colour[:, 1:].max(axis=1, initial=0)
    red = ~clear & (colour[:, 0] >= 120) & (colour[:, 0] >= 1.7 * rest) & (colour[:, 0] - rest >= 50)
    ground = clear | (~red & ((colour <= 35).all(axis=1) | (colour >= 235).all(axis=1)))
    seen, found = int((~clear).sum()), int(red.sum())
    if not found:
        return False
    front = max(seen - int((ground & ~clear).sum()), 1)
    return found / seen >= 0.025 and found / front >= 0.55 and ground.mean() >= 0.35


@F.pandas_udf(BooleanType())
def red_stamp(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Whether small RGBA pixels (a thumbnail, four bytes each) with the shown size look like a red stamp; null is not one."""
    return pd.Series([_is_red_stamp(p, w, h) for p, w, h in zip(pixels, width.fillna(0), height.fillna(0))], dtype=bool)


def is_title_image(box: Column, page_width: Column, page_height: Column, text: Column) -> Column:
    """A thin, narrow image region that shows a section number, or nothing at all."""
    w, h = F.abs(box[2] - box[0]), F.abs(box[3] - box[1])
    thin = (h <= 40) | F.coalesce((page_height > 0) & (h / page_height <= 0.035), F.lit(False))
    narrow = (w <= 320) | F.coalesce((page_width > 0) & (w / page_width <= 0.35), F.lit(False))
    sig = T.compact(_filled(text))
    titled = sig.rlike("(?U)" + TITLE_NUMBER) | sig.rlike("(?U)" + TITLE_START) | ((sig == "") & (h <= 24) & (w <= 180))
    return F.coalesce((F.size(box) >= 4) & (w > 0) & (h > 0) & thin & narrow & titled, F.lit(False))


# ---- texts of materials


def text_items(blocks: DataFrame, by: tuple[str, ...] = ("doc_id", "scope_id")) -> DataFrame:
    """One text for each section: its blocks without recognised ones, in reading order with blank lines between; its pages and all block ids."""
    place = [F.col("page_no"), _top().alias("y"), F.col("block_no"), F.col("block_id")]
    kept = (F.coalesce("source_type", F.lit("")) != "ocr") & ~T.is_blank(_filled(F.col("text")))
    g = blocks.groupBy(*by).agg(
        F.min("page_no").alias("page_start"), F.max("page_no").alias("page_end"), F.array_sort(F.collect_list(F.struct(*place))).alias("ids"),
        F.array_sort(F.collect_list(F.when(kept, F.struct(*place, T.strip(F.col("text")).alias("t"))))).alias("texts"),
    )
    return g.filter(F.size("texts") > 0).select(*by, "page_start", "page_end", F.array_join(F.transform("texts", lambda b: b["t"]), "\n\n").alias("content"), F.transform("ids", lambda b: b["block_id"]).alias("source_block_ids"))


def before_child_heading(items: DataFrame, children: DataFrame) -> DataFrame:
    """Items of a material before the first text that is the title of one of its children ``(doc_id, scope_id, title)``."""
    titles = children.select("doc_id", "scope_id", T.compact(F.col("title")).alias("_sig")).distinct()
    sig = T.compact(F.regexp_replace(_filled(F.col("text")), "^#+", ""))
    cut = items.filter("item_type = 'text'").select("doc_id", "scope_id", "n", sig.alias("_sig")).join(titles, ["doc_id", "scope_id", "_sig"], "left_semi").groupBy("doc_id", "scope_id").agg(F.min("n").alias("_cut"))
    return items.join(cut, ["doc_id", "scope_id"], "left").filter(F.col("_cut").isNull() | (F.col("n") < F.col("_cut"))).select(*items.columns)


def first_places(items: DataFrame) -> DataFrame:
    """Page and height of each material's first item that shows: body texts, tables and images."""
    shown = items.filter(F.col("item_type").isin("table", "image") | ((F.col("item_type") == "text") & (F.col("role") == "body_text")))
    first = shown.groupBy("doc_id", "scope_id").agg(F.min(F.struct("n", "page_no", "top_y")).alias("x"))
    return first.select("doc_id", "scope_id", "x.page_no", "x.top_y")


def full_documents(items: DataFrame, materials: DataFrame, children: DataFrame) -> DataFrame:
    """One Markdown text for each document: its materials ``(doc_id, scope_id, title, depth)`` by their first place, nothing twice."""
    kept = before_child_heading(items, children)
    order = first_places(kept).join(materials, ["doc_id", "scope_id"])
    order = order.withColumn("material_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no", "top_y", "depth", "scope_id")))
    numbered = kept.join(order.select("doc_id", "scope_id", "material_no"), ["doc_id", "scope_id"])
    once = top(numbered, ["doc_id", "item_type", "item_id"], [F.asc("material_no"), F.asc("n")]).drop("material_no")
    texts = P.material_markdown(once)
    head = F.concat(F.repeat(F.lit("#"), F.least(F.lit(6), F.col("depth") + 1)), F.lit(" "), "title")
    parts = order.join(texts, ["doc_id", "scope_id"], "left").select("doc_id", "material_no", F.concat_ws("\n\n", head, F.when(F.col("markdown") != "", F.col("markdown"))).alias("part"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("material_no", "part"))), lambda p: p["part"]), "\n\n")
    return parts.groupBy("doc_id").agg(F.concat(F.lit("# 解析全文\n\n"), whole, F.lit("\n")).alias("markdown"), F.count("*").alias("materials"))


def index_markdown(links: DataFrame) -> DataFrame:
    """Folder pages of ``packaging.index_links``: a title and a link to each child's page."""
    title = F.when(F.col("parent") == "", F.lit("目录")).otherwise(T.path_leaf(F.col("parent")))
    line = F.transform("children", lambda c: F.concat(F.lit("- ["), c, F.lit("]("), T.safe_name(c), F.lit("/material.md)")))
    return links.select("doc_id", "parent", F.concat(F.lit("# "), title, F.lit("\n\n"), F.array_join(line, "\n"), F.lit("\n")).alias("markdown"))


def module_tree(paths: DataFrame, materials: DataFrame) -> DataFrame:
    """Every folder of the packages in the order of a walk: path, parent, name, depth, whether it is a material, number of children."""
    parts = T.path_parts(F.col("section_path"))
    ups = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.slice(parts, F.lit(1), i)))
    nodes = paths.filter(F.size(parts) > 0).select("doc_id", ups.alias("at")).distinct()
    nodes = nodes.select("doc_id", "at", F.array_join("at", " / ").alias("path"), F.array_join(F.slice("at", F.lit(1), F.size("at") - 1), " / ").alias("parent"), F.element_at("at", -1).alias("name"), F.size("at").alias("depth"))
    count = nodes.groupBy("doc_id", F.col("parent").alias("path")).agg(F.count("*").alias("child_count"))
    own = materials.select("doc_id", F.array_join(parts, " / ").alias("path"), F.lit(True).alias("is_material")).distinct()
    out = nodes.join(count, ["doc_id", "path"], "left").join(own, ["doc_id", "path"], "left")
    out = out.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("at")))
    return out.select("doc_id", "ord", "path", "parent", "name", "depth", F.coalesce("is_material", F.lit(False)).alias("is_material"), F.coalesce("child_count", F.lit(0)).alias("child_count"))


def preview_url(run: Column, path: Column) -> Column:
    """Where an image is served; everything but letters, digits and ``-._~`` is percent-encoded."""
    def quoted(x: Column) -> Column:
        return F.replace(F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    return F.concat(F.lit("/api/runs/"), quoted(run), F.lit("/images?path="), quoted(path))


# ---- tail notes of tables


def starts_tail_note(x: Column) -> Column:
    return _starts(T.cell_signature(x), NOTE_STARTS + NOTE_MARKERS)


def is_tail_note(x: Column) -> Column:
    sig = T.cell_signature(x)
    return starts_tail_note(x) | _has(sig, ("编制说明", *NOTE_MARKERS))


def tail_note_row(rows: Column) -> Column:
    """Number from 0 of the row at which notes begin: one that reads like a note, after a sum or with an opening word; null without any."""
    def row(r: Column) -> Column:
        cells = F.filter(F.transform(r, lambda c: T.strip(_filled(c))), lambda c: c != "")
        text = F.array_join(cells, "")
        total = _starts(T.cell_signature(text), SUMMARY_STARTS)
        return F.struct(total.alias("total"), (~total & is_tail_note(text)).alias("note"), _starts(_filled(F.try_element_at(cells, F.lit(1))), NOTE_STARTS).alias("opens"))

    seen = F.transform(rows, row)
    total_at = F.array_position(F.transform(seen, lambda s: s["total"]), True)
    at = F.array_position(F.transform(seen, lambda s, i: s["note"] & (s["opens"] | ((total_at > 0) & (total_at <= i)))), True)
    return F.when(at > 0, at - 1).cast("int")


def without_tail_notes(rows: Column) -> Column:
    at = tail_note_row(rows)
    return F.when(at.isNull(), rows).otherwise(F.slice(rows, F.lit(1), at))


def with_note_row(rows: Column, note: Column) -> Column:
    """The note as a last row as wide as the table; no row for an empty note."""
    width = F.greatest(F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(1)), F.lit(1))
    return F.when(_filled(note) == "", rows).otherwise(F.concat(rows, F.array(F.concat(F.array(note), F.array_repeat(F.lit(""), width - 1)))))


def tail_notes(stream: DataFrame) -> DataFrame:
    """The first body text after each table, on its page, that reads like a note: doc_id, scope_id, table_id, item_id, text.

    ``stream(doc_id, scope_id, n, item_type, item_id, page_no, text, role)``."""
    w = Window.partitionBy("doc_id", "scope_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("item_type") == "table", F.struct("item_id", "page_no")), ignorenulls=True).over(w)
    after = stream.withColumn("t", last).filter((F.col("item_type") == "text") & (F.coalesce("role", F.lit("body_text")) == "body_text") & (F.col("t.page_no") == F.col("page_no")) & is_tail_note(F.col("text")))
    after = after.select("doc_id", "scope_id", F.col("t.item_id").alias("table_id"), "n", "item_id", "text")
    return top(after, ["doc_id", "scope_id", "table_id"], [F.asc("n")]).drop("n")


def _covered(sig: str, known: list[str]) -> bool:
    """Whether the known texts, longest first, make up most of a text of 12 characters or more."""
    if len(sig) < 12:
        return False
    left = sig
    for k in known:
        left = left.replace(k, "")
    gone = len(sig) - len(left)
    return gone >= 12 and gone >= 0.6 * len(sig) and len(left) <= 0.4 * len(sig)


@F.pandas_udf(StringType())
def _trimmed(text: pd.Series, sigs: pd.Series, chars: pd.Series, note: pd.Series) -> pd.Series:
    """``chars``: each character's part of the signature; ``note``: signature positions are tried where one of its words begins."""
    out = []
    for t, s, c in zip(text, sigs, chars):
        sig = "".join(c)
        places = [i for i, x in enumerate(c) for _ in x]
        known = sorted((x for x in s if len(x) >= 4), key=lambda x: (-len(x), x))
        starts = sorted(i for i in range(1, len(sig)) if sig.startswith(NOTE_STARTS + NOTE_MARKERS, i)) if len(sig) >= 12 and known else []
        cut = next((i for i in starts if _covered(sig[:i], known)), None)
        out.append(t if cut is None else t[places[cut] :].lstrip())
    return pd.Series(out, dtype=object)


def cell_keys(rows: Column) -> Column:
    """Signatures of at least six characters of all cells and whole rows of a table."""
    whole = F.transform(rows, lambda r: F.array_join(F.transform(r, _filled), ""))
    return F.array_distinct(F.filter(F.transform(F.concat(whole, F.flatten(F.transform(rows, lambda r: F.transform(r, _filled)))), T.cell_signature), lambda s: F.length(s) >= 6))


def trimmed_note(text: Column, rows: Column) -> Column:
    """A note without the start that repeats cells of its table, where an opening word follows them."""
    t = T.strip(_filled(text))
    return _trimmed(t, cell_keys(rows), F.transform(F.filter(F.split(t, ""), lambda c: c != ""), T.cell_signature), t)


@F.pandas_udf(IntegerType())
def _repeated(rows: pd.Series, texts: pd.Series) -> pd.Series:
    out = []
    for r, t in zip(rows, texts):
        known = [x for x in t if len(x) >= 6]
        known += ["".join(known)] if known else []
        longest = sorted(set(known), key=lambda x: (-len(x), x))
        n = 0
        while n < len(r) and len(r[n]) >= 6 and (any(r[n] in k or k in r[n] for k in longest) or _covered(r[n], longest)):
            n += 1
        out.append(n)
    return pd.Series(out, dtype="int32")


def without_repeated_head(rows: Column, texts: Column) -> Column:
    """Rows after the first ones that the texts (an array) right above the table already say."""
    heads = F.transform(rows, lambda r: T.cell_signature(F.array_join(F.transform(r, _filled), "")))
    n = _repeated(heads, F.transform(texts, lambda x: T.cell_signature(x)))
    return F.slice(rows, n + 1, F.greatest(F.size(rows), F.lit(1)))


def with_tail_notes(stream: DataFrame, tables: DataFrame) -> DataFrame:
    """The stream with Markdown of its tables ``(doc_id, table_id, rows)``: rows from a note on go, the note below the table becomes
    its last row, without what it repeats, and is no text of its own any more (role ``table_note``)."""
    notes = tail_notes(stream).join(tables.select("doc_id", "table_id", "rows"), ["doc_id", "table_id"])
    notes = notes.select("doc_id", "scope_id", "table_id", F.col("item_id").alias("note_id"), trimmed_note(F.col("text"), F.col("rows")).alias("note"))
    shown = tables.select("doc_id", F.col("table_id").alias("item_id"), without_tail_notes(F.col("rows")).alias("_rows"))
    out = stream.join(shown, ["doc_id", "item_id"], "left").join(notes.select("doc_id", "scope_id", F.col("table_id").alias("item_id"), "note"), ["doc_id", "scope_id", "item_id"], "left")
    used = notes.select("doc_id", "scope_id", F.col("note_id").alias("item_id"), F.lit(True).alias("_used"))
    out = out.join(used, ["doc_id", "scope_id", "item_id"], "left").withColumn("role", F.when(F.col("_used"), "table_note").otherwise(F.col("role")))
    return out.select(*stream.columns, F.when(F.col("_rows").isNotNull(), TB.markdown(with_note_row(F.col("_rows"), F.col("note")))).alias("markdown"))


# ---- layout pages


def is_native_model(source: Column) -> Column:
    """Whether a table model was read from the page itself."""
    return F.startswith(_filled(source), F.lit("pdfplumber"))


def clipped_box(box: Column, width: Column, height: Column) -> Column:
    """A box inside its page; an unknown or zero size doesn't clip."""
    def inside(v: Column, size: Column) -> Column:
        return F.when(F.coalesce(size, F.lit(0)) == 0, v).otherwise(F.greatest(F.lit(0.0), F.least(v, size.cast("double"))))

    return G.box(inside(box[0], width), inside(box[1], height), inside(box[2], width), inside(box[3], height))


def layout_tables(layout: DataFrame) -> DataFrame:
    """Tables of layout pages: parsed ones with their cells, then detected boxes that no table before them on the page covers by 0.8."""
    page = (F.col("page_index") + 1).alias("page_no")
    parsed = layout.select("doc_id", page, F.posexplode("parsing_res_list").alias("n", "x")).filter((F.col("x.block_label") == "table") & (F.size("x.block_bbox") >= 4))
    parsed = parsed.select("doc_id", "page_no", stable_id("pp-table", F.col("doc_id"), F.col("page_no"), F.col("n") + 1, F.to_json("x.block_bbox"), F.substring("x.block_content", 1, 120)).alias("table_id"), F.slice("x.block_bbox", 1, 4).alias("bbox"), F.lit("parsing_res_list").alias("source_detail"), F.col("x.block_content").alias("table_html"), F.lit(None).cast("double").alias("score"))
    own = F.transform(F.filter("parsing_res_list", lambda x: (x["block_label"] == "table") & (F.size(x["block_bbox"]) >= 4)), lambda x: F.slice(x["block_bbox"], 1, 4))
    found = F.transform(F.filter("layout_det_res.boxes", lambda x: (x["label"] == "table") & (F.size(x["coordinate"]) >= 4)), lambda x: F.struct(F.slice(x["coordinate"], 1, 4).alias("bbox"), x["score"].cast("double").alias("score")))
    empty = F.array().cast("array<struct<bbox:array<double>,score:double>>")

    def taken(kept: Column, x: Column) -> Column:
        free = ~F.exists("_own", lambda b: G.overlap_by_smaller(x["bbox"], b) >= 0.8) & ~F.exists(kept, lambda k: G.overlap_by_smaller(x["bbox"], k["bbox"]) >= 0.8)
        return F.when(free, F.concat(kept, F.array(x))).otherwise(kept)

    boxes = layout.select("doc_id", page, F.coalesce(own, F.array().cast("array<array<double>>")).alias("_own"), F.coalesce(found, empty).alias("_found")).select("doc_id", "page_no", F.posexplode(F.aggregate("_found", empty, taken)).alias("n", "x"))
    boxes = boxes.select("doc_id", "page_no", stable_id("pp-table-region", F.col("doc_id"), F.col("page_no"), F.col("n") + 1, F.to_json("x.bbox")).alias("table_id"), F.col("x.bbox").alias("bbox"), F.lit("layout_det_res").alias("source_detail"), F.lit("").alias("table_html"), F.col("x.score").alias("score"))
    both = parsed.unionByName(boxes).withColumn("model", F.when(F.col("table_html") != "", TB.html_model(F.col("table_html"))))
    return both.withColumn("rows", F.coalesce("model.rows", F.array().cast("array<array<string>>")))


def layout_regions(layout: DataFrame) -> DataFrame:
    """Candidate regions from layout pages: parsed tables at 0.68, detected boxes at their score between 0.45 and 0.72."""
    page = (F.col("page_index") + 1).alias("page_no")

    def regions(src: str, box: str, label: str, confidence: Column, name: str) -> DataFrame:
        rows = layout.select("doc_id", page, F.posexplode(src).alias("n", "x")).filter((F.col(f"x.{label}") == "table") & (F.size(f"x.{box}") >= 4))
        own = stable_id(name, F.col("doc_id"), F.col("page_no"), F.col("n") + 1, F.to_json(f"x.{box}"))
        return rows.select("doc_id", own.alias("region_id"), "page_no", F.slice(f"x.{box}", 1, 4).alias("bbox"), F.array(F.lit("pp_structure")).alias("detectors"), confidence.alias("confidence"), F.array().cast("array<string>").alias("source_table_ids"))

    score = F.greatest(F.lit(0.45), F.least(F.lit(0.72), F.coalesce(F.col("x.score").cast("double"), F.lit(0.0))))
    return regions("parsing_res_list", "block_bbox", "block_label", F.lit(0.68), "table-region-pp-block").unionByName(regions("layout_det_res.boxes", "coordinate", "label", score, "table-region-pp-layout"))


def table_regions(tables: DataFrame) -> DataFrame:
    """A region for each table ``(doc_id, page_no, table_id, bbox, source_type)``: 0.68 for layout models, 0.72 for native tables."""
    model = F.col("source_type") == "pp_structure_table"
    return tables.filter(F.size("bbox") >= 4).select(
        "doc_id", stable_id("table-region-source", F.col("doc_id"), F.col("page_no"), F.col("table_id"), F.to_json("bbox")).alias("region_id"), "page_no", F.slice("bbox", 1, 4).alias("bbox"),
        F.array(F.when(model, "pp_structure").otherwise("pdfplumber")).alias("detectors"), F.when(model, 0.68).otherwise(0.72).alias("confidence"), F.array("table_id").alias("source_table_ids"),
    )


def recognised_lines(layout: DataFrame) -> DataFrame:
    """Recognised lines of layout pages: the n-th text that isn't blank with the n-th box of four numbers and the n-th score."""
    ocr = F.col("overall_ocr_res")
    boxes = F.transform(F.filter(F.transform(ocr["rec_boxes"], lambda b: F.filter(b, lambda v: v.isNotNull())), lambda b: F.size(b) >= 4), lambda b: F.slice(b, 1, 4))
    texts, scores = F.filter(ocr["rec_texts"], lambda t: ~T.is_blank(_filled(t))), F.filter(ocr["rec_scores"], lambda s: s.isNotNull())
    rows = layout.select("doc_id", (F.col("page_index") + 1).alias("page_no"), F.col("height").cast("double").alias("page_height"), F.posexplode(F.arrays_zip(texts.alias("text"), boxes.alias("bbox"), scores.alias("score"))).alias("n", "x"))
    return rows.select("doc_id", "page_no", "page_height", "n", "x.text", "x.bbox", "x.score").filter(F.col("text").isNotNull() & F.col("bbox").isNotNull())


def is_margin_line(text: Column, box: Column, page_height: Column) -> Column:
    """Running headers within 90 points of the top, and numbers within 70 of the bottom of a page of known height."""
    t = T.compact(_filled(text))
    low = F.coalesce((page_height > 0) & (box[3] >= page_height - 70), F.lit(False))
    return (t == "") | ((box[1] <= 90) & _has(t, HEADER_WORDS)) | (low & t.rlike(r"(?U)^\d+$"))


def region_lines(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Texts and scores of the recognised lines whose centre lies in a region, four points of tolerance, margins left out."""
    r = regions.select("doc_id", "page_no", "region_id", F.col("bbox").alias("region_box"))
    j = lines.join(r, ["doc_id", "page_no"]).filter(G.center_inside(F.col("bbox"), F.col("region_box"), 4.0) & ~is_margin_line(F.col("text"), F.col("bbox"), F.col("page_height")))
    g = j.groupBy("doc_id", "page_no", "region_id").agg(F.array_sort(F.collect_list(F.struct("n", "text", "score"))).alias("x"))
    return g.select("doc_id", "page_no", "region_id", F.transform("x", lambda v: v["text"]).alias("texts"), F.filter(F.transform("x", lambda v: v["score"]), lambda s: s.isNotNull()).alias("scores"))


# ---- image references in table cells


def embedded_ref(image_id: Column, ext: Column, n: Column) -> Column:
    """The file of the n-th embedded image: a safe form of its id, png for unknown types."""
    fallback = F.concat(F.lit("image-"), n.cast("string"))
    own = F.coalesce(F.nullif(T.strip(_filled(image_id)), F.lit("")), fallback)
    safe = F.btrim(F.regexp_replace(own, r"(?U)[^\w一-鿿.-]+", "_"), F.lit("._"))
    kind = F.btrim(F.lower(_filled(ext)), F.lit("."))
    return F.concat(F.lit("embedded_images/"), F.coalesce(F.nullif(safe, F.lit("")), fallback), F.lit("."), F.when(kind.isin(*IMAGE_TYPES), kind).otherwise("png"))


def filled_cells(cells: Column, refs: Column) -> Column:
    """Cells (structs with ``text`` and ``image_ref``): the n-th picture cell without a reference takes the n-th of ``refs``, while there are any."""
    def free(c: Column) -> Column:
        return (T.strip(_filled(c["text"])) == PICTURE_CELL) & (_filled(c["image_ref"]) == "")

    at = F.filter(F.transform(cells, lambda c, i: F.when(free(c), i)), lambda i: i.isNotNull())
    return F.transform(cells, lambda c, i: c.withField("image_ref", F.coalesce(F.when(free(c), F.get(refs, F.array_position(at, i).cast("int") - 1)), c["image_ref"])))


def retargeted_cells(cells: Column, targets: Column) -> Column:
    """Cells whose references are replaced by ``targets`` (map of old reference or image id to new); free picture cells take its values in order."""
    moved = F.transform(cells, lambda c: c.withField("image_ref", F.coalesce(F.try_element_at(targets, F.trim(_filled(c["image_ref"]))), c["image_ref"])))
    return F.when(targets.isNull() | (F.size(targets) == 0), cells).otherwise(filled_cells(moved, F.array_distinct(F.map_values(targets))))


def reference_targets(refs: DataFrame, images: DataFrame) -> DataFrame:
    """For each table the map ``targets`` from references ``(doc_id, table_id, n, image_ref, image_id)`` to files ``(doc_id, image_id, file)``."""
    j = refs.join(images.select("doc_id", "image_id", "file"), ["doc_id", "image_id"]).filter(_filled(F.col("file")) != "")
    keys = j.select("doc_id", "table_id", "n", "file", F.posexplode(F.filter(F.array("image_ref", "image_id"), lambda k: _filled(k) != "")).alias("m", "k"))
    once = top(keys, ["doc_id", "table_id", "k"], [F.desc("n"), F.desc("m")])
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("n", "m", "k", "file"))), lambda x: F.struct(x["k"], x["file"]))
    return once.groupBy("doc_id", "table_id").agg(F.map_from_entries(pairs).alias("targets"))
