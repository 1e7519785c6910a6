"""Driver queries of finished materials: attachments, image kinds, notes, layout tables, references, documents, trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import materials as A
from .queries import BOXES, LINES, blocks, boxes, query, table

# ---- images

SHOWN = f"""{BOXES}, i AS (SELECT *, 2 * (x1 - x0) AS w, 2 * (y1 - y0) AS h, (y0::INT % 7) * 30000 AS px,
  CASE WHEN doc_id % 2 = 0 THEN '法定代表人授权委托书 / 身份证' || kind ELSE 'Other / ' || kind END AS section_path FROM boxes)"""


def _wide(across: float, down: float):
    b = F.col("bbox")
    return G.box(b[0], b[1], b[0] + (b[2] - b[0]) * across, b[1] + (b[3] - b[1]) * down)


@query(f"""WITH {SHOWN} SELECT doc_id, section_path, region_id AS image_id FROM i WHERE doc_id % 2 = 1 UNION ALL
SELECT doc_id, section_path, region_id FROM (SELECT * FROM i WHERE doc_id % 2 = 0 AND w >= 120 AND h >= 70 AND w * h >= 15000 AND (px = 0 OR px >= 120000) AND w / h BETWEEN 1.2 AND 8
  QUALIFY row_number() OVER (PARTITION BY doc_id, section_path ORDER BY page_no, y0, x0, region_id) <= 2)""")
def identity_images(spark, sf):
    path = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("法定代表人授权委托书 / 身份证"), "kind")).otherwise(F.concat(F.lit("Other / "), "kind"))
    i = boxes(spark, sf).select("doc_id", "page_no", F.col("region_id").alias("image_id"), _wide(2, 2).alias("bbox"), path.alias("section_path"), ((F.col("bbox")[1].cast("int") % 7) * 100).alias("width"), F.lit(300).alias("height"))
    return A.limited_identity_images(i).select("doc_id", "section_path", "image_id")


@query(f"""WITH {BOXES}, i AS (SELECT *, 3 * (x1 - x0) AS w, (y1 - y0) AS h, CASE WHEN page_no % 2 = 0 THEN 2000.0 END AS ph FROM boxes)
SELECT doc_id, region_id FROM i WHERE (h <= 40 OR coalesce(h / ph <= 0.035, false)) AND w <= 320 AND CASE kind WHEN 'A' THEN true WHEN 'N' THEN h <= 24 AND w <= 180 ELSE page_no % 3 = 0 END""")
def title_images(spark, sf):
    text = F.when(F.col("kind") == "A", "1.2 x").when(F.col("kind") == "R", F.when(F.col("page_no") % 3 == 0, " （3） ").otherwise("3 abc"))
    i = boxes(spark, sf).withColumn("bbox", _wide(3, 1))
    return i.filter(A.is_title_image(F.col("bbox"), F.lit(None).cast("double"), F.when(F.col("page_no") % 2 == 0, 2000.0), text)).select("doc_id", "region_id")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'seal_or_stamp' WHEN p_partkey % 5 = 1 THEN 'content_image' WHEN p_partkey % 7 = 3 THEN 'decorative_image' WHEN p_partkey % 11 < 4 THEN 'seal_or_stamp'
  WHEN p_partkey % 4 = 2 THEN 'watermark' WHEN p_partkey % 11 = 5 THEN 'decorative_image' WHEN p_size > 40 THEN 'seal_or_stamp' ELSE 'content_image' END AS kind FROM part""")
def image_kinds(spark, sf):
    k = F.col("p_partkey")
    label = F.when(k % 11 < 4, "Signature_Stamp").when(k % 11 == 5, "background").otherwise("image")
    kind = A.image_kind(F.when(k % 5 == 0, " Stamp ").when(k % 5 == 1, "photo").otherwise("unknown"), F.when(k % 7 == 3, "Image_Text"), [label, F.when(k % 4 == 2, "water mark"), F.lit(None).cast("string")], F.col("p_size") > 40)
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind"))


# ---- attachments and anchors


@query("""WITH b AS (SELECT o_custkey % 40 AS doc_id, o_orderkey % 30 AS page_no, (o_custkey % 17) * 40.0 AS y, o_orderkey AS block_no, 'b' || o_orderkey AS block_id, o_orderkey % 6 AS k FROM orders),
m AS (SELECT *, lead(page_no) OVER w AS np, lead(y) OVER w AS ny, lead(block_id) OVER w AS nb FROM b WHERE k <= 2 WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, y, block_no)),
l AS (SELECT doc_id, max(page_no) AS last_page FROM b GROUP BY ALL)
SELECT doc_id, page_no AS start_page, y::DOUBLE AS start_y, coalesce(np, last_page) AS end_page, ny::DOUBLE AS end_y, block_id AS start_block_id, nb AS end_block_id FROM m JOIN l USING (doc_id) WHERE k = 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY page_no, y, block_no) = 1""")
def attachment_scopes(spark, sf):
    k, y = F.col("o_orderkey"), ((F.col("o_custkey") % 17) * 40).cast("double")
    text = F.when(k % 6 == 0, "附：法定代表人 身份证（扫描件）").when(k % 6 == 1, "附：营业执照").when(k % 6 == 2, "附: ").otherwise("正文 身份证扫描件")
    b = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("doc_id"), (k % 30).alias("page_no"), k.alias("block_no"), F.concat(F.lit("b"), k.cast("string")).alias("block_id"), text.alias("text"), F.array(F.lit(0.0), y, F.lit(9.0), y + 9).alias("bbox"))
    leaves = F.explode(F.array(*map(F.lit, ("法定代表人授权委托书 / 法定代表人身份证扫描件", "Root / 法定代表人身份证扫描件", "法定代表人授权委托书 / 委托书"))))
    paths = b.select("doc_id").distinct().select("doc_id", leaves.alias("section_path"))
    return A.attachment_scopes(paths, b).drop("section_path")


PLACES = f"""{BOXES}, d AS (SELECT DISTINCT * FROM boxes), a AS (SELECT doc_id, page_no, region_id, y0 FROM d WHERE kind = 'A' AND page_no % 4 = 0), e AS (SELECT DISTINCT doc_id, page_no, y0 FROM d WHERE kind <> 'R'),
i AS (SELECT * FROM d WHERE kind = 'R')"""


def _places(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    d = boxes(spark, sf).distinct()
    y = F.col("bbox")[1].alias("y")
    anchors = d.filter("kind = 'A' and page_no % 4 = 0").select("doc_id", "page_no", F.col("region_id").alias("anchor_id"), y)
    return anchors, d.filter("kind = 'R'").select("doc_id", "page_no", F.col("region_id").alias("image_id"), "bbox"), d.filter("kind <> 'R'").select("doc_id", "page_no", y)


@query(f"""WITH {PLACES}, n AS (SELECT a.doc_id, a.page_no, a.region_id, a.y0, min(e.y0) AS ny FROM a LEFT JOIN e ON e.doc_id = a.doc_id AND e.page_no = a.page_no AND e.y0 > a.y0 GROUP BY ALL)
SELECT n.doc_id, n.page_no::BIGINT AS page_no, n.region_id AS anchor_id, i.region_id AS image_id, row_number() OVER (PARTITION BY n.doc_id, n.region_id ORDER BY round_even(i.y0 / 40, 0), i.x0, i.y0, i.region_id) AS n
FROM n JOIN i ON i.doc_id = n.doc_id AND i.page_no = n.page_no AND i.y0 > n.y0 AND (ny IS NULL OR i.y0 < ny)""")
def anchor_images(spark, sf):
    anchors, images, edges = _places(spark, sf)
    return A.anchor_images(anchors, images, edges).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "anchor_id", "image_id", F.col("n").cast("long").alias("n"))


@query(f"""WITH {PLACES}, c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY y0, region_id) AS n FROM a), p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY y0, x0, region_id) AS n FROM i)
SELECT c.doc_id, c.page_no::BIGINT AS page_no, c.region_id AS candidate_id, p.region_id AS image_id FROM c JOIN p USING (doc_id, page_no, n)""")
def paired_images(spark, sf):
    anchors, images, _ = _places(spark, sf)
    c = anchors.select("doc_id", "page_no", F.col("anchor_id").alias("candidate_id"), F.col("y").alias("ord"))
    return A.paired_images(c, images).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "candidate_id", "image_id")


GRAMS = "list_distinct(list_transform(range(1, greatest(length({0}), 2)), lambda i: substr({0}, i::INT, 2)))"


@query(f"""WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '投标人 ' WHEN 1 THEN '营业执照' ELSE '' END || p_name AS title, CASE p_partkey % 3 WHEN 0 THEN '投标人营业执照' ELSE '' END || lead(p_name || ' ' || p_brand) OVER (ORDER BY p_partkey) AS text FROM part),
k AS (SELECT *, lower(regexp_replace(title, '[\\s:''-]+', '', 'g')) AS a, lower(regexp_replace(text, '[\\s:''-]+', '', 'g')) AS b FROM p WHERE text IS NOT NULL)
SELECT p_partkey FROM k WHERE (p_partkey % 5 > 1 OR p_partkey % 3 = 0) AND (contains(a, b) OR contains(b, a) OR len(list_intersect({GRAMS.format('a')}, {GRAMS.format('b')}))::DOUBLE / len({GRAMS.format('a')}) >= 0.35)""")
def anchor_title_matches(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part")
    title = F.concat(F.when(k % 5 == 0, "投标人 ").when(k % 5 == 1, "营业执照").otherwise(""), "p_name")
    below = p.select((k - 1).alias("p_partkey"), F.concat("p_name", F.lit(" "), "p_brand").alias("after"))  # part keys are dense
    text = F.concat(F.when(k % 3 == 0, "投标人营业执照").otherwise(""), "after")
    return p.join(below, "p_partkey").filter(A.anchor_matches(title, text)).select("p_partkey")


# ---- texts


@query(f"""WITH {LINES} SELECT doc_id, ((page_no - 1) // 2)::BIGINT AS scope_id, min(page_no)::BIGINT AS page_start, max(page_no)::BIGINT AS page_end, string_agg(trim(text, ' \t\r'), chr(10) || chr(10) ORDER BY block_no) FILTER (block_no % 5 <> 0) AS content, string_agg(block_id, ',' ORDER BY block_no) AS ids
FROM blocks GROUP BY ALL HAVING count(*) FILTER (block_no % 5 <> 0) > 0""")
def section_texts(spark, sf):
    b = blocks(spark, sf).withColumn("source_type", F.when(F.col("block_no") % 5 == 0, "ocr").otherwise("pdf_text")).withColumn("scope_id", F.expr("(page_no - 1) div 2").cast("long"))
    return A.text_items(b).select("doc_id", "scope_id", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "content", F.array_join("source_block_ids", ",").alias("ids"))


STREAM = """s AS (SELECT l_orderkey % 50 AS doc_id, l_suppkey % 10 AS scope_id, l_orderkey * 10 + l_linenumber AS n, CASE WHEN l_linenumber % 3 = 0 THEN 'table' ELSE 'text' END AS item_type, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id,
  l_orderkey % 3 AS page_no, l_partkey % 50 AS part, l_partkey % 5 AS k FROM (SELECT DISTINCT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY ALL))"""


def _stream(spark, sf, text) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(
        (o % 50).alias("doc_id"), (F.col("l_suppkey") % 10).alias("scope_id"), (o * 10 + n).alias("n"), F.when(n % 3 == 0, "table").otherwise("text").alias("item_type"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("item_id"), (o % 3).alias("page_no"), (o % 3 * 10).cast("double").alias("top_y"), text.alias("text"), F.lit("body_text").alias("role"),
    )


CUT = f"{STREAM}, c AS (SELECT doc_id, scope_id, min(n) AS cut FROM s WHERE item_type = 'text' AND part = scope_id * 3 GROUP BY ALL), kept AS (SELECT s.* FROM s LEFT JOIN c USING (doc_id, scope_id) WHERE cut IS NULL OR n < cut)"


def _cut(spark, sf) -> DataFrame:
    s = _stream(spark, sf, F.concat(F.lit("## Part "), (F.col("l_partkey") % 50).cast("string")))
    children = s.select("doc_id", "scope_id").distinct().withColumn("title", F.concat(F.lit("Part "), (F.col("scope_id") * 3).cast("string")))
    return A.before_child_heading(s, children)


@query(f"WITH {CUT} SELECT doc_id, scope_id, n, item_id FROM kept")
def before_child_headings(spark, sf):
    return _cut(spark, sf).select("doc_id", "scope_id", "n", "item_id")


@query(f"WITH {CUT} SELECT doc_id, scope_id, min_by(page_no, n) AS page_no, min_by(page_no, n) * 10.0::DOUBLE AS top_y FROM kept GROUP BY ALL")
def first_places(spark, sf):
    return A.first_places(_cut(spark, sf))


@query(f"""WITH {STREAM}, x AS (SELECT doc_id, scope_id, n, page_no, item_id FROM s WHERE item_type = 'text' UNION ALL SELECT doc_id, scope_id + 1, n, page_no, item_id FROM s WHERE item_type = 'text' AND k = 0),
f AS (SELECT doc_id, scope_id, min_by(page_no, n) AS p FROM x GROUP BY ALL), m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p, scope_id % 3 + 1, scope_id) AS o FROM f),
once AS (SELECT x.*, o FROM x JOIN m USING (doc_id, scope_id) QUALIFY row_number() OVER (PARTITION BY x.doc_id, item_id ORDER BY o, n) = 1),
t AS (SELECT doc_id, o, string_agg('line ' || item_id, chr(10) || chr(10) ORDER BY n) AS body FROM once GROUP BY ALL),
p AS (SELECT doc_id, o, repeat('#', scope_id % 3 + 2) || ' Section ' || scope_id || coalesce(chr(10) || chr(10) || body, '') AS part FROM m LEFT JOIN t USING (doc_id, o))
SELECT doc_id, '# 解析全文' || chr(10) || chr(10) || string_agg(part, chr(10) || chr(10) ORDER BY o) || chr(10) AS markdown, count(*) AS materials FROM p GROUP BY ALL""")
def full_documents(spark, sf):
    k = F.col("l_partkey") % 5
    s = _stream(spark, sf, k.cast("string")).filter("item_type = 'text'")
    twice = s.filter("text = '0'").withColumn("scope_id", F.col("scope_id") + 1)
    items = s.unionByName(twice).withColumn("text", F.concat(F.lit("line "), "item_id")).withColumn("bbox", F.array(F.lit(0.0)))
    scopes = items.select("doc_id", "scope_id").distinct()
    materials = scopes.select("*", F.concat(F.lit("Section "), F.col("scope_id").cast("string")).alias("title"), (F.col("scope_id") % 3 + 1).cast("int").alias("depth"))
    return A.full_documents(items, materials, scopes.limit(0).withColumn("title", F.lit("")))


# ---- notes of tables

NOTE = {0: "投标人须提供 a", 1: "合计", 2: "说明：b", 3: "见发票 c", 4: "x d"}


def _note(key):
    text = None
    for k, v in NOTE.items():
        text = F.when(key == k, v) if text is None else text.when(key == k, v)
    return text


@query(f"""WITH {STREAM}, w AS (SELECT *, last_value(CASE WHEN item_type = 'table' THEN item_id END IGNORE NULLS) OVER v AS t, last_value(CASE WHEN item_type = 'table' THEN page_no END IGNORE NULLS) OVER v AS tp FROM s WINDOW v AS (PARTITION BY doc_id, scope_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, scope_id, t AS table_id, item_id FROM w WHERE item_type = 'text' AND tp = page_no AND k IN (0, 2, 3) QUALIFY row_number() OVER (PARTITION BY doc_id, scope_id, t ORDER BY n) = 1""")
def table_tail_notes(spark, sf):
    return A.tail_notes(_stream(spark, sf, _note(F.col("l_partkey") % 5))).select("doc_id", "scope_id", "table_id", "item_id")


@query(f"""WITH {STREAM}, r AS (SELECT n // 10 AS table_id, n, row_number() OVER (PARTITION BY n // 10 ORDER BY n) - 1 AS i, k FROM s), z AS (SELECT table_id, min(i) FILTER (k = 1) AS total FROM r GROUP BY ALL),
f AS (SELECT table_id, count(*) AS n_rows, min(i) FILTER (k = 2 OR (k IN (0, 3) AND total < i)) AS note_at FROM r JOIN z USING (table_id) GROUP BY ALL)
SELECT table_id, note_at::BIGINT AS note_row, coalesce(note_at, n_rows)::BIGINT AS kept, (n_rows + 1)::BIGINT AS with_note FROM f""")
def tail_note_rows(spark, sf):
    s = _stream(spark, sf, _note(F.col("l_partkey") % 5))
    t = s.groupBy(F.expr("n div 10").alias("table_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: F.array(F.lit(" "), x["text"])).alias("rows"))
    rows = F.col("rows")
    return t.select("table_id", A.tail_note_row(rows).cast("long").alias("note_row"), F.size(A.without_tail_notes(rows)).cast("long").alias("kept"), F.size(A.with_note_row(rows, F.lit("注"))).cast("long").alias("with_note"))


# ---- layout pages

LAYOUT = f"{BOXES}, d AS (SELECT DISTINCT * FROM boxes), f AS (SELECT * FROM d WHERE kind = 'R' QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY region_id) = 1)"


def _layout(spark, sf) -> DataFrame:
    d = boxes(spark, sf).distinct()
    label = F.when(F.col("kind") == "A", "table").otherwise("text")
    parsed = F.struct("region_id", label.alias("block_label"), F.col("bbox").alias("block_bbox"), F.concat(F.lit("<table><tr><td>"), "region_id", F.lit("</td></tr></table>")).alias("block_content"))
    found = F.min(F.when(F.col("kind") == "R", F.struct("region_id", F.lit("table").alias("label"), F.col("bbox").alias("coordinate"), (F.col("page_no") / 30).alias("score"))))
    line = F.struct("region_id", F.when(F.col("bbox")[1] % 60 == 0, "商务投标文件").when(F.col("bbox")[1] % 60 == 20, "12").otherwise(F.col("region_id")).alias("t"), F.col("bbox").alias("b"))
    g = d.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(parsed)).alias("parsing_res_list"), found.alias("one"), F.array_sort(F.collect_list(F.when(F.col("kind") == "N", line))).alias("lines"))
    ocr = F.struct(F.transform("lines", lambda x: x["t"]).alias("rec_texts"), F.transform("lines", lambda x: x["b"]).alias("rec_boxes"), F.transform("lines", lambda x: F.lit(0.5)).alias("rec_scores"))
    return g.select("doc_id", (F.col("page_no") - 1).alias("page_index"), F.lit(600.0).alias("width"), F.lit(600.0).alias("height"), "parsing_res_list", F.struct(F.filter(F.array("one"), lambda x: x.isNotNull()).alias("boxes")).alias("layout_det_res"), ocr.alias("overall_ocr_res"))


def _corners(*more) -> list:
    return [*more, *[F.col("bbox")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]]


CORNERS = "x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1"


@query(f"""WITH {LAYOUT}, t AS (SELECT * FROM d WHERE kind = 'A') SELECT doc_id, 'parsing_res_list' AS source_detail, region_id AS cells, {CORNERS} FROM t UNION ALL
SELECT doc_id, 'layout_det_res', '', {CORNERS} FROM f a WHERE NOT EXISTS (SELECT 1 FROM t b WHERE b.doc_id = a.doc_id AND b.page_no = a.page_no AND least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) > 0
  AND greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) / least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0)) >= 0.8)""")
def layout_tables(spark, sf):
    return A.layout_tables(_layout(spark, sf)).select(*_corners("doc_id", "source_detail", F.array_join(F.flatten("rows"), ",").alias("cells")))


@query(f"WITH {LAYOUT} SELECT doc_id, 0.68::DOUBLE AS confidence, {CORNERS} FROM d WHERE kind = 'A' UNION ALL SELECT doc_id, greatest(0.45, least(0.72, page_no / 30))::DOUBLE, {CORNERS} FROM f")
def layout_regions(spark, sf):
    return A.layout_regions(_layout(spark, sf)).select(*_corners("doc_id", "confidence"))


@query(f"""WITH {LAYOUT} SELECT doc_id, page_no::BIGINT AS page_no, CASE kind WHEN 'A' THEN 'pp_structure' ELSE 'pdfplumber' END AS detector, CASE kind WHEN 'A' THEN 0.68 ELSE 0.72 END::DOUBLE AS confidence, region_id AS source FROM d""")
def table_source_regions(spark, sf):
    t = boxes(spark, sf).distinct().withColumn("source_type", F.when(F.col("kind") == "A", "pp_structure_table").otherwise("pdf_table")).withColumnRenamed("region_id", "table_id")
    return A.table_regions(t).select("doc_id", F.col("page_no").cast("long").alias("page_no"), F.col("detectors")[0].alias("detector"), "confidence", F.col("source_table_ids")[0].alias("source"))


@query(f"""WITH {LAYOUT}, l AS (SELECT *, CASE WHEN y0 % 60 = 0 THEN '商务投标文件' WHEN y0 % 60 = 20 THEN '12' ELSE region_id END AS text FROM d WHERE kind = 'N')
SELECT f.doc_id, f.page_no::BIGINT AS page_no, string_agg(l.text, ',' ORDER BY l.region_id) AS texts, count(*) AS n_scores FROM l JOIN f USING (doc_id, page_no) WHERE (l.x0 + l.x1) / 2 BETWEEN f.x0 - 4 AND f.x1 + 4 AND (l.y0 + l.y1) / 2 BETWEEN f.y0 - 4 AND f.y1 + 4
  AND NOT (l.y0 <= 90 AND text = '商务投标文件') AND NOT (l.y1 >= 530 AND text = '12') GROUP BY ALL""")
def region_lines(spark, sf):
    layout = _layout(spark, sf)
    regions = layout.select("doc_id", (F.col("page_index") + 1).alias("page_no"), F.explode("layout_det_res.boxes").alias("x")).select("doc_id", "page_no", F.col("x.region_id").alias("region_id"), F.col("x.coordinate").alias("bbox"))
    got = A.region_lines(A.recognised_lines(layout), regions)
    return got.select("doc_id", F.col("page_no").cast("long").alias("page_no"), F.array_join("texts", ",").alias("texts"), F.size("scores").cast("long").alias("n_scores"))


# ---- references


@query(f"""WITH {STREAM}, c AS (SELECT n // 10 AS table_id, n, k < 3 AS pic, CASE WHEN k = 1 THEN 'old' || part % 3 WHEN k = 4 THEN 'old9' END AS ref FROM s),
m AS (SELECT *, CASE WHEN ref = 'old0' THEN 'new0' WHEN ref = 'old1' THEN 'new1' ELSE ref END AS moved, row_number() OVER (PARTITION BY table_id, pic AND ref IS NULL ORDER BY n) AS o FROM c)
SELECT table_id, string_agg(coalesce(moved, CASE WHEN pic AND o = 1 THEN 'new0' WHEN pic AND o = 2 THEN 'new1' END, '-'), ',' ORDER BY n) AS refs FROM m GROUP BY ALL""")
def cell_image_refs(spark, sf):
    k, part = F.col("l_partkey") % 5, F.col("l_partkey") % 50
    s = _stream(spark, sf, F.struct(F.when(k < 3, "[图片] ").otherwise("x").alias("text"), F.when(k == 1, F.concat(F.lit("old"), (part % 3).cast("string"))).when(k == 4, "old9").alias("image_ref")))
    t = s.groupBy(F.expr("n div 10").alias("table_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]).alias("cells"))
    targets = F.create_map(*map(F.lit, ("old0", "new0", "old1", "new1", "img", "new0")))
    return t.select("table_id", F.array_join(F.transform(A.retargeted_cells(F.col("cells"), targets), lambda c: F.coalesce(c["image_ref"], F.lit("-"))), ",").alias("refs"))


@query("""SELECT p_partkey, 'embedded_images/' || CASE p_partkey % 3 WHEN 0 THEN 'a_' || p_partkey || '_b' WHEN 1 THEN 'image-' || p_size ELSE 'x-' || p_partkey END || CASE p_partkey % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.webp' ELSE '.png' END AS ref FROM part""")
def embedded_refs(spark, sf):
    k = F.col("p_partkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("._a/ "), k.cast("string"), F.lit("*b."))).when(k % 3 == 1, F.lit(" ")).otherwise(F.concat(F.lit("x-"), k.cast("string")))
    return table(spark, sf, "part").select("p_partkey", A.embedded_ref(own, F.when(k % 4 == 0, ".JPG").when(k % 4 == 1, "webp").when(k % 4 == 2, "gif"), F.col("p_size")).alias("ref"))


@query(f"""WITH {STREAM}, r AS (SELECT n // 10 AS table_id, n, 'r' || part AS image_ref, 'i' || k AS image_id, 'f' || k AS file FROM s WHERE k <> 4),
x AS (SELECT table_id, n, 0 AS m, image_ref AS key, file FROM r UNION ALL SELECT table_id, n, 1, image_id, file FROM r)
SELECT table_id, string_agg(key || '=' || file, ',' ORDER BY key || '=' || file) AS targets FROM (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY table_id, key ORDER BY n DESC, m DESC) = 1) GROUP BY ALL""")
def reference_targets(spark, sf):
    k, part = F.col("l_partkey") % 5, F.col("l_partkey") % 50
    s = _stream(spark, sf, F.struct(F.concat(F.lit("r"), part.cast("string")).alias("r"), F.concat(F.lit("i"), k.cast("string")).alias("i")))
    refs = s.select(F.lit(0).alias("doc_id"), F.expr("n div 10").alias("table_id"), "n", F.col("text.r").alias("image_ref"), F.col("text.i").alias("image_id"))
    images = spark.range(4).select(F.lit(0).alias("doc_id"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_id"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"))
    pairs = F.array_sort(F.transform(F.map_entries("targets"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return A.reference_targets(refs, images).select("table_id", F.array_join(pairs, ",").alias("targets"))


# ---- packages

TREE = """w AS (SELECT DISTINCT n_regionkey::BIGINT AS doc_id, n_name AS a, c_mktsegment AS b FROM customer JOIN nation ON c_nationkey = n_nationkey),
nodes AS (SELECT DISTINCT doc_id, [a] AS parts FROM w UNION ALL SELECT doc_id, [a, b] FROM w)"""


def _paths(spark, sf) -> DataFrame:
    j = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("n_regionkey").cast("long").alias("doc_id"), F.concat_ws(" / ", "n_name", "c_mktsegment").alias("section_path")).distinct()


@query(f"""WITH {TREE} SELECT n.doc_id, row_number() OVER (PARTITION BY n.doc_id ORDER BY parts) AS ord, array_to_string(parts, ' / ') AS path, CASE len(parts) WHEN 2 THEN parts[1] ELSE '' END AS parent, parts[-1] AS name, len(parts) AS depth,
  parts[-1] LIKE '%E' AND len(parts) = 2 AS is_material, (SELECT count(*) FROM w WHERE w.doc_id = n.doc_id AND len(n.parts) = 1 AND w.a = n.parts[1]) AS child_count FROM nodes n""")
def module_tree(spark, sf):
    p = _paths(spark, sf)
    return A.module_tree(p, p.filter("section_path like '%E'")).withColumn("ord", F.col("ord").cast("long")).withColumn("depth", F.col("depth").cast("long"))


@query(f"""WITH {TREE}, c AS (SELECT doc_id, CASE len(parts) WHEN 2 THEN parts[1] ELSE '' END AS parent, parts[-1] AS child FROM nodes)
SELECT doc_id, parent, '# ' || any_value(CASE parent WHEN '' THEN '目录' ELSE parent END) || chr(10) || chr(10) || string_agg('- [' || child || '](' || child || '/material.md)', chr(10) ORDER BY child) || chr(10) AS markdown FROM c GROUP BY doc_id, parent""")
def index_pages(spark, sf):
    from ..operators import packaging as P

    return A.index_markdown(P.index_links(_paths(spark, sf)))


@query("SELECT p_partkey, '/api/runs/' || url_encode(p_name || ' ü*~') || '/images?path=' || url_encode(p_type || '/a-b_c.png') AS url FROM part")
def preview_urls(spark, sf):
    return table(spark, sf, "part").select("p_partkey", A.preview_url(F.concat("p_name", F.lit(" ü*~")), F.concat("p_type", F.lit("/a-b_c.png"))).alias("url"))
