"""Further driver queries: containers, scopes, regions, index entries, evidence and cell texts, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import candidates as C
from ..operators import context as X
from ..operators import masks as M
from ..operators import matching as MA
from ..operators import packaging as P
from ..operators import review_index as V
from ..operators import rules as RU
from ..operators import sections as S
from ..operators import tables as TB
from .queries import BOXES, CANDS, LINES, blocks, boxes, order_candidates, query, table

# ---- regions of pages

SHARED = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
AREA_A, AREA_B = "((a.x1 - a.x0) * (a.y1 - a.y0))", "((b.x1 - b.x0) * (b.y1 - b.y0))"
CENTRE = "((a.x0 + a.x1) / 2 BETWEEN b.x0 AND b.x1 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 AND b.y1)"
OWN_A = f"(CASE WHEN {AREA_A} > 0 THEN ({SHARED}) / {AREA_A} ELSE 0 END)"
OWN_B = f"(CASE WHEN {AREA_B} > 0 THEN ({SHARED}) / {AREA_B} ELSE 0 END)"
SMALLER = f"(CASE WHEN least({AREA_A}, {AREA_B}) > 0 THEN ({SHARED}) / least({AREA_A}, {AREA_B}) ELSE 0 END)"
SIDES = f"{BOXES}, a AS (SELECT * FROM boxes WHERE kind = 'N'), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, region_id) AS ord FROM boxes WHERE kind = 'R')"


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, sf)
    regions = b.filter("kind = 'R'").withColumn("ord", F.struct("page_no", "region_id"))
    return b.filter("kind = 'N'"), regions


def _first_region(hit: str) -> str:
    return f"WITH {SIDES} SELECT a.doc_id, a.region_id AS item_id, b.region_id FROM a JOIN b USING (doc_id, page_no) WHERE {hit} QUALIFY row_number() OVER (PARTITION BY a.doc_id, a.region_id ORDER BY b.ord) = 1"


@query(_first_region(f"{CENTRE} OR {OWN_A} >= 0.15"))
def text_in_tables(spark, sf):
    texts, regions = _sides(spark, sf)
    return M.in_regions(texts.withColumnRenamed("region_id", "item_id"), regions, 0.15)


@query(_first_region(f"{CENTRE} AND {OWN_A} >= 0.8"))
def text_in_images(spark, sf):
    texts, regions = _sides(spark, sf)
    return M.in_regions(texts.withColumnRenamed("region_id", "item_id"), regions, 0.8, both=True)


@query(f"""WITH {SIDES}, hit AS (SELECT a.doc_id, a.region_id FROM a JOIN b USING (doc_id, page_no) WHERE NOT ({OWN_B} >= 0.8 AND {AREA_B} < 0.8 * {AREA_A}) AND ({SMALLER} >= 0.65 OR {CENTRE} OR {OWN_A} >= 0.3))
SELECT doc_id, region_id FROM a ANTI JOIN hit USING (doc_id, region_id)""")
def regions_without_pictures(spark, sf):
    regions, images = _sides(spark, sf)
    return TB.drop_image_regions(regions, images).select("doc_id", "region_id")


@query(f"WITH {SIDES} SELECT a.doc_id, a.page_no, a.region_id AS table_id, b.region_id AS image_id FROM a JOIN b USING (doc_id, page_no) WHERE {OWN_B} >= 0.8")
def images_in_tables(spark, sf):
    tables, images = _sides(spark, sf)
    return TB.embedded_images(tables.withColumnRenamed("region_id", "table_id"), images.withColumnRenamed("region_id", "image_id")).select("doc_id", "page_no", "table_id", "image_id")


@query(f"""WITH {SIDES}, pairs AS (SELECT a.doc_id, a.region_id AS a_id, b.region_id AS b_id FROM a JOIN b USING (doc_id, page_no) WHERE {SMALLER} >= 0.8), best AS (SELECT doc_id, a_id, min(b_id) AS b_id FROM pairs GROUP BY ALL)
SELECT a.doc_id, a.region_id AS table_id, CASE WHEN a.page_no % 2 = 0 THEN 'model ' || a.region_id ELSE coalesce('native ' || best.b_id, '') END AS cells FROM a LEFT JOIN best ON best.doc_id = a.doc_id AND best.a_id = a.region_id
UNION ALL SELECT b.doc_id, b.region_id, 'native ' || b.region_id FROM b WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.doc_id = b.doc_id AND p.b_id = b.region_id)""")
def merged_table_sources(spark, sf):
    def rows(df: DataFrame, name: str, there) -> DataFrame:
        cells = F.when(there, F.array(F.array(F.concat(F.lit(name + " "), "region_id")))).otherwise(F.array().cast("array<array<string>>"))
        return df.select("doc_id", "page_no", F.col("region_id").alias("table_id"), "bbox", cells.alias("rows"))

    a, b = _sides(spark, sf)
    got = TB.merge_sources(rows(a, "model", F.col("page_no") % 2 == 0), rows(b, "native", F.lit(True)))
    return got.select("doc_id", "table_id", F.array_join(F.flatten("rows"), ",").alias("cells"))


@query(f"""WITH {BOXES}, r AS (SELECT doc_id, page_no, list_sort(list(region_id)) AS ids FROM boxes GROUP BY ALL), x AS (SELECT doc_id, page_no, unnest(ids) AS table_id, unnest(range(len(ids))) AS n FROM r),
f AS (SELECT x.doc_id, x.page_no, min_by(x.table_id, n) AS table_id FROM x JOIN boxes b ON b.doc_id = x.doc_id AND b.region_id = x.table_id AND b.kind = 'A' GROUP BY ALL)
SELECT r.doc_id, r.page_no::BIGINT AS page_no, f.table_id FROM r LEFT JOIN f USING (doc_id, page_no)""")
def tables_of_regions(spark, sf):
    b = boxes(spark, sf)
    regions = b.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list("region_id")).alias("source_table_ids")).withColumn("region_id", F.col("page_no").cast("string"))
    tables = b.filter("kind = 'A'").select("doc_id", F.col("region_id").alias("table_id"), F.array(F.array("region_id")).alias("rows"))
    return TB.region_tables(regions, tables).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "table_id")


@query(f"""WITH {BOXES}, m AS (SELECT doc_id, page_no, CASE kind WHEN 'A' THEN 'header' WHEN 'R' THEN 'number' ELSE 'text' END AS label, x0, y0, x1, y1 FROM boxes)
SELECT DISTINCT doc_id, page_no::BIGINT AS page_no, label, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM m WHERE label <> 'text'""")
def layout_mask_boxes(spark, sf):
    label = F.when(F.col("kind") == "A", "header").when(F.col("kind") == "R", "number").otherwise("text")
    near = F.transform("bbox", lambda v: v + 0.001)  # the second list gives the same boxes a little off
    layout = boxes(spark, sf).groupBy("doc_id", "page_no").agg(
        F.collect_list(F.struct(label.alias("block_label"), F.col("bbox").alias("block_bbox"))).alias("parsing_res_list"),
        F.struct(F.collect_list(F.struct(label.alias("label"), near.alias("coordinate"))).alias("boxes")).alias("layout_det_res"),
    )
    layout = layout.withColumn("page_index", F.col("page_no") - 1).withColumn("width", F.lit(600.0)).withColumn("height", F.lit(800.0))
    box = [F.col("bbox")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    return M.layout_masks(layout).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "label", *box)


@query(f"""WITH {BOXES} SELECT doc_id, region_id FROM (SELECT *, (x0 * 2)::INT % 300 AS w, (y0 * 3)::INT % 200 AS h FROM boxes)
WHERE w <= 220 AND h <= 120 AND ((abs(x1 - x0) <= 80 AND abs(y1 - y0) <= 40) OR abs(x1 - x0) * abs(y1 - y0) <= 1500)""")
def tiny_images(spark, sf):
    w, h = (F.col("bbox")[0] * 2).cast("int") % 300, (F.col("bbox")[1] * 3).cast("int") % 200
    return boxes(spark, sf).filter(M.is_tiny_image(w, h, F.col("bbox"))).select("doc_id", "region_id")


# ---- matches: scopes, containers, spans


@query(f"WITH {CANDS}, s AS (SELECT unnest(range(3)) AS rule_id, unnest(range(3)) * 20 AS s0) SELECT c.doc_id, c.rule_id, c.ord FROM c LEFT JOIN s USING (rule_id) WHERE s.s0 IS NULL OR (page_no >= s0 + doc_id % 10 AND page_end <= s0 + doc_id % 10 + 25)")
def rows_in_scopes(spark, sf):
    docs = spark.range(40).select(F.col("id").alias("doc_id"))
    scopes = spark.range(3).select(F.col("id").alias("rule_id")).crossJoin(docs).withColumn("scope_start", F.col("rule_id") * 20 + F.col("doc_id") % 10).withColumn("scope_end", F.col("scope_start") + 25)
    return MA.in_scopes(order_candidates(spark, sf), scopes, "page_no", "page_end").select("doc_id", "rule_id", "ord")


CONTAINERS = f"""{CANDS}, once AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY doc_id, rule_id, source_type, title, page_no, page_end ORDER BY page_no, page_end, title, confidence DESC, ord) = 1),
rel AS (SELECT * FROM once WHERE confidence >= 0.75 AND ord NOT IN (SELECT ord FROM pr)),
u AS (SELECT *, CASE ord % 5 WHEN 0 THEN title WHEN 1 THEN '' ELSE 'Part ' || ord % 3 END AS ct, page_no - ord % 4 AS cs, page_end + ord % 6 AS ce FROM (SELECT doc_id, rule_id, title, page_no, page_end, confidence, ord, 0 AS r FROM pr UNION ALL SELECT doc_id, rule_id, title, page_no, page_end, confidence, ord, 1 FROM rel))"""


def _contained(spark, sf) -> tuple[DataFrame, DataFrame]:
    k = F.col("ord") % 5
    title = F.when(k == 0, F.col("title")).when(k == 1, "").otherwise(F.concat(F.lit("Part "), (F.col("ord") % 3).cast("string")))
    c = order_candidates(spark, sf).withColumn("container_title", title).withColumn("container_start", F.col("page_no") - F.col("ord") % 4).withColumn("container_end", F.col("page_end") + F.col("ord") % 6)
    return MA.primary(c), MA.related(c)


@query(f"""WITH {CONTAINERS}, pick AS (SELECT * FROM u WHERE ord % 5 >= 2 QUALIFY row_number() OVER (PARTITION BY doc_id, rule_id ORDER BY ce - cs, cs DESC, confidence DESC, r, ord) = 1)
SELECT o.doc_id, o.rule_id, o.ord, coalesce(pick.ct, o.ct) AS container_title, coalesce(pick.cs, o.cs) AS container_start, coalesce(pick.ce, o.ce) AS container_end FROM u o LEFT JOIN pick USING (doc_id, rule_id) WHERE o.r = 0""")
def container_resolution(spark, sf):
    return MA.resolved_container(*_contained(spark, sf)).select("doc_id", "rule_id", "ord", "container_title", "container_start", "container_end")


@query(f"""WITH {CONTAINERS}, own AS (SELECT doc_id, rule_id, ct FROM u WHERE r = 0)
SELECT u.doc_id, u.rule_id, min(page_no) AS page_start, max(page_end) AS page_end FROM u JOIN own USING (doc_id, rule_id) WHERE u.ct = own.ct GROUP BY ALL""")
def match_spans(spark, sf):
    return C.match_span(*_contained(spark, sf))


# ---- review index

ENTRIES = """e AS (SELECT o_custkey % 40 AS doc_id, o_orderkey AS ord, o_orderpriority AS project_label, o_orderstatus AS element_label, 't' || o_orderkey AS title, o_orderkey % 90 AS page_start FROM orders)"""


@query(f"""WITH {ENTRIES}, g AS (SELECT doc_id, project_label, element_label, min(ord) AS o, string_agg(ord || '/' || title || '/' || page_start, ',' ORDER BY ord) AS x FROM e GROUP BY ALL)
SELECT doc_id, project_label, string_agg(o || ':' || element_label || '=' || x, ';' ORDER BY o) AS tree FROM g GROUP BY ALL""")
def index_trees(spark, sf):
    k = F.col("o_orderkey")
    e = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("doc_id"), k.alias("ord"), F.col("o_orderpriority").alias("project_label"), F.col("o_orderstatus").alias("element_label"), F.concat(F.lit("t"), k.cast("string")).alias("title"), (k % 90).alias("page_start"))

    def joined(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda y: F.concat_ws("/", y["ord"].cast("string"), y["title"], y["page_start"].cast("string"))), ",")

    tree = F.array_join(F.transform("elements", lambda y: F.concat(y["ord"].cast("string"), F.lit(":"), y["element_label"], F.lit("="), joined(y["entries"]))), ";")
    return V.index_tree(e).select("doc_id", "project_label", tree.alias("tree"))


ALIGN = """p AS (SELECT n_regionkey::BIGINT AS doc_id, n_nationkey AS ord, 'Root / ' || n_name AS section_path, lower(replace(n_name, '_', '')) AS leaf FROM nation),
e AS (SELECT n_regionkey::BIGINT AS doc_id, c_custkey AS ord, CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_name || ' annex' WHEN 2 THEN 'other' || c_custkey ELSE 'zzz' END AS title, CASE WHEN c_custkey % 8 = 2 THEN n_name ELSE c_mktsegment END AS element_label FROM customer JOIN nation ON c_nationkey = n_nationkey),
l AS (SELECT DISTINCT doc_id, label, lower(replace(replace(label, '_', ''), ' ', '')) AS key FROM (SELECT doc_id, title AS label FROM e UNION ALL SELECT doc_id, element_label FROM e)),
s AS (SELECT l.doc_id, label, section_path FROM l JOIN p USING (doc_id) WHERE contains(leaf, key) OR contains(key, leaf) QUALIFY row_number() OVER (PARTITION BY l.doc_id, label ORDER BY (leaf <> key)::INT, p.ord) = 1),
j AS (SELECT e.doc_id, e.ord, coalesce(a.section_path, b.section_path) AS own FROM e LEFT JOIN s a ON a.doc_id = e.doc_id AND a.label = e.title LEFT JOIN s b ON b.doc_id = e.doc_id AND b.label = e.element_label)"""


@query(f"WITH {ALIGN} SELECT doc_id, ord, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord) AS score_path FROM j")
def score_alignment(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    doc = F.col("n_regionkey").cast("long").alias("doc_id")
    paths = n.select(doc, F.col("n_nationkey").alias("ord"), F.concat(F.lit("Root / "), "n_name").alias("section_path"))
    k = F.col("c_custkey")
    title = F.when(k % 4 == 0, F.col("n_name")).when(k % 4 == 1, F.concat("n_name", F.lit(" annex"))).when(k % 4 == 2, F.concat(F.lit("other"), k.cast("string"))).otherwise("zzz")
    entries = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(doc, k.alias("ord"), title.alias("title"), F.when(k % 8 == 2, F.col("n_name")).otherwise(F.col("c_mktsegment")).alias("element_label"))
    return V.aligned(entries, paths).select("doc_id", "ord", "score_path")


@query(f"""WITH {LINES}, e AS (SELECT doc_id, page_no, block_no AS ord, regexp_replace(text, '\\s+', '', 'g') AS key FROM blocks WHERE block_no % 7 = 0), b AS (SELECT doc_id, page_no, block_id, y, regexp_replace(text, '\\s+', '', 'g') AS line FROM blocks)
SELECT e.doc_id, e.ord::BIGINT AS ord, b.block_id, b.y AS start_y FROM e LEFT JOIN b ON b.doc_id = e.doc_id AND b.page_no = e.page_no AND b.line <> '' AND (contains(b.line, e.key) OR contains(e.key, b.line))
QUALIFY row_number() OVER (PARTITION BY e.doc_id, e.ord ORDER BY b.y, length(b.line), b.block_id) = 1""")
def index_title_blocks(spark, sf):
    b = blocks(spark, sf)
    entries = b.filter("block_no % 7 = 0").select("doc_id", F.col("block_no").alias("ord"), F.col("text").alias("title"), F.col("page_no").alias("page_start"))
    return V.title_blocks(entries, b).select("doc_id", F.col("ord").cast("long").alias("ord"), "block_id", "start_y")


# ---- pages, evidence, cells


@query(f"""WITH {LINES}, o AS (SELECT l_orderkey % 200 AS doc_id, (l_linenumber % 3 + 1) AS page_no, l_orderkey * 10 + l_linenumber AS ord, l_shipmode_like AS text FROM (SELECT *, l_returnflag AS l_shipmode_like FROM lineitem)),
m AS (SELECT doc_id, page_no, max(block_no) AS last FROM blocks GROUP BY ALL)
SELECT o.doc_id, o.page_no::BIGINT AS page_no, o.ord, (coalesce(last, -1) + row_number() OVER (PARTITION BY o.doc_id, o.page_no ORDER BY ord, text))::BIGINT AS block_no FROM o LEFT JOIN m USING (doc_id, page_no)""")
def ocr_numbering(spark, sf):
    k = F.col("l_orderkey")
    ocr = table(spark, sf, "lineitem").select((k % 200).alias("doc_id"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("page_no"), F.struct((k * 10 + F.col("l_linenumber")).alias("k"), F.col("l_returnflag").alias("t")).alias("ord"), F.col("l_returnflag").alias("text"))
    ocr = ocr.withColumn("text", F.concat_ws(" ", "text", F.col("ord.k").cast("string")))
    got = S.add_ocr(blocks(spark, sf), ocr).filter("source_type = 'ocr'")
    return got.select("doc_id", F.col("page_no").cast("long").alias("page_no"), F.element_at(F.split("text", " "), 2).cast("long").alias("ord"), F.col("block_no").cast("long").alias("block_no"))


@query(f"""WITH {BOXES}, i AS (SELECT doc_id, kind AS scope_id, page_no, region_id, x0 FROM boxes)
SELECT doc_id, scope_id, (SELECT string_agg(p, ',' ORDER BY p::INT) FROM unnest(list_distinct(list(page_no::VARCHAR))) t(p)) AS pages, count(*) FILTER (WHERE NOT (x0 < 100)) AS n_items, min(region_id) FILTER (WHERE NOT (x0 < 100)) AS first_item FROM i GROUP BY ALL""")
def evidence_of_materials(spark, sf):
    i = boxes(spark, sf).select("doc_id", F.col("kind").alias("scope_id"), "page_no", F.col("region_id").alias("item_id"), F.lit("text").alias("item_type"), F.when(F.col("bbox")[0] < 100, "table_text").otherwise("body_text").alias("role"), F.col("region_id").alias("n"))
    got = X.evidence(i)
    return got.select("doc_id", "scope_id", F.array_join("pages", ",").alias("pages"), F.size("evidence").cast("long").alias("n_items"), F.when(F.size("evidence") > 0, F.col("evidence")[0]["item_id"]).alias("first_item"))


@query(f"WITH {LINES} SELECT doc_id, block_id FROM blocks WHERE page_no IN (SELECT DISTINCT unnest([n_nationkey, n_nationkey % 7]) FROM nation WHERE n_nationkey % 6 = 0)")
def pages_of_plan(spark, sf):
    items = table(spark, sf, "nation").select((F.col("n_nationkey") % 6 == 0).alias("parse_table"), F.array("n_nationkey", F.col("n_nationkey") % 7).alias("expected_pages"))
    return RU.prune_pages(blocks(spark, sf), RU.plan_pages(items, "parse_table")).select("doc_id", "block_id")


@query("""SELECT p_partkey, CASE WHEN t LIKE '(%' THEN 2 WHEN contains(substr(t, 1, 6), '.') THEN least(len(t) - len(replace(t, '.', '')) + 1, 4) ELSE 1 END::BIGINT AS level FROM (SELECT p_partkey,
CASE p_partkey % 5 WHEN 0 THEN '(1) ' || p_name WHEN 1 THEN p_size || '.' || p_partkey || ' ' || p_name WHEN 2 THEN '1.2.3.4.5 ' || p_name WHEN 3 THEN p_name || '. end' ELSE p_name END AS t FROM part)""")
def section_levels(spark, sf):
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    numbered = F.concat(F.col("p_size").cast("string"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(" "), name)
    t = F.when(k == 0, F.concat(F.lit("(1) "), name)).when(k == 1, numbered).when(k == 2, F.concat(F.lit("1.2.3.4.5 "), name)).when(k == 3, F.concat(name, F.lit(". end"))).otherwise(name)
    return table(spark, sf, "part").select("p_partkey", T.section_level(t).cast("long").alias("level"))


@query("SELECT p_partkey, regexp_replace(p_name || p_brand || 'ux2.“' || p_type || '”', '[\\s_-]+', '', 'g') AS signature FROM part")
def cell_signatures(spark, sf):
    cell = F.concat(F.col("p_name"), F.lit(", ("), F.col("p_brand"), F.lit("）；µ x₂. 《“"), F.col("p_type"), F.lit("”》。"))
    return table(spark, sf, "part").select("p_partkey", T.cell_signature(cell).alias("signature"))


CELLS = """t AS (SELECT s_suppkey % 50 AS doc_id, 't' || s_suppkey AS table_id, s_suppkey % 4 + 1 AS page_no, (s_suppkey % 20) * 10.0 AS y0, replace(s_name, '_', '') AS sig FROM supplier),
x AS (SELECT l_suppkey % 50 AS doc_id, CASE WHEN l_linenumber < 5 THEN l_suppkey % 4 ELSE l_suppkey % 3 END + 1 AS page_no, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id, l_partkey % 300 AS y0,
  CASE l_linenumber % 3 WHEN 0 THEN s_name WHEN 1 THEN 'see ' || s_name || ', too' ELSE substr(s_name, 1, 5 + l_linenumber) END AS text FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
o AS (SELECT *, regexp_replace(text, '[ ,_]', '', 'g') AS own FROM x), sg AS (SELECT doc_id, page_no, table_id, sig FROM t UNION SELECT doc_id, page_no, table_id, sig || 'total' FROM t),
hit AS (SELECT DISTINCT o.doc_id, item_id, first_value(table_id) OVER (PARTITION BY o.doc_id, item_id ORDER BY table_id) AS table_id FROM o JOIN sg USING (doc_id, page_no) WHERE length(own) >= 6 AND (contains(own, sig) OR contains(sig, own)))"""


def _cells(spark, sf) -> tuple[DataFrame, DataFrame]:
    s, li, k = table(spark, sf, "supplier"), table(spark, sf, "lineitem"), F.col("s_suppkey")
    y = ((k % 20) * 10).cast("double")
    tables = s.select((k % 50).alias("doc_id"), F.concat(F.lit("t"), k.cast("string")).alias("table_id"), (k % 4 + 1).alias("page_no"), F.array(F.lit(0.0), y, F.lit(300.0), y + 80).alias("bbox"), F.array(F.array("s_name"), F.array(F.concat("s_name", F.lit(" total")))).alias("rows"))
    m, n = F.col("l_linenumber") % 3, F.col("l_suppkey")
    text = F.when(m == 0, F.col("s_name")).when(m == 1, F.concat(F.lit("see "), "s_name", F.lit(", too"))).otherwise(F.substring("s_name", F.lit(1), (5 + F.col("l_linenumber")).cast("int")))
    top = (F.col("l_partkey") % 300).cast("double")
    texts = li.join(s, n == k).select(
        (n % 50).alias("doc_id"), (F.when(F.col("l_linenumber") < 5, n % 4).otherwise(n % 3) + 1).alias("page_no"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("item_id"),
        text.alias("text"), F.array(F.lit(0.0), top, F.lit(90.0), top + 12).alias("bbox"),
    )
    return texts, tables


@query(f"WITH {CELLS} SELECT doc_id, item_id, table_id FROM hit")
def cell_texts(spark, sf):
    texts, tables = _cells(spark, sf)
    return P.cell_texts(texts, tables)


@query(f"""WITH {CELLS}, b AS (SELECT h.doc_id, h.table_id, min(x.y0) AS top, max(x.y0 + 12) AS bottom FROM hit h JOIN x USING (doc_id, item_id) GROUP BY ALL)
SELECT t.doc_id, t.table_id, greatest(t.y0, coalesce(top, t.y0))::DOUBLE AS top, least(t.y0 + 80, coalesce(bottom, t.y0 + 80))::DOUBLE AS bottom FROM t LEFT JOIN b USING (doc_id, table_id)""")
def table_bounds(spark, sf):
    texts, tables = _cells(spark, sf)
    return P.table_bounds(tables, texts)


@query(f"""WITH {BOXES}, i AS (SELECT doc_id, page_no, region_id, kind, x0 > 200 AS ordered, floor(x0 / 100) AS a, floor(y0 / 200) AS b FROM boxes)
SELECT doc_id, region_id AS item_id FROM i WHERE NOT ordered AND NOT EXISTS (SELECT 1 FROM i s WHERE s.ordered AND s.doc_id = i.doc_id AND s.page_no = i.page_no AND s.kind = i.kind AND s.a = i.a + 2 AND s.b = i.b)""")
def stream_without_repeats(spark, sf):
    x, y = F.col("bbox")[0], F.floor(F.col("bbox")[1] / 200) * 200.0
    place = F.array(F.floor(x / 100) * 100.0 + F.when(x > 200, 0.0).otherwise(200.0), y, F.lit(500.0), F.lit(600.0))
    i = boxes(spark, sf).select("doc_id", F.col("region_id").alias("item_id"), F.lit("text").alias("item_type"), "page_no", place.alias("bbox"), F.concat(F.lit("T "), "kind").alias("text"), (x > 200).alias("ordered"))
    return P.without_repeats(i, i.filter("ordered")).select("doc_id", "item_id")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment WHEN 2 THEN n_name ELSE 'page-' || c_custkey END AS title FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def context_titles(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    title = P.context_title(F.when(k % 4 == 0, F.col("c_name")).when(k % 4 == 1, "  "), F.when(k % 4 <= 1, F.col("c_mktsegment")).when(k % 4 == 2, ""), F.when(k % 4 <= 2, F.col("n_name")).otherwise(" "), k)
    return c.select("c_custkey", title.alias("title"))


@query("SELECT count(*) AS rule_count, (SELECT count(*) FROM nation WHERE n_nationkey % 4 = 1) AS skipped_rows, 'ai_generated,file_type' AS missing_columns FROM nation WHERE n_nationkey % 4 <> 1")
def rule_load_report(spark, sf):
    n = table(spark, sf, "nation")
    return RU.load_report(n.filter("n_nationkey % 4 <> 1"), n.filter("n_nationkey % 4 = 1"), ["file_type", "ai_generated"])
