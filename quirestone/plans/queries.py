"""Driver queries of the library's own operators on the driver tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..functions.ids import stable_id
from ..operators import candidates as C
from ..operators import context as X
from ..operators import masks as M
from ..operators import matching as MA
from ..operators import packaging as P
from ..operators import places as PL
from ..operators import retrieval as R
from ..operators import review_index as V
from ..operators import rules as RU
from ..operators import sections as S
from ..operators import tables as TB
from . import rank

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- synthetic relations, by arithmetic on the driver tables, the same in both engines

LINES = """lines AS (SELECT doc_id, unnest(string_split(coalesce(text,''), chr(10))) AS text, generate_subscripts(string_split(coalesce(text,''), chr(10)), 1) - 1 AS block_no FROM documents),
blocks AS (SELECT doc_id, doc_id || '-' || block_no AS block_id, block_no // 20 + 1 AS page_no, block_no, text, ((block_no % 20) * 40)::DOUBLE AS y, 72.0 AS x0, (72 + least(length(text), 90) * 5)::DOUBLE AS x1, ((block_no % 20) * 40 + 12)::DOUBLE AS y1,
  CASE WHEN block_no = 0 THEN 16.0 ELSE (10 + length(text) % 3)::DOUBLE END AS font_size FROM lines WHERE trim(text) <> '')"""
TOC = """toc0 AS (SELECT r_regionkey AS doc_id, -1 AS nk, 1 AS level, r_name AS title FROM region UNION ALL SELECT n_regionkey, n_nationkey, 2, n_name FROM nation
  UNION ALL SELECT DISTINCT n_regionkey, n_nationkey, 3, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey),
toc1 AS (SELECT doc_id::BIGINT AS doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY nk, level, title) AS ord, level, title FROM toc0),
toc AS (SELECT *, ord * 2 - 1 AS page FROM toc1)"""
BOXES = """boxes AS (SELECT l_orderkey % 50 AS doc_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS region_id, (l_orderkey // 50) % 40 + 1 AS page_no, (l_suppkey % 20) * 20.0 AS x0, (l_partkey % 30) * 20.0 AS y0,
  (l_suppkey % 20) * 20.0 + l_quantity * 4 AS x1, (l_partkey % 30) * 20.0 + l_linenumber * 12 AS y1, l_shipmode_like AS kind FROM (SELECT *, l_returnflag AS l_shipmode_like FROM lineitem))"""
RAGGED = """ragged AS (SELECT p_partkey AS table_id, CASE p_partkey % 4 WHEN 0 THEN [[p_name, p_brand, p_type], [p_brand]] WHEN 1 THEN [[p_name], [p_brand, p_type], [p_size::VARCHAR, '', p_type, p_brand]] WHEN 2 THEN [[p_name]] ELSE [[p_brand, '', '', '', '', ''], [p_name, 'a', 'b', '', '', '']] END AS rows FROM part)"""


def blocks(spark, sf) -> DataFrame:
    return S.blocks_from_text(table(spark, sf, "documents"))


def toc(spark, sf) -> DataFrame:
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    rows = table(spark, sf, "region").select(F.col("r_regionkey").alias("doc_id"), F.lit(-1).alias("nk"), F.lit(1).alias("level"), F.col("r_name").alias("title"))
    rows = rows.union(n.select("n_regionkey", "n_nationkey", F.lit(2), "n_name"))
    rows = rows.union(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", "n_nationkey", F.lit(3), "c_mktsegment").distinct())
    ord_ = F.row_number().over(Window.partitionBy("doc_id").orderBy("nk", "level", "title"))
    return rows.withColumn("ord", ord_.cast("long")).select(F.col("doc_id").cast("long").alias("doc_id"), "ord", "level", "title", (F.col("ord") * 2 - 1).alias("page"))


def boxes(spark, sf) -> DataFrame:
    x0, y0 = (F.col("l_suppkey") % 20) * 20.0, (F.col("l_partkey") % 30) * 20.0
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("doc_id"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("region_id"), (F.expr("(l_orderkey div 50) % 40") + 1).cast("int").alias("page_no"),
        G.box(x0, y0, x0 + F.col("l_quantity") * 4, y0 + F.col("l_linenumber") * 12).alias("bbox"), F.col("l_returnflag").alias("kind"),
    )


def ragged(spark, sf) -> DataFrame:
    a, b, c = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    e, s = F.lit(""), F.col("p_size").cast("string")
    m = F.col("p_partkey") % 4
    rows = F.when(m == 0, F.array(F.array(a, b, c), F.array(b))).when(m == 1, F.array(F.array(a), F.array(b, c), F.array(s, e, c, b))).when(m == 2, F.array(F.array(a))).otherwise(F.array(F.array(b, e, e, e, e, e), F.array(a, F.lit("a"), F.lit("b"), e, e, e)))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("table_id"), rows.alias("rows"))


# ---- chunks and retrieval

CHUNKS = """n AS (SELECT *, CASE WHEN length(text) <= 500 THEN 1 ELSE ceil((length(text) - 500) / 420.0)::INT + 1 END AS n FROM documents),
chunks AS (SELECT doc_id, lang, i AS chunk_index, substr(text, i * 420 + 1, 500) AS content FROM (SELECT *, unnest(range(n)) AS i FROM n))"""


def doc_chunks(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("candidate_id"), F.lit("").alias("title"), F.col("text").alias("content"), "lang")
    return R.chunks(d)


@query(f"WITH {CHUNKS} SELECT doc_id, chunk_index::BIGINT AS chunk_index, content FROM chunks")
def chunk_documents(spark, sf):
    return doc_chunks(spark, sf).select(F.col("candidate_id").alias("doc_id"), F.col("chunk_index").cast("long").alias("chunk_index"), "content")


@query(f"WITH {CHUNKS} SELECT lang, count(*) AS n_chunks, sum(length(content))::BIGINT AS n_chars, max(chunk_index)::BIGINT AS last_index FROM chunks GROUP BY lang")
def chunk_stats_by_lang(spark, sf):
    return doc_chunks(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("content")).alias("n_chars"), F.max("chunk_index").cast("long").alias("last_index"))


TOKENS = """t AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[a-z0-9]+') AS tokens FROM documents), q AS (SELECT item_id AS query_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS tokens FROM benchmark)"""


def tokenised(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", T.tokens(F.col("text")).alias("tokens"))
    return d, table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), T.tokens(F.col("text")).alias("tokens"))


@query(f"WITH {TOKENS} SELECT lang, count(*) AS n_tokens, count(DISTINCT token) AS n_terms FROM (SELECT lang, unnest(tokens) AS token FROM t) GROUP BY lang")
def token_stats(spark, sf):
    d, _ = tokenised(spark, sf)
    return d.select("lang", F.explode("tokens").alias("token")).groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("token").alias("n_terms"))


BM25 = f"""{TOKENS}, terms AS (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM t), tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM terms GROUP BY ALL),
tot AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM t), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), raw AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS raw, avgdl FROM df, tot),
idf AS (SELECT term, avgdl, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw) ELSE raw END AS idf FROM raw), qt AS (SELECT query_id, unnest(tokens) AS term FROM q),
s AS (SELECT query_id, doc_id, sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qt JOIN tf USING (term) JOIN idf USING (term) GROUP BY ALL),
a AS (SELECT query_id, doc_id, coalesce(score, 0) AS score FROM (SELECT query_id, doc_id FROM q, t) LEFT JOIN s USING (query_id, doc_id)),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM a QUALIFY rank <= 5)"""


@query(f"WITH {BM25} SELECT query_id, rank::BIGINT AS rank, doc_id, round(score, 6) AS score FROM top")
def bm25_topk(spark, sf):
    d, q = tokenised(spark, sf)
    return R.bm25(d, q, 5).select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


OVERLAP = f"""{TOKENS}, a AS (SELECT query_id, doc_id, len(list_intersect(list_distinct(q.tokens), list_distinct(t.tokens))) AS score FROM q, t), top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM a QUALIFY rank <= 5)"""


@query(f"WITH {OVERLAP} SELECT query_id, rank::BIGINT AS rank, doc_id, score::BIGINT AS score FROM top")
def overlap_topk(spark, sf):
    d, q = tokenised(spark, sf)
    return R.overlap(d, q, 5).select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.col("score").cast("long").alias("score"))


@query(f"""WITH {BM25}, hay AS (SELECT query_id, rank, ' ' || substr(regexp_replace(trim(text), '\\s+', ' ', 'g'), 1, 180) AS hay FROM top JOIN documents USING (doc_id)),
kw AS (SELECT query_id, list_slice(tokens, 1, 2) AS kw FROM q), hit AS (SELECT query_id, min(rank) AS hit_rank FROM hay JOIN kw USING (query_id) WHERE len(list_filter(kw, lambda w: NOT contains(hay, w))) = 0 GROUP BY query_id)
SELECT count(*) AS n_queries, count(hit_rank) AS hit_count, round(count(hit_rank) / count(*), 6) AS hit_rate FROM q LEFT JOIN hit USING (query_id)""")
def retrieval_eval(spark, sf):
    d, q = tokenised(spark, sf)
    ranked = R.bm25(d, q, 5).join(table(spark, sf, "documents").select("doc_id", F.col("text").alias("content")), "doc_id").withColumn("title", F.lit(""))
    e = R.evaluate(ranked, q.select("query_id", F.slice("tokens", 1, 2).alias("keywords")))
    return R.report(e).select("n_queries", "hit_count", F.round("hit_rate", 6).alias("hit_rate"))


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings), a AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_dot_product(q.v, e.v) / (q.norm * e.norm) AS score FROM e, e AS q WHERE q.vec_id < 10)
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::BIGINT AS rank, round(score, 6) AS score FROM a QUALIFY rank <= 5""")
def vector_topk(spark, sf):
    e = table(spark, sf, "embeddings")
    got = R.vector_top(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), e.filter("vec_id < 10").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), 5)
    return got.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@query()
def vector_topk_twentieth(spark, sf):
    """Every row whose id is divisible by 20 asks; the SQL of all pairs is too slow for that, tests hold it against brute force."""
    e = table(spark, sf, "embeddings")
    got = R.vector_top(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), 5)
    return got.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


# ---- text functions and ids


@query("SELECT doc_id, substr(regexp_replace(trim(text), '\\s+', ' ', 'g'), 1, 120) AS preview, regexp_replace(text, '\\s+', '', 'g') AS compacted FROM documents")
def text_previews(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"), T.compact(F.col("text")).alias("compacted"))


@query("SELECT n_nationkey, 'nation_' || substr(sha1(n_regionkey || '||' || n_name), 1, 12) AS id FROM nation")
def stable_ids(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", stable_id("nation", F.col("n_regionkey"), F.col("n_name")).alias("id"))


TITLES = "titles AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '1.2 ' || o_orderpriority WHEN 1 THEN '3. ' || o_orderpriority WHEN 2 THEN '(2.1) ' || o_orderpriority WHEN 3 THEN '一、' || o_orderpriority WHEN 4 THEN '附：' || o_orderpriority ELSE o_orderpriority END AS title FROM orders)"


def titled(spark, sf):
    p, m = F.col("o_orderpriority"), F.col("o_orderkey") % 6
    t = F.when(m == 0, F.concat(F.lit("1.2 "), p)).when(m == 1, F.concat(F.lit("3. "), p)).when(m == 2, F.concat(F.lit("(2.1) "), p)).when(m == 3, F.concat(F.lit("一、"), p)).when(m == 4, F.concat(F.lit("附："), p)).otherwise(p)
    return table(spark, sf, "orders").select("o_orderkey", t.alias("title"))


@query(f"""WITH {TITLES} SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 12 WHEN 3 THEN 1 WHEN 4 THEN 99 ELSE 50 END::BIGINT AS level, o_orderkey % 6 <> 5 AS heading,
CASE WHEN o_orderkey % 6 = 5 THEN title WHEN o_orderkey % 6 = 0 THEN substr(title, 5) WHEN o_orderkey % 6 = 1 THEN substr(title, 4) WHEN o_orderkey % 6 = 2 THEN substr(title, 7) ELSE substr(title, 3) END AS shown FROM titles""")
def heading_grammar(spark, sf):
    t = F.col("title")
    return titled(spark, sf).select("o_orderkey", T.heading_level(t).cast("long").alias("level"), T.is_heading(t).alias("heading"), T.display_title(t).alias("shown"))


# ---- rules and plans

FILL = """s AS (SELECT *, row_number() OVER (ORDER BY r_name, n_name) AS ord FROM region JOIN nation ON n_regionkey = r_regionkey),
sparse AS (SELECT ord, CASE WHEN lag(r_name) OVER (ORDER BY ord) = r_name THEN '' ELSE r_name END AS module_name, n_name AS sub_content_1, r_name FROM s)"""


def sparse_rules(spark, sf) -> DataFrame:
    s = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = s.withColumn("row_ord", F.row_number().over(Window.orderBy("r_name", "n_name")))
    blank = F.when(F.lag("r_name").over(Window.orderBy("row_ord")) == F.col("r_name"), "").otherwise(F.col("r_name"))
    flag = lambda k: F.when(F.col("n_nationkey") % k == 0, "是").otherwise("否")
    return s.select(
        F.lit("s").alias("sheet"), "row_ord", F.lit("F").alias("file_type"), blank.alias("module_name"), F.col("n_name").alias("sub_content_1"), F.lit("").alias("sub_content_2"), F.lit("").alias("sub_content_3"),
        flag(2).alias("user_upload_required"), flag(3).alias("from_history_bid"), flag(5).alias("has_standard_template"), flag(7).alias("ai_generated"), flag(11).alias("reference_technical_spec"),
    )


@query(f"WITH {FILL} SELECT ord::BIGINT AS row_ord, 'F / ' || r_name || ' / ' || sub_content_1 AS section_path, 'rule_' || substr(sha1('F / ' || r_name || ' / ' || sub_content_1 || '||' || ord), 1, 12) AS rule_id FROM sparse")
def rule_forward_fill(spark, sf):
    return RU.rules(sparse_rules(spark, sf)).select(F.col("row_ord").cast("long").alias("row_ord"), "section_path", "rule_id")


FLAGS = "f AS (SELECT n_nationkey, list_filter([CASE WHEN n_nationkey % 2 = 0 THEN 'need_user_upload' END, CASE WHEN n_nationkey % 3 = 0 THEN 'historical_reuse' END, CASE WHEN n_nationkey % 5 = 0 THEN 'template_fill' END, CASE WHEN n_nationkey % 7 = 0 THEN 'ai_generate' END, CASE WHEN n_nationkey % 11 = 0 THEN 'spec_reference' END], lambda x: x IS NOT NULL) AS strategy, r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query(f"WITH {FLAGS} SELECT 'F / ' || r_name || ' / ' || n_name AS section_path, array_to_string(strategy, ',') AS strategy, CASE WHEN n_name = 'NATION_3' THEN 'attachment' ELSE 'template_text' END AS content_type, CASE WHEN n_name = 'NATION_3' THEN '附件召回' ELSE '模板参考复用' END AS reuse_method, true AS long_term FROM f WHERE n_name <> 'NATION_1'")
def process_plan(spark, sf):
    over = spark.createDataFrame([("F / x / NATION_3", "attachment")], "k string, content_type string")
    rules_ = RU.rules(sparse_rules(spark, sf))
    over = rules_.filter(F.col("sub_content_1") == "NATION_3").select("section_path").crossJoin(over.select("content_type"))
    for c, t in (("expected_pages", "array<int>"), ("reuse_method", "string"), ("long_term", "boolean"), ("use_ocr", "boolean"), ("parse_table", "boolean")):
        over = over.withColumn(c, F.lit(None).cast(t))
    p = RU.plan(rules_, over, "F", skip_sections=("NATION_1",))
    return p.select("section_path", F.array_join("process_strategy", ",").alias("strategy"), "content_type", "reuse_method", F.col("enter_long_term_library").alias("long_term"))


@query("""SELECT p_partkey, CASE WHEN contains(p_type, 'PROMO') THEN 'attachment' WHEN contains(p_type, 'SMALL') OR contains(p_type, 'MEDIUM') THEN 'structured_field' ELSE 'template_text' END AS kind,
CASE WHEN contains(p_type, 'PROMO') THEN '附件召回' WHEN contains(p_type, 'SMALL') OR contains(p_type, 'MEDIUM') THEN '结构化字段填充' ELSE '模板参考复用' END AS reuse,
CASE WHEN contains(p_type, 'PROMO') THEN 'attachment_asset' WHEN contains(p_type, 'SMALL') OR contains(p_type, 'MEDIUM') THEN 'structured_reuse' ELSE 'text_reuse' END AS storage FROM part""")
def content_type_cascade(spark, sf):
    kind = RU.content_type(F.col("p_type"), {"attachment": ("PROMO",), "structured_field": ("SMALL", "MEDIUM")})
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind")).select("p_partkey", "kind", RU.reuse_method(F.col("kind")).alias("reuse"), RU.storage_profile(F.col("kind"))["storage_category"].alias("storage"))


@query("SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name IN ('NATION_2', 'NATION_5') OR r_name || ' / ' || n_name IN (SELECT r_name || ' / NATION_7' FROM region)")
def section_target_filter(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.filter(RU.matches_target(F.concat_ws(" / ", "r_name", "n_name"), F.array(F.lit("NATION_2"), F.lit("NATION_5"), F.concat(F.col("r_name"), F.lit(" / NATION_7"))))).select("n_nationkey", "n_name")


@query("WITH p AS (SELECT DISTINCT unnest([n_nationkey, n_nationkey % 7]) AS page_no FROM nation WHERE n_nationkey % 2 = 0) SELECT page_no FROM p WHERE page_no > 0")
def plan_pages(spark, sf):
    items = table(spark, sf, "nation").select((F.col("n_nationkey") % 2 == 0).alias("use_ocr"), F.array("n_nationkey", F.col("n_nationkey") % 7).alias("expected_pages"))
    return RU.plan_pages(items, "use_ocr")


@query("SELECT p_brand AS brand, min(p_partkey) AS ord, row_number() OVER (ORDER BY min(p_partkey)) AS n FROM part GROUP BY p_brand")
def ordered_paths(spark, sf):
    return RU.ordered_distinct(table(spark, sf, "part"), "p_brand", "p_partkey").select(F.col("p_brand").alias("brand"), "ord", F.col("n").cast("long").alias("n"))


# ---- contents and sections


@query(f"WITH {TOC} SELECT doc_id, ord, coalesce(lead(level) OVER (PARTITION BY doc_id ORDER BY ord) <= level, true) AS is_leaf FROM toc")
def toc_leaf(spark, sf):
    return S.toc_leaves(toc(spark, sf)).select("doc_id", "ord", "is_leaf")


@query(f"""WITH {TOC}, f AS (SELECT *, last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER w AS t1, last_value(CASE WHEN level = 2 THEN title END IGNORE NULLS) OVER w AS t2 FROM toc WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING))
SELECT doc_id, ord, CASE level WHEN 1 THEN title WHEN 2 THEN t1 || ' / ' || title ELSE t1 || ' / ' || t2 || ' / ' || title END AS section_path FROM f""")
def toc_paths(spark, sf):
    return S.toc_paths(toc(spark, sf)).select("doc_id", "ord", "section_path")


@query(f"""WITH {TOC}, {LINES}, m AS (SELECT doc_id, max(page_no) AS mp FROM blocks GROUP BY doc_id)
SELECT doc_id, ord, page AS page_start, greatest(page, coalesce(lead(page) OVER (PARTITION BY doc_id ORDER BY ord), coalesce(mp, 1) + 1) - 1)::BIGINT AS page_end, 'section_' || substr(sha1('toc||' || (ord - 1) || '||' || title), 1, 12) AS section_id FROM toc LEFT JOIN m USING (doc_id)""")
def toc_section_ranges(spark, sf):
    return S.sections_from_toc(toc(spark, sf), blocks(spark, sf)).select("doc_id", (F.col("ord") + 1).cast("long").alias("ord"), F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "section_id")


HEADS = f"""{LINES}, med AS (SELECT doc_id, median(font_size) + 1 AS t, max(page_no) AS mp FROM blocks GROUP BY doc_id), heads AS (SELECT b.*, mp, row_number() OVER w - 1 AS ord, lead(b.page_no) OVER w AS np FROM blocks b JOIN med USING (doc_id) WHERE length(trim(text)) <= 50 AND font_size >= t WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, block_no)),
sec AS (SELECT doc_id, ord, trim(text) AS title, page_no AS page_start, CASE WHEN np IS NULL THEN mp WHEN np = page_no THEN page_no ELSE greatest(page_no, np - 1) END AS page_end, 'heuristic' AS source_type FROM heads
  UNION ALL SELECT doc_id, 0, '全文', min(page_no), max(page_no), 'fallback' FROM blocks WHERE doc_id NOT IN (SELECT doc_id FROM heads) GROUP BY doc_id)"""


@query(f"WITH {HEADS} SELECT doc_id, ord::BIGINT AS ord, title, page_start::BIGINT AS page_start, page_end::BIGINT AS page_end, source_type FROM sec")
def heading_sections(spark, sf):
    s = S.sections_from_blocks(blocks(spark, sf))
    return s.select("doc_id", F.col("ord").cast("long").alias("ord"), "title", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "source_type")


@query(f"""WITH {LINES}, l AS (SELECT doc_id, page_no, regexp_replace(text || CASE WHEN block_no % 5 = 0 AND doc_id % 7 = 0 THEN ' 12' ELSE '' END, '\\s+', '', 'g') AS line FROM blocks WHERE page_no <= 20)
SELECT doc_id, page_no::BIGINT AS page_no FROM l GROUP BY ALL HAVING bool_or(line IN ('目录', '目次', '目录页')) OR count(*) FILTER (WHERE regexp_matches(line, '\\.{{2,}}|…{{2,}}|第?\\d+页?$')) >= 3""")
def directory_pages(spark, sf):
    b = blocks(spark, sf)
    marked = b.withColumn("text", F.when((F.col("block_no") % 5 == 0) & (F.col("doc_id") % 7 == 0), F.concat("text", F.lit(" 12"))).otherwise(F.col("text")))
    return S.directory_pages(marked).select("doc_id", F.col("page_no").cast("long").alias("page_no"))


TREE = f"""{TOC}, tr AS (SELECT doc_id, ord, level, title, page AS ps, CASE level WHEN 1 THEN 500 WHEN 2 THEN page + 12 ELSE page + 1 END AS pe FROM toc)"""


def tree(spark, sf) -> DataFrame:
    t = toc(spark, sf)
    end = F.when(F.col("level") == 1, F.lit(500)).when(F.col("level") == 2, F.col("page") + 12).otherwise(F.col("page") + 1)
    return t.select("doc_id", "ord", "level", "title", F.col("page").cast("int").alias("page_start"), end.cast("int").alias("page_end"), F.concat_ws("-", F.lit("s"), F.col("ord").cast("string")).alias("section_id"))


@query(f"""WITH {TREE} SELECT c.doc_id, 's-' || c.ord AS section_id, coalesce(max_by('s-' || p.ord, (p.level, p.ps, -p.ord)), 's-' || c.ord) AS container_id FROM tr c LEFT JOIN tr p ON p.doc_id = c.doc_id AND p.ord <> c.ord AND p.level < c.level AND c.ps BETWEEN p.ps AND p.pe AND c.pe BETWEEN p.ps AND p.pe GROUP BY c.doc_id, c.ord""")
def parent_section(spark, sf):
    return S.parents(tree(spark, sf)).select("doc_id", "section_id", "container_id")


@query(f"""WITH {TREE}, b AS (SELECT r_regionkey::BIGINT AS doc_id, unnest(range(1, 120, 7)) AS page_no FROM region) SELECT b.doc_id, b.page_no::BIGINT AS page_no, max_by('s-' || ord, (ps, level, -ord)) AS section_id FROM b JOIN tr ON tr.doc_id = b.doc_id AND page_no BETWEEN ps AND pe GROUP BY ALL""")
def container_section(spark, sf):
    b = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(119), F.lit(7))).alias("page_no")).withColumn("block_id", F.col("page_no"))
    return S.container(b, tree(spark, sf)).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "section_id")


# ---- streams, headings, scopes


@query(f"""WITH {LINES}, i AS (SELECT doc_id, page_no, y AS top_y, 'text' AS item_type, block_id AS item_id FROM blocks UNION ALL SELECT page_id AS doc_id, 1, 100.0, 'table', 'p' || page_id FROM pages UNION ALL SELECT page_id, 1, 40.0, 'image', 'i' || page_id FROM pages)
SELECT doc_id, item_id, item_type, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, top_y, item_type, item_id)::BIGINT AS reading_order FROM i""")
def reading_order_stream(spark, sf):
    p = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("page_no"))
    def one(prefix, key, y):
        return p.select("doc_id", "page_no", F.concat(F.lit(prefix), F.col("doc_id").cast("string")).alias(key), G.box(F.lit(0), F.lit(y), F.lit(10), F.lit(y + 10)).alias("bbox"))
    s = P.page_stream(blocks(spark, sf), one("p", "table_id", 100), one("i", "image_id", 40))
    return s.select("doc_id", "item_id", "item_type", F.col("reading_order").cast("long").alias("reading_order"))


MARKS = f"""{LINES}, m AS (SELECT doc_id, page_no, y, block_id, text FROM blocks WHERE length(text) % 4 = 0)"""


@query(f"""WITH {MARKS}, j AS (SELECT b.doc_id, b.block_id, m.block_id AS heading_id FROM blocks b ASOF LEFT JOIN m ON m.doc_id = b.doc_id AND (b.page_no * 100000 + b.y) > (m.page_no * 100000 + m.y)) SELECT * FROM j""")
def nearest_heading(spark, sf):
    b = blocks(spark, sf).withColumn("top_y", F.col("bbox")[1])
    heads = b.filter(F.length("text") % 4 == 0).select("doc_id", "page_no", F.col("top_y").alias("y"), F.col("block_no").alias("ord"), F.col("text").alias("title"), "block_id")
    return P.nearest_heading(b.select("doc_id", "page_no", "top_y", "block_id"), heads).select("doc_id", "block_id", "heading_id")


SCOPES = """sc AS (SELECT doc_id, 1 AS start_page, 80.0 AS start_y, 2 AS end_page, CASE WHEN doc_id % 2 = 0 THEN 200.0 END AS end_y, 'a' AS scope_id, 1 AS ord FROM documents UNION ALL SELECT doc_id, 1, NULL, 1, 400.0, 'b', 2 FROM documents UNION ALL SELECT doc_id, 2, 120.0, 9, NULL, 'c', 3 FROM documents)"""
IN_SCOPE = "(page_no, y) >= (start_page, coalesce(start_y, 0.0)) AND CASE WHEN coalesce(end_y, 0) = 0 THEN page_no <= end_page ELSE (page_no, y) < (end_page, end_y) END"


def scopes(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id")
    n = F.lit(None).cast("double")
    def one(a, ay, b, by, name, o):
        return d.select("doc_id", F.lit(a).alias("start_page"), ay.cast("double").alias("start_y"), F.lit(b).alias("end_page"), by.cast("double").alias("end_y"), F.lit(name).alias("scope_id"), F.lit(o).alias("ord"))
    return one(1, F.lit(80.0), 2, F.when(F.col("doc_id") % 2 == 0, 200.0), "a", 1).union(one(1, n, 1, F.lit(400.0), "b", 2)).union(one(2, F.lit(120.0), 9, n, "c", 3))


def items(spark, sf) -> DataFrame:
    return blocks(spark, sf).select("doc_id", F.col("block_id").alias("item_id"), "page_no", F.col("bbox")[1].alias("top_y"), "bbox", "text")


@query(f"WITH {LINES}, {SCOPES} SELECT doc_id, block_id AS item_id, scope_id FROM blocks JOIN sc USING (doc_id) WHERE {IN_SCOPE}")
def blocks_in_scope(spark, sf):
    return P.items_in_scopes(items(spark, sf), scopes(spark, sf)).select("doc_id", "item_id", "scope_id")


@query(f"WITH {LINES}, {SCOPES} SELECT doc_id, block_id AS item_id, min_by(scope_id, ord) AS scope_id FROM blocks JOIN sc USING (doc_id) WHERE {IN_SCOPE} GROUP BY ALL")
def first_scope(spark, sf):
    return P.first_scope(items(spark, sf), scopes(spark, sf))


@query(f"WITH {LINES}, {SCOPES} SELECT doc_id, block_id AS item_id FROM blocks WHERE NOT EXISTS (SELECT 1 FROM sc WHERE sc.doc_id = blocks.doc_id AND {IN_SCOPE} AND scope_id <> 'b')")
def blocks_outside_children(spark, sf):
    kids = scopes(spark, sf).filter("scope_id <> 'b'").withColumn("parent_id", F.lit(0))
    return P.outside_children(items(spark, sf).withColumn("parent_id", F.lit(0)), kids).select("doc_id", "item_id")


@query(f"""WITH {LINES}, {SCOPES} SELECT doc_id, block_id AS item_id, scope_id FROM blocks JOIN sc USING (doc_id) WHERE page_no BETWEEN start_page AND end_page AND (page_no > start_page OR y1 > coalesce(start_y, 0)) AND (page_no < end_page OR coalesce(end_y, 0) = 0 OR y < end_y)""")
def tables_in_scope(spark, sf):
    return P.tables_in_scopes(items(spark, sf), scopes(spark, sf)).select("doc_id", "item_id", "scope_id")


@query(f"""WITH {LINES}, {SCOPES}, i AS (SELECT doc_id, scope_id, block_id, page_no, y, substr(text, 1, 1) AS context_title FROM blocks JOIN sc USING (doc_id) WHERE {IN_SCOPE})
SELECT doc_id, block_id AS item_id, scope_id, row_number() OVER (PARTITION BY doc_id, scope_id, context_title ORDER BY page_no, y, block_id)::BIGINT AS n FROM i""")
def title_running_index(spark, sf):
    i = P.items_in_scopes(items(spark, sf), scopes(spark, sf)).withColumn("context_title", F.substring("text", 1, 1))
    return P.running_titles(i).select("doc_id", "item_id", "scope_id", F.col("n").cast("long").alias("n"))


@query("""WITH c AS (SELECT o_custkey % 20 AS doc_id, o_orderpriority AS section_path, o_orderkey % 30 AS page_start, o_orderkey % 30 + o_custkey % 5 AS page_end, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 11) * 10.0 END AS start_y, CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 13) * 10.0 END AS end_y FROM orders),
w AS (SELECT *, min(page_start) OVER (PARTITION BY doc_id, section_path) AS p0, max(page_end) OVER (PARTITION BY doc_id, section_path) AS p1 FROM c)
SELECT doc_id, section_path, min(p0) AS start_page, min(start_y) FILTER (WHERE page_start = p0) AS start_y, max(p1) AS end_page, max(end_y) FILTER (WHERE page_end = p1) AS end_y FROM w GROUP BY doc_id, section_path""")
def precise_scopes(spark, sf):
    k = F.col("o_orderkey")
    c = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("doc_id"), F.col("o_orderpriority").alias("section_path"), (k % 30).alias("page_start"), (k % 30 + F.col("o_custkey") % 5).alias("page_end"), F.when(k % 3 > 0, (k % 11) * 10.0).alias("start_y"), F.when(k % 4 > 0, (k % 13) * 10.0).alias("end_y"))
    return P.precise_scopes(c)


# ---- matching

MATCH = """r AS (SELECT n_nationkey AS rid, lower(n_name) AS nk FROM nation), s AS (SELECT DISTINCT c_mktsegment AS title FROM customer UNION SELECT n_name || ' extra' FROM nation UNION SELECT n_name FROM nation),
k AS (SELECT title, lower(regexp_replace(regexp_replace(title, '[^\\w]+', '', 'g'), '\\s+', '', 'g')) AS tk FROM s), rk AS (SELECT rid, lower(regexp_replace(nk, '[^\\w]+', '', 'g')) AS rk FROM r),
m AS (SELECT rid, title, rk, tk, len(list_intersect(list_distinct(string_split(rk, '')), list_distinct(string_split(tk, '')))) AS sh, len(list_distinct(string_split(rk, ''))) AS own FROM rk, k),
sc AS (SELECT rid, title, CASE WHEN rk = tk THEN 1.0 WHEN rk <> '' AND (contains(tk, rk) OR contains(rk, tk)) THEN 0.92 WHEN own > 0 AND sh >= greatest(2, own // 2) THEN least(0.8, sh / own) ELSE 0 END AS score FROM m)"""


def match_candidates(spark, sf):
    n = table(spark, sf, "nation")
    rules_ = n.select(F.col("n_nationkey").alias("rule_id"), F.col("n_name").alias("section_path"), F.lit("").alias("sub_content_1"), F.lit("").alias("sub_content_2"), F.lit("").alias("sub_content_3"), F.col("n_name").alias("module_name"), F.lit("").alias("file_type"))
    titles = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("title")).union(n.select(F.concat("n_name", F.lit(" extra")))).union(n.select("n_name")).distinct()
    secs = titles.select("title", T.normalize_title(F.col("title")).alias("normalized_title"))
    return MA.section_matches(MA.rule_titles(rules_), secs, fuzzy=False)


@query(f"WITH {MATCH} SELECT rid AS rule_id, title, round(score, 4)::DOUBLE AS score FROM sc WHERE score >= 0.6")
def rule_section_match(spark, sf):
    return match_candidates(spark, sf).select("rule_id", "title", F.round("score", 4).alias("score"))


CANDS = """c AS (SELECT o_custkey % 40 AS doc_id, o_custkey % 7 AS rule_id, CASE WHEN o_orderkey % 2 = 0 THEN 'section' ELSE 'text_block' END AS source_type, o_orderpriority AS title, o_orderkey % 90 AS page_no, o_orderkey % 90 + o_custkey % 3 AS page_end, round(0.6 + (o_orderkey % 9) * 0.05, 4) AS confidence, o_orderkey % 3 AS title_rank, o_orderkey AS ord FROM orders),
w AS (SELECT *, max(confidence) OVER (PARTITION BY doc_id, rule_id) AS best FROM c), w2 AS (SELECT *, bool_or(page_no >= 50 AND confidence >= best - 0.05) OVER p AS late, bool_or(page_no > 20) OVER p AS anyb FROM w WINDOW p AS (PARTITION BY doc_id, rule_id)),
b AS (SELECT * FROM w2 WHERE NOT late OR NOT anyb OR page_no > 20), pr AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY doc_id, rule_id ORDER BY confidence DESC, (source_type = 'section') DESC, title_rank, page_no DESC, page_end DESC, ord) = 1)"""


def order_candidates(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        (c % 40).alias("doc_id"), (c % 7).alias("rule_id"), F.when(k % 2 == 0, "section").otherwise("text_block").alias("source_type"), F.col("o_orderpriority").alias("title"), (k % 90).alias("page_no"), (k % 90 + c % 3).alias("page_end"),
        F.round(0.6 + (k % 9) * 0.05, 4).alias("confidence"), (k % 3).alias("title_rank"), k.alias("ord"),
    )


@query(f"WITH {CANDS} SELECT doc_id, rule_id, ord, confidence::DOUBLE AS confidence FROM pr")
def primary_match(spark, sf):
    return MA.primary(order_candidates(spark, sf)).select("doc_id", "rule_id", "ord", "confidence")


@query(f"""WITH {CANDS}, once AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY doc_id, rule_id, source_type, title, page_no, page_end ORDER BY page_no, page_end, title, confidence DESC, ord) = 1)
SELECT doc_id, rule_id, ord FROM once WHERE confidence >= 0.75 AND ord NOT IN (SELECT ord FROM pr)""")
def related_matches(spark, sf):
    return MA.related(order_candidates(spark, sf)).select("doc_id", "rule_id", "ord")


@query(f"""WITH {CANDS}, once AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY doc_id, rule_id, source_type, title, page_no, page_end ORDER BY page_no, page_end, title, confidence DESC, ord) = 1),
u AS (SELECT doc_id, rule_id, title, page_no, page_end, source_type, ord, 0 AS n FROM pr UNION ALL SELECT doc_id, rule_id, title, page_no, page_end, source_type, ord, 1 FROM once WHERE confidence >= 0.75 AND ord NOT IN (SELECT ord FROM pr))
SELECT doc_id, rule_id, title, page_no, source_type, min_by(page_end, (n, page_end)) AS page_end FROM u GROUP BY ALL""")
def discovered_items(spark, sf):
    c = order_candidates(spark, sf).withColumn("container_title", F.lit("x"))
    return C.discovered(MA.primary(c), MA.related(c)).select("doc_id", "rule_id", "title", "page_no", "source_type", "page_end")


def line_parts(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("rule_id"), F.col("text").alias("section_path"), F.lit("").alias("sub_content_2"), F.lit("").alias("sub_content_3"), F.col("text").alias("sub_content_1"), F.lit("").alias("module_name"), F.lit("").alias("file_type"))
    return MA.line_rules(MA.rule_titles(b)), MA.block_lines(blocks(spark, sf))


@query()
def block_line_match(spark, sf):
    return MA.line_matches(*line_parts(spark, sf)).select("rule_id", "doc_id", "block_id", "score", "reason")


# ---- candidates and fields


@query("""WITH e AS (SELECT user_id % 100 AS doc_id, event_id % 20 + 1 AS page_no, event_type, event_id FROM events), s AS (SELECT doc_id, id, 1 + id * 3 AS p0, 4 + id * 4 AS p1 FROM (SELECT unnest(range(100)) AS doc_id), (SELECT unnest(range(4)) AS id)),
j AS (SELECT s.doc_id, s.id, count(*) FILTER (WHERE event_type = 'click') AS t, count(*) FILTER (WHERE event_type = 'view') AS b, count(*) FILTER (WHERE event_type = 'purchase' AND event_id % 4 >= 1 AND event_id % 3 >= 1) AS i FROM s LEFT JOIN e ON e.doc_id = s.doc_id AND page_no BETWEEN p0 AND p1 GROUP BY ALL)
SELECT doc_id::BIGINT AS doc_id, id::BIGINT AS id, t AS text_blocks, b AS tables, i AS images, CASE WHEN (t > 0)::INT + (b > 0)::INT + (i > 0)::INT = 0 THEN 'unknown' WHEN (t > 0)::INT + (b > 0)::INT + (i > 0)::INT > 1 THEN 'mixed' WHEN t > 0 THEN 'text' WHEN b > 0 THEN 'table' ELSE 'image' END AS dominant FROM j""")
def page_profile(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 100).alias("doc_id"), (F.col("event_id") % 20 + 1).cast("int").alias("page_no"), "event_type", F.lit("x").alias("text"), (150 + F.col("event_id") % 4 * 50).alias("width"), (100 + F.col("event_id") % 3 * 20).alias("height"))
    s = spark.range(100).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("id")).withColumn("page_start", 1 + F.col("id") * 3).withColumn("page_end", 4 + F.col("id") * 4)
    got = C.profile(s, e.filter("event_type = 'click'"), e.filter("event_type = 'view'"), e.filter("event_type = 'purchase'"))
    return got.select("doc_id", F.col("id").cast("long").alias("id"), "text_blocks", "tables", "images", "dominant")


@query("SELECT o_custkey AS doc_id, o_orderpriority AS name, max_by(o_orderstatus || ' | ' || o_orderkey, o_orderkey) AS value FROM orders GROUP BY ALL")
def kv_fields(spark, sf):
    t = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), F.array(F.array("o_orderpriority", "o_orderstatus", F.col("o_orderkey").cast("string"))).alias("rows"))
    return C.table_fields(t, ["doc_id"])


@query("SELECT user_id AS doc_id, event_type AS name, max_by(value::VARCHAR, event_id) AS value FROM (SELECT user_id, event_type, event_id, event_id % 97 AS value FROM events) GROUP BY ALL")
def line_fields(spark, sf):
    b = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("ord"), F.concat("event_type", F.when(F.col("event_id") % 2 == 0, "：").otherwise(": "), (F.col("event_id") % 97).cast("string"), F.lit("\nno field")).alias("text"))
    return C.line_fields(b, ["doc_id"])


# ---- decoration, masks, boxes


@query(f"""WITH {LINES}, s AS (SELECT doc_id % 100 AS doc_id, page_no, regexp_replace(text, '\\s+', '', 'g') AS signature FROM blocks WHERE y <= 70 OR y1 >= 760) SELECT doc_id, signature, count(DISTINCT doc_id * 1000 + page_no) AS n_pages FROM (SELECT * FROM s WHERE signature <> '') GROUP BY ALL HAVING n_pages >= 2""")
def decorative_text(spark, sf):
    b = blocks(spark, sf).withColumn("doc_id", F.col("doc_id") % 100)
    return M.decorative_signatures(b).select("doc_id", "signature", "n_pages")


@query("""WITH i AS (SELECT l_orderkey % 40 AS doc_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS image_id, l_partkey % 9 AS xref, (l_suppkey % 4) * 30.0 AS x0, (l_linenumber * 15)::DOUBLE AS y0, 100 + l_linenumber AS width FROM lineitem),
x AS (SELECT *, count(*) OVER (PARTITION BY doc_id, xref, x0, y0, width) AS n1, count(*) OVER (PARTITION BY doc_id, x0, y0, width) AS n2, (y0 <= 80) AS margin FROM i) SELECT doc_id, image_id FROM x WHERE (n1 >= 10 AND x0 <= 120 AND y0 <= 80) OR (margin AND n2 >= 2)""")
def decorative_images(spark, sf):
    x0, y0 = (F.col("l_suppkey") % 4) * 30.0, (F.col("l_linenumber") * 15).cast("double")
    i = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 40).alias("doc_id"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("image_id"), (F.col("l_partkey") % 9).alias("xref"), G.box(x0, y0, x0 + 50, y0 + 30).alias("bbox"), (100 + F.col("l_linenumber")).alias("width"), F.lit(80).alias("height"), F.lit(800.0).alias("page_height"))
    return M.decorative_images(i)


@query(f"""WITH {BOXES}, u AS (SELECT doc_id, page_no, kind, round(x0, 2) AS x0, round(y0, 2) AS y0, round(x1, 2) AS x1, round(y1, 2) AS y1 FROM boxes) SELECT DISTINCT doc_id, page_no::BIGINT AS page_no, kind, x0, y0, x1, y1 FROM u""")
def mask_dedup(spark, sf):
    b = boxes(spark, sf).withColumn("key", F.transform("bbox", lambda v: F.round(v, 2)))
    once = rank.first_by(b, ["doc_id", "page_no", "kind", "key"], [F.asc("region_id")])
    return once.select("doc_id", F.col("page_no").cast("long").alias("page_no"), "kind", *[F.col("key")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query(f"""WITH {BOXES}, m AS (SELECT DISTINCT doc_id, page_no, x0 * 2 AS x0, y0 * 2 AS y0, x1 * 2 AS x1, y1 * 2 AS y1 FROM boxes WHERE kind = 'R') SELECT doc_id, region_id AS item_id FROM boxes b WHERE kind <> 'R' AND NOT EXISTS (SELECT 1 FROM m WHERE m.doc_id = b.doc_id AND m.page_no = b.page_no AND (b.x0 + b.x1) / 2 BETWEEN m.x0 AND m.x1 AND (b.y0 + b.y1) / 2 BETWEEN m.y0 AND m.y1)""")
def mask_filter(spark, sf):
    b = boxes(spark, sf)
    m = b.filter("kind = 'R'").select("doc_id", "page_no", "bbox", F.lit(100).alias("page_width"), F.lit(100).alias("page_height")).distinct()
    sizes = b.select("doc_id", "page_no").distinct().withColumn("w", F.lit(200)).withColumn("h", F.lit(200))
    return M.unmasked(b.filter("kind <> 'R'").withColumnRenamed("region_id", "item_id"), m, sizes).select("doc_id", "item_id")


@query(f"""WITH {BOXES}, a AS (SELECT a.doc_id, a.region_id AS a_id, b.region_id AS b_id, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS shared, (a.x1 - a.x0) * (a.y1 - a.y0) AS aa, (b.x1 - b.x0) * (b.y1 - b.y0) AS ab FROM boxes a JOIN boxes b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.region_id < b.region_id)
SELECT doc_id, a_id, b_id, round(shared / least(aa, ab), 6) AS by_smaller, round(shared / aa, 6) AS by_own FROM a WHERE shared > 0 AND shared / least(aa, ab) >= 0.65""")
def region_overlap_pairs(spark, sf):
    return PL.overlaps(boxes(spark, sf), 0.65, 6)


def regions(spark, sf) -> DataFrame:
    return boxes(spark, sf).select("doc_id", "region_id", "page_no", "bbox", F.array(F.when(F.col("kind") == "R", "pdfplumber").otherwise("pp_structure")).alias("detectors"), F.lit(0.6).alias("confidence"), F.array("region_id").alias("source_table_ids"))


@query()
def region_merge(spark, sf):
    return TB.merge_regions(regions(spark, sf)).select("doc_id", "region_id", "page_no", "bbox", "confidence")


@query()
def region_groups(spark, sf):
    return TB.group_regions(TB.merge_regions(regions(spark, sf)))


# ---- tables


@query(f"""WITH {RAGGED}, w AS (SELECT table_id, rows, list_max(list_transform(rows, lambda r: len(r))) AS width FROM ragged), r AS (SELECT table_id, width, unnest(rows) AS r, generate_subscripts(rows, 1) - 1 AS row FROM w), c AS (SELECT table_id, row, unnest(range(width)) AS col, r FROM r)
SELECT table_id, row::BIGINT AS row, col::BIGINT AS col, coalesce(r[col + 1], '') AS text FROM c""")
def table_pad_cells(spark, sf):
    return TB.cells(ragged(spark, sf)).select("table_id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "text")


@query(f"""WITH {RAGGED}, m AS (SELECT table_id, len(rows) AS n, list_max(list_transform(rows, lambda r: len(r))) AS width, flatten(rows) AS cells FROM ragged), q AS (SELECT table_id, n, width, len(list_filter(cells, lambda c: trim(c) <> '')) AS filled, len(cells) AS nc, len(list_filter(cells, lambda c: length(trim(c)) = 1)) AS single FROM m)
SELECT table_id, (n * 3 + width * 4 + filled - CASE WHEN width <= 1 THEN 80 ELSE 0 END - CASE WHEN n <= 1 THEN 40 ELSE 0 END - CASE WHEN width >= 6 AND ((nc - filled) >= 0.55 * nc OR (filled > 0 AND single >= 0.65 * filled)) THEN 55 ELSE 0 END)::BIGINT AS score FROM q""")
def table_quality(spark, sf):
    return ragged(spark, sf).select("table_id", TB.quality(F.col("rows")).cast("long").alias("score"))


@query(f"""WITH {RAGGED} SELECT table_id, array_to_string(list_filter(list_transform(rows, lambda r: array_to_string(list_filter(r, lambda c: c <> ''), ' | ')), lambda x: x <> ''), chr(10)) AS flat FROM ragged""")
def table_flatten(spark, sf):
    return ragged(spark, sf).select("table_id", TB.flattened(F.col("rows")).alias("flat"))


# ---- review index, folders, paths


@query("""WITH s AS (SELECT n_regionkey::BIGINT AS doc_id, n_nationkey AS ord, CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE '' END AS project_label, CASE WHEN n_nationkey % 2 = 0 THEN 'e' || n_nationkey ELSE '' END AS element_label FROM nation)
SELECT doc_id, ord, last_value(nullif(project_label, '') IGNORE NULLS) OVER w AS project_label, last_value(nullif(element_label, '') IGNORE NULLS) OVER w AS element_label FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)""")
def carry_down(spark, sf):
    k = F.col("n_nationkey")
    s = table(spark, sf, "nation").select(F.col("n_regionkey").cast("long").alias("doc_id"), k.alias("ord"), F.when(k % 3 == 0, F.col("n_name")).otherwise("").alias("project_label"), F.when(k % 2 == 0, F.concat(F.lit("e"), k.cast("string"))).otherwise("").alias("element_label"))
    return V.carry_down(s, "project_label", "element_label", "ord", ["doc_id"])


@query(f"WITH {TOC} SELECT doc_id, ord, page AS page_start, coalesce(greatest(page, lead(page) OVER (PARTITION BY doc_id ORDER BY page, ord) - 1), page)::BIGINT AS page_end FROM toc WHERE level = 2")
def folder_ranges(spark, sf):
    e = toc(spark, sf).filter("level = 2").withColumnRenamed("page", "page_start")
    return V.folder_ranges(e).select("doc_id", "ord", "page_start", F.col("page_end").cast("long").alias("page_end"))


@query(f"""WITH {TOC}, p AS (SELECT doc_id, title, ord * 2 - 1 AS a, ord * 2 + level * 9 AS z FROM toc WHERE level < 3), b AS (SELECT DISTINCT r_regionkey::BIGINT AS doc_id, unnest(range(1, 90, 3)) AS page_no FROM region) SELECT b.doc_id, page_no::BIGINT AS page_no, arg_min(title, (z - a, a, title)) AS container_title FROM b JOIN p ON p.doc_id = b.doc_id AND page_no BETWEEN a AND z GROUP BY ALL""")
def page_container(spark, sf):
    c = toc(spark, sf).filter("level < 3").select("doc_id", "title", (F.col("ord") * 2 - 1).cast("int").alias("page_start"), (F.col("ord") * 2 + F.col("level") * 9).cast("int").alias("page_end"))
    pages = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(89), F.lit(3))).alias("page_no"))
    return P.page_container(pages, c).select("doc_id", F.col("page_no").cast("long").alias("page_no"), "container_title")


PATHS = "paths AS (SELECT DISTINCT 1::BIGINT AS doc_id, r_name || ' / ' || n_name || ' / ' || c_mktsegment AS section_path, r_name, n_name, c_mktsegment FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey)"


def paths(spark, sf) -> DataFrame:
    j = table(spark, sf, "region").join(table(spark, sf, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).join(table(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.lit(1).cast("long").alias("doc_id"), F.concat_ws(" / ", "r_name", "n_name", "c_mktsegment").alias("section_path")).distinct()


@query(f"WITH {PATHS}, l AS (SELECT DISTINCT '' AS parent, r_name AS child FROM paths UNION SELECT DISTINCT r_name, n_name FROM paths UNION SELECT DISTINCT r_name || ' / ' || n_name, c_mktsegment FROM paths) SELECT 1::BIGINT AS doc_id, parent, string_agg(child, '|' ORDER BY child) AS children FROM l GROUP BY parent")
def index_links(spark, sf):
    return P.index_links(paths(spark, sf)).select("doc_id", "parent", F.array_join("children", "|").alias("children"))


@query(f"""WITH {PATHS}, c AS (SELECT section_path, n_name AS instance, c_mktsegment AS child, length(n_name) AS a, length(section_path) AS z FROM paths WHERE r_name = (SELECT min(r_name) FROM region)), k AS (SELECT instance, child, min(a) AS page_start, max(z) AS page_end FROM c GROUP BY ALL)
SELECT instance, child, page_start::BIGINT AS page_start, page_end::BIGINT AS page_end, (count(child) OVER (PARTITION BY instance))::BIGINT AS child_count FROM k""")
def compound_instances(spark, sf):
    c = paths(spark, sf).withColumn("page_start", F.length(T.path_parts(F.col("section_path"))[1])).withColumn("page_end", F.length("section_path"))
    got = P.compound_instances(c, table(spark, sf, "region").agg(F.min("r_name").alias("anchor")))
    return got.select("instance", "child", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), F.col("child_count").cast("long").alias("child_count"))


@query("""WITH p AS (SELECT DISTINCT 1::BIGINT AS doc_id, p_brand || ' / ' || CASE WHEN p_size % 2 = 0 THEN replace(p_type, ' ', ':') ELSE replace(p_type, ' ', '?') END AS section_path, p_brand AS parent, regexp_replace(p_type, ' ', '_', 'g') AS base FROM part)
SELECT doc_id, section_path, CASE WHEN row_number() OVER (PARTITION BY parent, base ORDER BY section_path) = 1 THEN base ELSE base || '_' || substr(sha1(section_path), 1, 8) END AS dirname FROM p""")
def section_dirnames(spark, sf):
    leaf = F.when(F.col("p_size") % 2 == 0, F.replace("p_type", F.lit(" "), F.lit(":"))).otherwise(F.replace("p_type", F.lit(" "), F.lit("?")))
    p = table(spark, sf, "part").select(F.lit(1).cast("long").alias("doc_id"), F.concat_ws(" / ", "p_brand", leaf).alias("section_path"))
    return P.dirnames(p).select("doc_id", "section_path", "dirname")


@query(f"WITH {PATHS} SELECT doc_id, section_path FROM paths WHERE c_mktsegment <> (SELECT min(c_mktsegment) FROM customer)")
def covered_paths(spark, sf):
    p = paths(spark, sf)
    least = table(spark, sf, "customer").agg(F.min("c_mktsegment").alias("least"))
    covered = p.crossJoin(F.broadcast(least)).filter(T.path_leaf(F.col("section_path")) == F.col("least"))
    return P.covered_paths(p, p, covered)


# ---- context lookup

LOOK = """m AS (SELECT 'r' || n_regionkey AS run_name, r_name || ' / ' || n_name AS section_path, n_name AS title, lower(regexp_replace(r_name || n_name, '[\\s_-]+', '', 'g')) AS pk, lower(regexp_replace(n_name, '[\\s_-]+', '', 'g')) AS tk FROM nation JOIN region ON n_regionkey = r_regionkey),
q AS (SELECT n_nationkey AS request_id, CASE n_nationkey % 3 WHEN 0 THEN r_name || ' / ' || n_name WHEN 1 THEN lower(r_name) || '/' || n_name ELSE '' END AS path, CASE WHEN n_nationkey % 3 = 2 THEN lower(n_name) ELSE '' END AS asked FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query(f"""WITH {LOOK} SELECT request_id, run_name, m.section_path, CASE request_id % 3 WHEN 0 THEN 'exact_path' WHEN 1 THEN 'normalized_path' ELSE 'title' END AS match_type, CASE request_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.98 ELSE 0.95 END::DOUBLE AS score FROM q JOIN m ON CASE request_id % 3 WHEN 0 THEN m.section_path = path WHEN 1 THEN m.pk = lower(regexp_replace(replace(path, '/', ''), '[\\s_-]+', '', 'g')) ELSE m.tk = lower(regexp_replace(asked, '[\\s_-]+', '', 'g')) END""")
def context_lookup(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path, k = F.concat_ws(" / ", "r_name", "n_name"), F.col("n_nationkey") % 3
    m = X.index(n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("run_name"), path.alias("material_path"), path.alias("section_path"), F.col("n_name").alias("title")))
    q = n.select(F.col("n_nationkey").alias("request_id"), F.when(k == 0, path).when(k == 1, F.concat_ws("/", F.lower("r_name"), "n_name")).otherwise("").alias("section_path"), F.when(k == 2, F.lower("n_name")).otherwise("").alias("title"))
    return X.lookup(m, q).select("request_id", "run_name", "section_path", "match_type", "score")


@query("WITH p AS (SELECT c_custkey % 10 AS doc_id, c_mktsegment AS scope_id, c_custkey FROM customer) SELECT doc_id, scope_id, count(*) FILTER (WHERE c_custkey % 3 = 0) AS texts, count(*) FILTER (WHERE c_custkey % 3 = 1) AS tables, count(*) FILTER (WHERE c_custkey % 3 = 2) AS images FROM p GROUP BY ALL")
def package_counts(spark, sf):
    k = F.col("c_custkey") % 3
    i = table(spark, sf, "customer").select((F.col("c_custkey") % 10).alias("doc_id"), F.col("c_mktsegment").alias("scope_id"), F.when(k == 0, "text").when(k == 1, "table").otherwise("image").alias("item_type"))
    return P.counts(i)


@query()
def material_items(spark, sf):
    b = blocks(spark, sf)
    y = F.lit(300)
    p = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.concat(F.lit("t"), F.col("page_id").cast("string")).alias("table_id"), F.lit(1).alias("page_no"), G.box(F.lit(60), y, F.lit(400), y + 90).alias("bbox"), F.array(F.array(F.substring("url", 1, 30))).alias("rows"))
    i = p.select("doc_id", F.concat(F.lit("i"), F.col("doc_id").cast("string")).alias("image_id"), "page_no", G.box(F.lit(60), F.lit(500), F.lit(400), F.lit(640)).alias("bbox"))
    return P.material_items(scopes(spark, sf), b, p, i).select("doc_id", "scope_id", "item_id", "role", "n")
