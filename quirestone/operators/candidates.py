"""Candidates: what lies on the pages of a match, and what it says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ids import stable_id
from ..plans.rank import first_by
from . import masks as M
from . import rules as R


def span_pages(spans: DataFrame) -> DataFrame:
    """``spans(doc_id, id, page_start, page_end)`` with a row for each page, so that pages are an equi-join key."""
    end = F.greatest("page_start", F.coalesce("page_end", "page_start"))
    return spans.filter(F.col("page_start") > 0).select("doc_id", "id", F.explode(F.sequence("page_start", end)).alias("page_no"))


def profile(spans: DataFrame, blocks: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """Counts of non-blank blocks, tables and meaningful images in each span, their types and the dominant one.

    Pages are counted first, so a span joins three small tables of counts."""
    def per_page(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("doc_id", "page_no").agg(F.count(F.lit(1)).alias(name))

    counts = (
        span_pages(spans).join(per_page(blocks.filter(F.trim(F.coalesce("text", F.lit(""))) != ""), "t"), ["doc_id", "page_no"], "left")
        .join(per_page(tables, "b"), ["doc_id", "page_no"], "left").join(per_page(images.filter(M.is_meaningful_image(F.col("width"), F.col("height"))), "i"), ["doc_id", "page_no"], "left")
        .groupBy("doc_id", "id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("t", "text_blocks"), ("b", "tables"), ("i", "images"))])
    )
    out = spans.select("doc_id", "id").join(counts, ["doc_id", "id"], "left").na.fill(0, ["text_blocks", "tables", "images"])
    kinds = material_types(F.col("text_blocks"), F.col("tables"), F.col("images"))
    return out.withColumn("material_types", kinds).withColumn("dominant", dominant(F.col("material_types")))


def material_types(text: Column, tables: Column, images: Column) -> Column:
    return F.array_compact(F.array(F.when(text > 0, "text"), F.when(tables > 0, "table"), F.when(images > 0, "image")))


def dominant(kinds: Column) -> Column:
    return F.when(F.size(kinds) == 0, "unknown").when(F.size(kinds) > 1, "mixed").otherwise(kinds[0])


def match_span(best: DataFrame, rel: DataFrame) -> DataFrame:
    """First to last page over a match and the related ones of its container."""
    keys = ["doc_id", "rule_id"]
    near = rel.alias("r").join(best.select(*keys, F.col("container_title").alias("own")), keys).filter(F.col("container_title").eqNullSafe(F.col("own"))).select(*keys, "page_no", "page_end")
    both = best.select(*keys, "page_no", "page_end").unionByName(near)
    return both.groupBy(*keys).agg(F.min("page_no").alias("page_start"), F.max(F.coalesce("page_end", "page_no")).alias("page_end"))


def table_fields(tables: DataFrame, keys: list[str]) -> DataFrame:
    """First cells as names, the rest as values; the last row of a name wins. ``tables(*keys, ord, rows)``."""
    rows = tables.select(*keys, "ord", F.posexplode("rows").alias("n", "r")).filter((F.size("r") >= 2) & (F.coalesce(F.col("r")[0], F.lit("")) != ""))
    rest = F.array_join(F.filter(F.slice("r", 2, 10_000), lambda c: F.coalesce(c, F.lit("")) != ""), " | ")
    return rows.select(*keys, F.col("r")[0].alias("name"), rest.alias("value"), F.struct("ord", "n").alias("at")).groupBy(*keys, "name").agg(F.max_by("value", "at").alias("value"))


def line_fields(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """``name：value`` lines (the full-width colon first); the last one of a name wins. ``blocks(*keys, ord, text)``."""
    lines = blocks.select(*keys, "ord", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\R")).alias("n", "line"))
    at = F.locate("：", F.col("line"))
    place = F.when(at > 0, at).otherwise(F.locate(":", F.col("line")))
    cut = lines.withColumn("p", place).filter("p > 0").select(*keys, T.strip(F.expr("substring(line, 1, p - 1)")).alias("name"), T.strip(F.expr("substring(line, p + 1)")).alias("value"), F.struct("ord", "n").alias("at"))
    return cut.filter("name <> '' and value <> ''").groupBy(*keys, "name").agg(F.max_by("value", "at").alias("value"))


def fields(tables: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Fields of tables; where they give none, of lines."""
    a, b = table_fields(tables, keys), line_fields(blocks, keys)
    return a.unionByName(b.join(a.select(*keys).distinct(), keys, "left_anti"))


def as_map(fields_: DataFrame, keys: list[str]) -> DataFrame:
    return fields_.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("fields"))


def content(blocks: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """Texts of ``blocks(*keys, page_no, block_no, text)`` in order, joined with line breaks; ``most``: the first ones."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "block_no", "text"))), lambda s: s["text"])
    return blocks.filter(F.trim("text") != "").groupBy(*keys).agg(F.array_join(F.slice(texts, 1, most) if most else texts, "\n").alias("content"))


def discovered(best: DataFrame, rel: DataFrame) -> DataFrame:
    """The match and its company as items, each (title, page, source) once, in order of page and title."""
    keys = ["doc_id", "rule_id"]
    cols = [*keys, "title", "page_no", "page_end", "source_type", "confidence"]
    near = rel.join(best.select(*keys, F.col("container_title").alias("own")), keys).filter(F.col("container_title").eqNullSafe(F.col("own")))
    both = best.select(*cols, F.lit(0).alias("n")).unionByName(near.select(*cols, F.lit(1).alias("n"))).filter(F.coalesce("title", F.lit("")) != "")
    once = first_by(both, [*keys, "title", "page_no", "source_type"], [F.asc("n"), F.asc("page_end")])
    return once.withColumn("page_end", F.coalesce("page_end", "page_no")).drop("n")


def extract(matches: DataFrame, rel: DataFrame, plan: DataFrame, rules: DataFrame, blocks: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """Matched history rules with a plan as candidates, routed and profiled, with their content."""
    keys = ["doc_id", "id"]
    best = matches.filter("matched").join(rules.filter("from_history_bid").select("rule_id", *R.FLAG_STRATEGIES, "module_name"), "rule_id")
    planned = plan.select("rule_id", F.col("process_strategy").alias("plan_strategy"), F.col("content_type").alias("plan_type"), F.col("reuse_method").alias("plan_reuse"), F.col("enter_long_term_library").alias("long_term"))
    routed = R.route(best.join(planned, "rule_id"))
    spans = match_span(best, rel).withColumnRenamed("rule_id", "id")
    prof = profile(spans, blocks, tables, images)
    pages = span_pages(spans)
    span_blocks = blocks.join(pages, ["doc_id", "page_no"]).withColumn("ord", F.col("page_no") * 1_000_000 + F.col("block_no"))
    found = as_map(fields(tables.join(pages, ["doc_id", "page_no"]).withColumn("ord", F.col("page_no")), span_blocks, keys), keys)
    short, whole = content(span_blocks, keys, 8).withColumnRenamed("content", "short"), content(span_blocks, keys)
    flat = tables.join(pages, ["doc_id", "page_no"]).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("rows_text")), "\n").alias("table_text")) if "rows_text" in tables.columns else None
    out = routed.withColumnRenamed("rule_id", "id").join(spans.withColumnRenamed("page_end", "span_end"), keys).join(prof, keys).join(found, keys, "left").join(short, keys, "left").join(whole, keys, "left")
    text = F.when((F.col("candidate_type") == "structured_field") & F.col("fields").isNotNull(), F.to_json("fields")).when(F.col("candidate_type") == "attachment", F.coalesce("short", F.lit(""))).otherwise(F.coalesce("content", F.lit("")))
    if flat is not None:
        out = out.join(flat, keys, "left")
        text = F.when((F.col("candidate_type") == "structured_field") & F.col("fields").isNull() & F.col("table_text").isNotNull(), F.col("table_text")).otherwise(text)
    out = out.withColumn("content", text).withColumn("enter_long_term_library", F.col("long_term") & (F.col("candidate_type") != "project_specific_material"))
    return out.withColumn("candidate_id", stable_id("candidate", F.col("doc_id"), F.col("id"), F.col("section_path")))


def report_rows(cands: DataFrame) -> DataFrame:
    """Candidates for a CSV report: nested values as JSON, a preview of 120 characters."""
    plain = [F.to_json(F.col(c)).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in cands.dtypes if c not in ("content", "short")]
    return cands.select(*plain, T.preview(F.col("content"), 120).alias("preview"))
