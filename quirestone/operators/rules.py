"""Rule tables and processing plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ids import stable_id
from ..plans.rank import forward_fill, top

# Header aliases by column, in order of preference.
COLUMN_ALIASES = {
    "file_type": ["文件类型", "文件类别", "文件名称"],
    "module_name": ["组成模块", "模块", "章节", "一级目录"],
    "sub_content_1": ["子内容1", "子内容", "子内容一", "二级目录"],
    "sub_content_2": ["子内容2", "子内容二", "三级目录"],
    "sub_content_3": ["子内容3", "子内容三", "四级目录"],
    "sub_content_4": ["子内容4", "子内容四", "五级目录"],
    "has_standard_template": ["是否提供标准格式", "提供标准格式", "是否有标准格式"],
    "from_history_bid": ["是否从往期投标文件中摘取", "是否从往期投标文件摘取", "从往期投标文件中摘取"],
    "ai_generated": ["是否AI自主编制", "是否 AI 自主编制", "AI自主编制"],
    "user_upload_required": ["是否用户事先上传", "是否用户上传", "用户事先上传"],
    "reference_technical_spec": ["参考技术规范书模板", "是否参考技术规范书模板"],
}
LEVELS = ["module_name", "sub_content_1", "sub_content_2", "sub_content_3"]
#: Strategy of each flag, in the order in which strategies are listed.
FLAG_STRATEGIES = {
    "user_upload_required": "need_user_upload", "from_history_bid": "historical_reuse", "has_standard_template": "template_fill",
    "ai_generated": "ai_generate", "reference_technical_spec": "spec_reference",
}
# Content types by keywords of the path, first match first, and what follows from a type.
CONTENT_KEYWORDS = {
    "project_specific_material": ("投标保证金", "保证金凭证", "本项目", "本次"),
    "attachment": ("营业执照", "扫描件", "证书", "合同", "发票", "保函", "保险", "证明", "附件"),
    "structured_field": ("基本情况表", "基本信息表", "股权信息", "人员表", "财务表", "参数表"),
    "template_text": ("说明", "声明", "承诺", "偏差表", "格式"),
    "reusable_text": ("方案", "措施", "保障", "服务", "计划", "理解"),
}
DEFAULT_TYPE = "template_text"
REUSE_METHODS = {"attachment": "附件召回", "structured_field": "结构化字段填充", "template_text": "模板参考复用", "reusable_text": "章节文本复用", "project_specific_material": "仅本次归档"}
DEFAULT_REUSE = "参考复用"
STORAGE = {
    "structured_field": ("structured_reuse", "extract_structured_fields"), "attachment": ("attachment_asset", "preserve_original_file"),
    "template_text": ("text_reuse", "extract_reusable_text"), "reusable_text": ("text_reuse", "extract_reusable_text"),
    "project_specific_material": ("project_archive_only", "archive_for_project_only"),
}


def header_row(cells: DataFrame, aliases: dict[str, list[str]] = COLUMN_ALIASES, rows: int = 8, least: int = 2) -> DataFrame:
    """``cells(sheet, row, col, value)``: the header row of each sheet, the first with most columns recognised (at least two)."""
    spark = cells.sparkSession
    known = spark.createDataFrame([(a, c) for c, names in aliases.items() for a in names], "alias string, canonical string").select(T.header_name(F.col("alias")).alias("alias"), "canonical").distinct()
    hits = cells.filter(F.col("row") < rows).select("sheet", "row", T.header_name(F.col("value")).alias("alias")).join(F.broadcast(known), "alias")
    scores = hits.groupBy("sheet", "row").agg(F.countDistinct("canonical").alias("score")).filter(F.col("score") >= least)
    return top(scores, ["sheet"], [F.desc("score"), F.asc("row")])


def canonical_columns(rows: DataFrame, aliases: dict[str, list[str]] = COLUMN_ALIASES) -> tuple[DataFrame, list[str]]:
    """Rows with canonical column names, the first alias present winning, and the columns that are missing."""
    plain = {c.replace(" ", "").replace("_", "").replace("-", "").replace("（", "(").replace("）", ")").lower(): c for c in reversed(rows.columns)}
    found, missing = [], []
    for canonical, names in aliases.items():
        keys = [n.replace(" ", "").replace("_", "").replace("-", "").lower() for n in names]
        here = next((plain[k] for k in keys if k in plain), canonical if canonical in rows.columns else None)
        if here is None:
            missing.append(canonical)
        found.append((F.col(f"`{here}`") if here else F.lit("")).alias(canonical))
    kept = [c for c in rows.columns if c in ("sheet", "row_ord")]
    return rows.select(*kept, *found), missing


def rules(rows: DataFrame, keys: tuple[str, ...] = ("sheet",), ord: str = "row_ord") -> DataFrame:
    """Sparse sheet rows as rules. Level 4 clears nothing above it and doesn't enter the path; rows without a path go."""
    cleaned = rows.select(*keys, ord, *[T.clean_text(F.col(c)).alias(c) for c in ["file_type", *LEVELS]], *[T.to_bool(F.col(f)).alias(f) for f in FLAG_STRATEGIES])
    filled = forward_fill(cleaned, LEVELS, list(keys), ord)
    path = T.section_path(*[F.col(c) for c in ["file_type", *LEVELS]])
    filled = filled.withColumn("section_path", path).filter((F.col("section_path") != "") & (F.col("section_path") != F.col("file_type")))
    return filled.withColumn("rule_id", stable_id("rule", F.col("section_path"), F.col(ord)))


def content_type(path: Column, keywords: dict = CONTENT_KEYWORDS, default: str = DEFAULT_TYPE) -> Column:
    """The first class one of whose keywords is in the path."""
    out = None
    for kind, words in keywords.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(path, F.lit(w))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise(default)


def _looked_up(key: Column, table: dict[str, str], default: str) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(default)


def reuse_method(kind: Column) -> Column:
    return _looked_up(kind, REUSE_METHODS, DEFAULT_REUSE)


def storage_profile(kind: Column) -> Column:
    known = kind.isin(*STORAGE)
    return F.struct(
        _looked_up(kind, {k: v[0] for k, v in STORAGE.items()}, "needs_further_analysis").alias("storage_category"),
        _looked_up(kind, {k: v[1] for k, v in STORAGE.items()}, "pending_analysis").alias("capture_mode"),
        F.when(known, "rule_based_initial").otherwise("pending_deeper_analysis").alias("analysis_status"),
    )


def process_strategy() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(flag), name) for flag, name in FLAG_STRATEGIES.items()]))


def route(df: DataFrame) -> DataFrame:
    """Rules joined with plan columns ``plan_strategy, plan_type, plan_reuse, long_term``: the routing decision."""
    own = process_strategy()
    out = df.withColumn("process_strategy", F.array_distinct(F.when(F.size(F.coalesce("plan_strategy", F.array().cast("array<string>"))) > 0, F.col("plan_strategy")).otherwise(own)))
    out = out.withColumn("candidate_type", F.coalesce(F.nullif(F.col("plan_type"), F.lit("")), content_type(F.col("section_path"))))
    out = out.withColumn("reuse_method", F.coalesce(F.nullif(F.col("plan_reuse"), F.lit("")), reuse_method(F.col("candidate_type")))).withColumn("storage", storage_profile(F.col("candidate_type")))
    reasons = [
        F.concat(F.lit("content_type="), "candidate_type"), F.concat(F.lit("storage_category="), "storage.storage_category"), F.concat(F.lit("capture_mode="), "storage.capture_mode"),
        F.concat(F.lit("reuse_method="), "reuse_method"), F.concat(F.lit("enter_long_term_library="), F.initcap(F.col("long_term").cast("string"))),
        F.when(F.size("process_strategy") > 0, F.concat(F.lit("process_strategy="), F.array_join("process_strategy", ","))),
    ]
    return out.withColumn("reuse_level", F.when(F.col("long_term"), "long_term").otherwise("project_only")).withColumn("reason", F.concat_ws("; ", *reasons))


def matches_target(path: Column, targets: Column) -> Column:
    """The whole path or its leaf is among the targets."""
    return F.array_contains(targets, path) | F.array_contains(targets, T.path_leaf(path))


def plan(rules_: DataFrame, overrides: DataFrame, file_type: str | None = None, ocr_pages=(), ocr_sections=(), table_sections=(), skip_sections=()) -> DataFrame:
    """Rules with overrides of their path (small, broadcast by Spark's own size check) as plan items."""
    def listed(x):
        return F.array(*[F.lit(v) for v in x]).cast("array<string>")

    r = rules_ if file_type is None else rules_.filter(F.col("file_type") == file_type)
    r = r.filter(~matches_target(F.col("section_path"), listed(skip_sections)))
    o = overrides.select("section_path", *[F.col(c).alias(f"o_{c}") for c in ("expected_pages", "content_type", "reuse_method", "long_term", "use_ocr", "parse_table")])
    j = r.join(o, "section_path", "left")
    pages = F.coalesce("o_expected_pages", F.array().cast("array<int>"))
    kind = F.coalesce("o_content_type", content_type(F.col("section_path")))
    ocr = F.coalesce("o_use_ocr", matches_target(F.col("section_path"), listed(ocr_sections))) | F.arrays_overlap(pages, F.array(*[F.lit(int(p)) for p in ocr_pages]).cast("array<int>"))
    table = F.coalesce("o_parse_table", matches_target(F.col("section_path"), listed(table_sections)))
    return j.select(
        "rule_id", "section_path", pages.alias("expected_pages"), kind.alias("content_type"), F.coalesce("o_reuse_method", reuse_method(kind)).alias("reuse_method"),
        process_strategy().alias("process_strategy"), ocr.alias("use_ocr"), table.alias("parse_table"),
        F.coalesce("o_long_term", kind != "project_specific_material").alias("enter_long_term_library"),
    )


def plan_pages(items: DataFrame, flag: str) -> DataFrame:
    """The pages of items with a flag, each once, in order."""
    return items.filter(F.col(flag)).select(F.explode("expected_pages").alias("page_no")).filter("page_no > 0").distinct()


def prune_pages(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of the given pages; no pages at all means all pages."""
    return rows.join(pages, "page_no", "left_semi") if pages.head(1) else rows


def load_report(rules_: DataFrame, skipped: DataFrame, missing: list[str]) -> DataFrame:
    return rules_.agg(F.count(F.lit(1)).alias("rule_count")).crossJoin(skipped.agg(F.count(F.lit(1)).alias("skipped_rows"))).withColumn("missing_columns", F.lit(",".join(sorted(missing))))


def ordered_distinct(df: DataFrame, column: str, ord: str) -> DataFrame:
    """Each value once, at its first place."""
    firsts = df.filter(F.coalesce(F.col(column), F.lit("")) != "").groupBy(column).agg(F.min(ord).alias("ord"))
    return firsts.withColumn("n", F.row_number().over(Window.orderBy("ord")))
