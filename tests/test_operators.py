import pytest
from pyspark.sql import functions as F

from quirestone.operators import candidates as C
from quirestone.operators import context as X
from quirestone.operators import matching as MA
from quirestone.operators import packaging as P
from quirestone.operators import retrieval as R
from quirestone.operators import review_index as V
from quirestone.operators import rules as RU
from quirestone.operators import sections as S
from quirestone.operators import tables as TB

BLOCK = "doc_id long, block_id string, page_no int, block_no int, text string, bbox array<double>, source_type string, font_size double"


def blocks(spark, rows):
    return spark.createDataFrame([(1, f"b{i}", p, i, t, [50.0, float(y), 300.0, float(y) + 12], "pdf_text", float(f)) for i, (p, y, t, f) in enumerate(rows)], BLOCK)


def test_chunk_lengths(spark):
    df = spark.createDataFrame([(n, "t", "x" * n) for n in (0, 1, 500, 501, 920, 921)], "candidate_id long, title string, content string")
    got = {r["candidate_id"]: r["l"] for r in R.chunks(df).groupBy("candidate_id").agg(F.sort_array(F.collect_list(F.length("content"))).alias("l")).collect()}
    assert got == {0: [1], 1: [1], 500: [500], 501: [81, 500], 920: [500, 500], 921: [81, 500, 500]}


def test_bm25_counts_repeated_query_tokens_and_fills_up(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["c"]), (4, ["d"]), (5, ["e"])], "doc_id long, tokens array<string>")
    q = spark.createDataFrame([(0, ["b"]), (1, ["b", "b"]), (2, ["zz"])], "query_id long, tokens array<string>")
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in R.bm25(docs, q, 3).collect()}
    assert len(got) == 9
    assert got[1, 1][1] == pytest.approx(2 * got[0, 1][1])
    assert [got[2, i][0] for i in (1, 2, 3)] == [1, 2, 3]
    assert got[0, 1][0] == 1 and [got[0, i][0] for i in (2, 3)] == [2, 3]


def test_evaluation_looks_at_the_preview_only(spark):
    ranked = spark.createDataFrame([(0, 1, "t", "y " * 100 + "key"), (0, 2, "key", "x"), (1, 1, "t", "x")], "query_id long, rank int, title string, content string")
    q = spark.createDataFrame([(0, ["key"]), (1, []), (2, ["x"])], "query_id long, keywords array<string>")
    e = R.evaluate(ranked, q)
    assert {r["query_id"]: r["hit_rank"] for r in e.collect()} == {0: 2, 1: 1, 2: None}
    assert tuple(R.report(e).first()) == (3, 2, pytest.approx(2 / 3))
    assert tuple(R.report(e.limit(0)).first()) == (0, 0, 0.0)


def test_rules_are_filled_down(spark):
    flags = ", ".join(f"{f} string" for f in RU.FLAG_STRATEGIES)
    rows = [("s", 1, "", "补充文件", "投标保证金", "银行汇款", "", *["否"] * 5), ("s", 2, "", "", "", "银行保函", "", *["是"] * 5), ("s", 3, "", "", "投标人基本情况表", "基本信息", "", *["是"] * 5), ("s", 4, "", "", "", "股权信息", "", *["是"] * 5)]
    df = spark.createDataFrame(rows, f"sheet string, row_ord int, file_type string, module_name string, sub_content_1 string, sub_content_2 string, sub_content_3 string, {flags}")
    got = [r["section_path"] for r in RU.rules(df).orderBy("row_ord").collect()]
    assert got == ["补充文件 / 投标保证金 / 银行汇款", "补充文件 / 投标保证金 / 银行保函", "补充文件 / 投标人基本情况表 / 基本信息", "补充文件 / 投标人基本情况表 / 股权信息"]


def test_header_row_needs_two_columns(spark):
    cells = spark.createDataFrame([("s", 0, 0, "标题"), ("s", 1, 0, "组成模块"), ("s", 1, 1, "子内容 1"), ("s", 2, 0, "x"), ("t", 0, 0, "组成模块")], "sheet string, row int, col int, value string")
    assert [(r["sheet"], r["row"]) for r in RU.header_row(cells).collect()] == [("s", 1)]


def test_heading_lines_merge_once(spark):
    b = blocks(spark, [(1, 100, "1.1 资格证明（含", 12), (1, 116, "扫描件）", 12), (1, 140, "1.2 下一节", 12), (1, 156, "x", 12)])
    got = [r["text"] for r in S.merge_heading_lines(b).orderBy("block_no").collect()]
    assert got == ["1.1 资格证明（含扫描件）", "1.2 下一节", "x"]


def test_sections_fall_back_to_the_whole_document(spark):
    b = blocks(spark, [(1, 0, "a" * 60, 10), (3, 0, "b" * 60, 10)])
    r = S.sections_from_blocks(b).collect()
    assert [(x["title"], x["page_start"], x["page_end"]) for x in r] == [("全文", 1, 3)]


def test_leaf_bounds_and_contents_pages(spark):
    b = blocks(spark, [(2, 100, "甲 节", 12), (2, 300, "乙节", 12), (5, 500, "丙节", 12)])
    leaves = spark.createDataFrame([(1, 1, "甲节", 2, 2), (1, 2, "乙节", 2, 5), (1, 3, "丙节", 5, 9)], "doc_id long, ord int, title string, page_start int, page_end int")
    toc = spark.createDataFrame([(1, 8)], "doc_id long, page_no int")
    got = [(r["start_y"], r["end_y"], r["page_end"]) for r in S.leaf_bounds(leaves, b, toc).orderBy("ord").collect()]
    assert got == [(100.0, 300.0, 2), (300.0, 500.0, 5), (500.0, None, 7)]


def test_title_scores(spark):
    pairs = [("abc", "abc"), ("abc", "xabcx"), ("abcdefgh", "abcdefgx"), ("abcd", "dcxx"), ("ab", "xy"), ("abc", "")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [(round(r["m"]["score"], 3), r["m"]["reason"]) for r in df.select("i", MA.title_score(F.col("a"), F.col("b")).alias("m")).orderBy("i").collect()]
    assert got == [(1.0, "exact_normalized"), (0.92, "contains_match"), (0.875, "fuzzy_match"), (0.5, "keyword_overlap"), (0.0, "no_match"), (0.92, "contains_match")]


def test_matching_end_to_end(spark):
    rules = spark.createDataFrame([("r1", "F", "模块", "营业执照扫描件", "", "", "F / 模块 / 营业执照扫描件"), ("r2", "F", "模块", "没有的内容", "", "", "F / 模块 / 没有的内容")], "rule_id string, file_type string, module_name string, sub_content_1 string, sub_content_2 string, sub_content_3 string, section_path string")
    b = blocks(spark, [(1, 0, "目录", 12), (1, 20, "营业执照扫描件", 12), (30, 0, "附：营业执照扫描件", 12), (30, 50, "其他", 12)])
    secs = spark.createDataFrame([(1, "s1", "第一章", "第一章", 1, 1, 40, 0)], "doc_id long, section_id string, title string, normalized_title string, level int, page_start int, page_end int, ord int")
    got = {r["rule_id"]: (r["matched"], r["page_no"], r["container_title"]) for r in MA.match(rules, secs, b).collect()}
    assert got == {"r1": (True, 30, "第一章"), "r2": (False, None, None)}


def test_fields_last_wins_and_lines_only_without_tables(spark):
    t = spark.createDataFrame([(1, 1, [["名称", "甲", "乙"], ["x"]]), (1, 2, [["名称", "丙"]])], "doc_id long, ord int, rows array<array<string>>")
    b = spark.createDataFrame([(1, 1, "电话：1"), (2, 1, "电话：1:2\n地址: 路")], "doc_id long, ord int, text string")
    got = {(r["doc_id"], r["name"]): r["value"] for r in C.fields(t, b, ["doc_id"]).collect()}
    assert got == {(1, "名称"): "丙", (2, "电话"): "1:2", (2, "地址"): "路"}


def test_html_spans_and_blank_rows():
    m = TB.parse_html("<table><tr><th rowspan=2>a</th><th colspan=2>b</th></tr><tr><td></td></tr><tr><td>c</td><td>d</td></tr></table>")
    assert m["rows"] == [["a", "b", ""], ["", "c", "d"]] and m["merged"] == 2
    assert TB.parse_html("no table") is None


def test_json_tables_are_repaired():
    assert TB.parse_json_table("```json\n{\"rows\": [[\"a\", null], [\"b\"]]}\n```")["rows"] == [["a", ""], ["b", ""]]
    assert TB.parse_json_table('[["x"]]')["col_count"] == 1
    assert TB.parse_json_table("not json") is None
    assert TB.parse_json_table('{"cells": [{"row": 1, "col": 0, "text": "v"}]}')["rows"] == [[""], ["v"]]


def test_grid_from_boxes():
    m = TB.grid_from_boxes([(0, 0, 20, 10, "h"), (0, 10, 10, 20, "a"), (10, 10, 20, 20, "b")])
    assert m["rows"] == [["h", ""], ["a", "b"]] and m["merged"] == 1


def test_regions_merge_and_link_over_pages(spark):
    rows = [(1, "r1", 1, [0.0, 300.0, 100.0, 700.0], ["pp_structure"], 0.6, ["t1"]), (1, "r2", 1, [0.0, 310.0, 100.0, 705.0], ["pdfplumber"], 0.7, ["t2"]), (1, "r3", 2, [2.0, 50.0, 100.0, 200.0], ["pdfplumber"], 0.5, ["t3"]), (1, "r4", 2, [2.0, 220.0, 99.0, 300.0], ["pdfplumber"], 0.5, [])]
    merged = TB.merge_regions(spark.createDataFrame(rows, TB.REGION))
    first = merged.filter("region_id = 'r1'").first()
    assert first["detectors"] == ["pdfplumber", "pp_structure"] and first["confidence"] == 0.75 and first["bbox"] == [0.0, 300.0, 100.0, 705.0]
    g = TB.group_regions(merged).collect()
    assert [(x["start_page"], x["end_page"], x["region_ids"], x["is_cross_page"]) for x in g] == [(1, 2, ["r1", "r3", "r4"], True)]


def test_review_index_entries(spark):
    b = blocks(spark, [(1, 0, "商务评审索引表", 12)])
    rows = [["评审项目", "评审要素", ""], ["资质(0-5)", "证书", "详见第12页：营业执照详见第15页：税务"], ["", "业绩", "第20页:合同"]]
    t = spark.createDataFrame([(1, 3, "t", rows), (1, 9, "u", rows)], "doc_id long, page_no int, table_id string, rows array<array<string>>")
    got = [(r["project_label"], r["element_label"], r["title"], r["page_start"]) for r in V.entries(b, t).orderBy("ord").collect()]
    assert got == [("资质", "证书", "营业执照", 12), ("资质", "证书", "税务", 15), ("资质", "业绩", "合同", 20)]


def test_nearest_heading_is_strictly_before(spark):
    b = blocks(spark, [(1, 100, "1.1 甲", 12), (1, 200, "1.2 乙", 12), (2, 50, "正文", 12)])
    items = spark.createDataFrame([(1, "i1", 1, 100.0), (1, "i2", 1, 150.0), (1, "i3", 1, 200.0), (1, "i4", 2, 0.0)], "doc_id long, item_id string, page_no int, top_y double")
    got = {r["item_id"]: r["heading_title"] for r in P.nearest_heading(items, P.headings(b)).collect()}
    assert got == {"i1": None, "i2": "甲", "i3": "甲", "i4": "乙"}


def test_inferred_scopes_end_at_the_next_heading_outside(spark):
    b = blocks(spark, [(1, 0, "1. 总则", 12), (2, 10, "1.1 范围", 12), (4, 20, "2. 其他", 12), (6, 0, "完", 12)])
    p = spark.createDataFrame([(1, "1. 总则"), (1, "1. 总则 / 1.1 范围"), (1, "2. 其他")], "doc_id long, section_path string")
    got = {r["section_path"]: (r["start_page"], r["start_y"], r["end_page"], r["end_y"]) for r in P.inferred_scopes(p, b).collect()}
    assert got == {"1. 总则": (1, 0.0, 4, 20.0), "1. 总则 / 1.1 范围": (2, 10.0, 4, 20.0), "2. 其他": (4, 20.0, 6, None)}


def test_markdown_pairs_roles_and_repeats():
    text = lambda t, role="body_text", page=1: {"item_id": t, "item_type": "text", "page_no": page, "text": t, "bbox": [0, 0, 1, 1], "role": role}
    assert P.render([text("名称：甲"), text("地址：乙"), text("名称：甲"), text("格", "table_text")]) == "| 字段 | 内容 |\n| --- | --- |\n| 名称 | 甲 |\n| 地址 | 乙 |"


def test_lookup_cascade(spark):
    m = X.index(spark.createDataFrame([("r", "m/1", "文件 / 一、营业执照", "一、营业执照"), ("r", "m/2", "文件 / 二、财务报表", "二、财务报表")], "run_name string, material_path string, section_path string, title string"))
    q = spark.createDataFrame([(1, "文件 / 一、营业执照", None), (2, "文件/一、营业执照", None), (3, None, "营业执照"), (4, None, "财务报告"), (5, None, "无关内容xyz")], "request_id int, section_path string, title string")
    found = X.lookup(m, q)
    assert {r["request_id"]: r["match_type"] for r in found.collect()} == {1: "exact_path", 2: "normalized_path", 3: "title", 4: "fuzzy"}
    assert {r["request_id"]: r["status"] for r in X.status(q, found).collect()} == {1: "matched", 2: "matched", 3: "matched", 4: "matched", 5: "not_found"}
