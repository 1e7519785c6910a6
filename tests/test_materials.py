import random

import pytest
from pyspark.sql import functions as F

from quirestone.functions import text as T
from quirestone.operators import context as X
from quirestone.operators import materials as A
from quirestone.sources import readers, writers

CELLS = "array<array<string>>"


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in cols.items())
    return spark.createDataFrame([tuple(v for _, v in cols.values())], schema).select(expr.alias("x")).first()["x"]


def test_cell_signature_keeps_case_and_stops(spark):
    assert one(spark, T.cell_signature(F.col("t")), t=("string", " A-b_（c）《D》—【e】<f> 1.5μm；x₂\n")) == "AbcDef1.5umx2"
    assert one(spark, T.cell_signature(F.col("t")), t=("string", None)) == ""


def test_notes_begin_after_a_sum_or_with_an_opening_word(spark):
    def cut(rows):
        return one(spark, A.without_tail_notes(F.col("r")), r=(CELLS, rows))

    assert cut([["a", "1"], ["合 计", "1"], ["", None], ["投标人须附发票", ""], ["b", ""]]) == [["a", "1"], ["合 计", "1"], ["", None]]
    assert cut([["a"], ["投标人须附发票"], ["合计"]]) == [["a"], ["投标人须附发票"], ["合计"]]
    assert cut([["a"], ["", "编制说明：x"], ["b"]]) == [["a"]]
    assert cut([["x 编制说明"], ["合计：证明材料"]]) == [["x 编制说明"], ["合计：证明材料"]]
    assert cut([]) == []


def test_note_rows_are_as_wide_as_the_table(spark):
    assert one(spark, A.with_note_row(F.col("r"), F.lit("注")), r=(CELLS, [["a", "b"], ["c"]])) == [["a", "b"], ["c"], ["注", ""]]
    assert one(spark, A.with_note_row(F.col("r"), F.lit("")), r=(CELLS, [["a"]])) == [["a"]]
    assert one(spark, A.with_note_row(F.col("r"), F.lit("注")), r=(CELLS, [])) == [["注"]]


def test_notes_lose_the_cells_they_repeat(spark):
    rows = [["设备名称规格", "型号ABC12345"], ["数量", "1"]]
    got = {t: one(spark, A.trimmed_note(F.col("t"), F.col("r")), t=("string", t), r=(CELLS, rows)) for t in (
        "设备名称规格 型号ABC12345  说明：如下", "设备名称规格 说明：如下", "说明：如下", "设备名称规格 型号ABC12345 其他", " ", "甲设备名称规格，型号ABC12345。投标人须说明")}
    assert got == {
        "设备名称规格 型号ABC12345  说明：如下": "说明：如下", "设备名称规格 说明：如下": "设备名称规格 说明：如下", "说明：如下": "说明：如下",
        "设备名称规格 型号ABC12345 其他": "设备名称规格 型号ABC12345 其他", " ": "", "甲设备名称规格，型号ABC12345。投标人须说明": "投标人须说明",
    }
    assert one(spark, A.trimmed_note(F.col("t"), F.col("r")), t=("string", None), r=(CELLS, rows)) == ""


def test_first_rows_that_the_text_above_says_go(spark):
    def cut(rows, texts):
        return one(spark, A.without_repeated_head(F.col("r"), F.col("t")), r=(CELLS, rows), t=("array<string>", texts))

    rows = [["设备名称", "规格型号"], ["序号一二三四五"], ["x"], ["设备名称", "规格型号"]]
    assert cut(rows, ["设备名称 规格型号", "序号一二三四五"]) == rows[2:]
    assert cut(rows, ["序号一二三四五"]) == rows
    assert cut(rows, []) == rows and cut([], ["abcdef"]) == []
    assert cut([["abcdef"]], ["abcdef"]) == []


def test_picture_cells_take_references_in_order(spark):
    kind = "array<struct<text:string,image_ref:string>>"
    cells = [("[图片]", None), ("x", None), ("[图片]", "old"), (" [图片] ", ""), ("[图片]", None), (None, None)]

    def refs(expr, c=cells):
        return [x["image_ref"] for x in one(spark, expr, c=(kind, c))]

    assert refs(A.filled_cells(F.col("c"), F.array(F.lit("a"), F.lit("b")))) == ["a", None, "old", "b", None, None]
    assert refs(A.filled_cells(F.col("c"), F.array().cast("array<string>"))) == [None, None, "old", "", None, None]
    targets = F.create_map(F.lit("old"), F.lit("new"), F.lit("id"), F.lit("new"))
    assert refs(A.retargeted_cells(F.col("c"), targets)) == ["new", None, "new", "", None, None]
    assert refs(A.retargeted_cells(F.col("c"), F.lit(None).cast("map<string,string>"))) == [None, None, "old", "", None, None]
    assert one(spark, A.retargeted_cells(F.col("c"), targets), c=(kind, [])) == []


def test_layout_boxes_give_way_to_tables_and_to_earlier_boxes(spark):
    rng = random.Random(3)
    box = lambda: [x := float(rng.randrange(50)), y := float(rng.randrange(50)), x + rng.randrange(10, 40), y + rng.randrange(10, 40)]
    pages = [(1, i, [(rng.choice(["table", "text"]), box(), "<table><tr><td>a</td></tr></table>") for _ in range(2)], ([("table", box(), 0.9) for _ in range(12)],)) for i in range(20)]
    pages.append((2, 0, [("table", [1.0], "x"), ("table", None, None)], ([("image", box(), 0.5), ("table", None, None)],)))
    pages.append((2, 1, None, None))
    df = spark.createDataFrame(pages, "doc_id long, page_index int, parsing_res_list array<struct<block_label:string,block_bbox:array<double>,block_content:string>>, layout_det_res struct<boxes:array<struct<label:string,coordinate:array<double>,score:double>>>")

    def share(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        return w * h / min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1])) if w > 0 and h > 0 else 0

    want = []
    for doc, page, parsed, (found,) in pages[:20]:
        kept = [b for label, b, _ in parsed if label == "table"]
        for _, b, _ in found:
            if all(share(b, k) < 0.8 for k in kept):
                kept.append(b)
        want += [(doc, page + 1, b) for b in kept]
    got = A.layout_tables(df).collect()
    assert sorted((r["doc_id"], r["page_no"], r["bbox"]) for r in got) == sorted(want)
    assert {tuple(map(tuple, r["rows"])) for r in got} == {(("a",),), ()}


def test_recognised_lines_pair_what_is_left(spark):
    ocr = (["a", " ", "b", "c"], [[0.0, 100.0, 10.0, 110.0], [1.0, 2.0], [0.0, 120.0, 10.0, 130.0]], [0.5, None, 0.7])
    df = spark.createDataFrame([(1, 0, 800, ocr), (2, 0, None, (None, None, None)), (3, 0, 800, None)], "doc_id long, page_index int, height int, overall_ocr_res struct<rec_texts:array<string>,rec_boxes:array<array<double>>,rec_scores:array<double>>")
    got = A.recognised_lines(df)
    assert [(r["text"], r["bbox"][1], r["score"]) for r in got.orderBy("n").collect()] == [("a", 100.0, 0.5), ("b", 120.0, 0.7)]
    regions = spark.createDataFrame([(1, 1, "r", [0.0, 98.0, 10.0, 108.0]), (1, 1, "none", [50.0, 0.0, 60.0, 10.0])], "doc_id long, page_no int, region_id string, bbox array<double>")
    assert [(r["region_id"], r["texts"], r["scores"]) for r in A.region_lines(got, regions).collect()] == [("r", ["a"], [0.5])]


def test_red_stamps(spark):
    red, white, dark, clear, blue = bytes([200, 20, 30, 255]), b"\xff" * 4, bytes([0, 0, 0, 255]), bytes([200, 0, 0, 5]), bytes([0, 0, 200, 255])
    rows = [(red * 20 + white * 80, 100.0, 100.0, True), (red * 20 + blue * 30 + white * 50, 100.0, 100.0, False), (red * 20 + white * 80, 300.0, 300.0, False), (red * 20 + white * 80, 100.0, 20.0, False),
            (white * 100, 100.0, 100.0, False), (clear * 100, 100.0, 100.0, False), (red * 80 + dark * 20, 100.0, 100.0, False), (red * 20 + clear * 80, None, 100.0, False), (None, 1.0, 1.0, False), (b"", 1.0, 1.0, False)]
    df = spark.createDataFrame(rows, "p binary, w double, h double, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", A.red_stamp("p", "w", "h").alias("got")).collect())


def test_images_belong_to_the_anchor_above_them(spark):
    rng = random.Random(4)
    anchors = [(1, p, f"a{p}-{i}", float(rng.randrange(0, 100, 5))) for p in range(6) for i in range(4)]
    images = [(1, p, f"i{p}-{i}", [float(rng.randrange(9)), float(rng.randrange(0, 100, 5)), 0.0, 0.0]) for p in range(6) for i in range(9)]
    edges = [(1, p, float(rng.randrange(0, 100, 5))) for p in range(6) for _ in range(4)]
    a, i = spark.createDataFrame(anchors, "doc_id long, page_no int, anchor_id string, y double"), spark.createDataFrame(images, "doc_id long, page_no int, image_id string, bbox array<double>")
    for given, marks in ((None, [(d, p, y) for d, p, _, y in anchors]), (spark.createDataFrame(edges, "doc_id long, page_no int, y double"), edges)):
        want = set()
        for _, p, name, y in anchors:
            end = min((e for _, q, e in marks if q == p and e > y), default=1e9)
            want |= {(name, k) for _, q, k, b in images if q == p and y < b[1] < end}
        assert {(r["anchor_id"], r["image_id"]) for r in A.anchor_images(a, i, given).collect()} == want


def test_anchors_name_what_the_title_names(spark):
    rows = [("法定代表人身份证", "附：法定代表人身份证扫描件", True), ("法定代表人身份证", "附：被授权人身份证", False), ("营业执照", "附：税务登记", False), ("公司业绩一览", "完全不同的文字", False), ("", "附：x", True), (None, None, True), ("（）", "x", True), ("甲", "乙", False)]
    df = spark.createDataFrame(rows, "t string, x string, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", A.anchor_matches(F.col("t"), F.col("x")).alias("got")).collect())


def test_documents_tell_nothing_twice(spark):
    items = [(1, "s", 1, "text", "a", 1, 10.0, "Intro", "body_text"), (1, "s", 2, "text", "b", 1, 20.0, "## Child", "body_text"), (1, "s", 3, "text", "c", 1, 30.0, "inside", "body_text"), (1, "c", 1, "text", "c", 1, 30.0, "inside", "body_text"), (1, "c", 2, "text", "d", 1, 40.0, "hidden", "table_text"), (1, "e", 1, "text", "f", 1, 1.0, "z", "table_text")]
    df = spark.createDataFrame(items, "doc_id long, scope_id string, n int, item_type string, item_id string, page_no int, top_y double, text string, role string").withColumn("bbox", F.array("top_y"))
    materials = spark.createDataFrame([(1, "s", "S", 1), (1, "c", "Child", 2), (1, "e", "E", 1)], "doc_id long, scope_id string, title string, depth int")
    children = spark.createDataFrame([(1, "s", "Child")], "doc_id long, scope_id string, title string")
    got = A.full_documents(df, materials, children).first()
    assert (got["markdown"], got["materials"]) == ("# 解析全文\n\n## S\n\nIntro\n\n### Child\n\ninside\n", 2)


def test_tables_take_the_note_below_them(spark):
    stream = [(1, "s", 1, "table", "t", 1, None, "table"), (1, "s", 2, "text", "a", 1, "正文", "body_text"), (1, "s", 3, "text", "b", 1, "说明：x", "body_text"), (1, "s", 4, "text", "c", 1, "说明：y", "body_text"), (1, "s", 5, "table", "u", 2, None, "table")]
    df = spark.createDataFrame(stream, "doc_id long, scope_id string, n int, item_type string, item_id string, page_no int, text string, role string")
    tables = spark.createDataFrame([(1, "t", [["a", "b"], ["合计", "1"], ["发票 z", ""]]), (1, "u", [["q"]])], f"doc_id long, table_id string, rows {CELLS}")
    got = {r["item_id"]: (r["role"], r["markdown"]) for r in A.with_tail_notes(df, tables).collect()}
    assert got["t"] == ("table", "| a | b |\n| --- | --- |\n| 合计 | 1 |\n| 说明：x |  |")
    assert got["u"] == ("table", "| q |\n| --- |") and got["b"] == ("table_note", None) and got["a"][0] == got["c"][0] == "body_text"


def test_attachments_are_named_once(spark):
    big = [0.0, 100.0, 300.0, 300.0]
    images = [(1, 1, "i1", big, 400, 300, ), (1, 1, "i2", [0.0, 400.0, 300.0, 600.0], 400, 300), (1, 1, "tiny", [0.0, 0.0, 9.0, 9.0], 400, 300), (1, 3, "i3", big, 400, 300), (1, 4, "i4", big, 400, 300), (1, 6, "i5", big, 400, 300)]
    i = spark.createDataFrame(images, "doc_id long, page_no int, image_id string, bbox array<double>, width int, height int")
    c = spark.createDataFrame([(1, "a", "证照", 1, None, 0), (1, "b", "证照", 1, 1, 1), (1, "c", "证照", 1, 1, 2), (1, "d", "营业执照", 3, 4, 3), (1, "e", "其他材料", 5, 6, 4), (1, "f", "无页", None, None, 5), (1, "g", "空", 8, 9, 6)], "doc_id long, candidate_id string, title string, page_start int, page_end int, ord int")
    lines = spark.createDataFrame([(1, 3, "l1", "附：营业执照", 50.0), (1, 3, "l2", "附：税务登记", 290.0), (1, 4, "l3", None, 1.0)], "doc_id long, page_no int, line_id string, text string, y double")
    got = sorted(((r["candidate_id"], r["export_status"].split("_")[0], r["image_id"], r["asset"]) for r in A.attachment_manifest(c, lines, i).collect()))
    assert got == [("a", "exported", "i1", "证照"), ("b", "exported", "i2", "证照_2"), ("c", "no", None, None), ("d", "exported", "i3", "营业执照_1"), ("e", "exported", "i5", "其他材料_1"), ("f", "source", None, None), ("g", "no", None, None)]
    assert one(spark, A.asset_name(F.col("t"), F.col("a")), t=("string", "x"), a=("string", "附： a/b  c ")) == "a_b c"
    assert one(spark, A.asset_name(F.col("t")), t=("string", None)) == "未命名附件"


def test_the_only_best_run_answers(spark):
    rows = [(1, "a", "matched", "title", 1), (1, "b", "matched", "exact_path", 1), (2, "a", "matched", "title", 1), (2, "b", "matched", "title", 1), (3, "a", "ambiguous", "title", 2), (3, "b", "not_found", None, 0), (4, "a", "not_found", None, 0), (5, "a", "ambiguous", "title", 2), (5, "b", "matched", "fuzzy", 1)]
    df = spark.createDataFrame(rows, "request_id int, run_name string, status string, match_type string, n int")
    got = {r[0]: tuple(r)[1:] for r in X.project_status(df).collect()}
    assert got == {1: ("matched", "exact_path", "b"), 2: ("ambiguous", "multi_run", None), 3: ("ambiguous", "multi_run", None), 4: ("not_found", "not_found", None), 5: ("matched", "fuzzy", "b")}


def test_files_stay_below_their_root_and_the_first_answer_wins(spark, tmp_path):
    files = spark.createDataFrame([("a/b.png", bytearray(b"12")), ("c.png", None)], "path string, content binary")
    assert [tuple(r) for r in writers.write_files(files, str(tmp_path)).collect()] == [("a/b.png", 2)]
    assert (tmp_path / "a" / "b.png").read_bytes() == b"12"
    with pytest.raises(Exception, match="leaves its root"):
        writers.write_files(spark.createDataFrame([("../x", bytearray(b"1"))], "path string, content binary"), str(tmp_path)).collect()
    data, counts = writers.light_pack(str(tmp_path), ("images",), str(tmp_path / "pack.zip"))
    assert data == b"" and counts["images"] == 1 and (tmp_path / "pack.zip").stat().st_size > 0

    def broken(row):
        raise ValueError("down")

    pages = spark.createDataFrame([(1,)], "page_no int")
    assert readers.call_pages(pages, [broken, lambda r: {}, lambda r: {"t": "x"}], "t string").first()["t"] == "x"
    assert readers.call_pages(pages, [broken], "t string").first()["error"] == "down"


def test_boxes_are_clipped_to_known_pages(spark):
    box = ("array<double>", [-5.0, 2.0, 700.0, 900.0])
    assert one(spark, A.clipped_box(F.col("b"), F.lit(600), F.lit(None).cast("int")), b=box) == [0.0, 2.0, 600.0, 900.0]
    assert one(spark, A.is_native_model(F.col("s")), s=("string", "pdfplumber_cells")) and not one(spark, A.is_native_model(F.col("s")), s=("string", None))
