import json
import os

import pytest
from pyspark.sql import functions as F

from quirestone import cli
from quirestone.operators import masks as M
from quirestone.operators import packaging as P
from quirestone.sources import readers, writers
from quirestone.streaming import ingest


def test_config_defaults_without_a_file(tmp_path):
    assert readers.read_config(None) == readers.CONFIG_DEFAULTS == readers.read_config(os.fspath(tmp_path / "none.json"))
    (tmp_path / "c.json").write_text(json.dumps({"ocr_pages": [3]}))
    assert readers.read_config(os.fspath(tmp_path / "c.json"))["ocr_pages"] == [3]


def test_client_failures_are_rows(spark):
    calls = spark.createDataFrame([(1,), (2,), (3,)], "page_no int")

    def client(row):
        if row["page_no"] == 1:
            raise RuntimeError("down")
        return {"text": "ok"} if row["page_no"] == 2 else {}

    got = {r["page_no"]: (r["text"], r["error"]) for r in readers.call_pages(calls, client, "text string").collect()}
    assert got == {1: (None, "down"), 2: ("ok", None), 3: (None, "empty")}


def test_broken_documents_are_rows(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x")
    (tmp_path / "b.bin").write_bytes(b"!")

    def extract(data):
        if data == b"!":
            raise ValueError("no pages")
        yield {"page_no": len(data), "text": "t"}

    got = sorted((r["path"][-5:], r["error"], r["text"]) for r in readers.read_documents(spark, os.fspath(tmp_path), extract, "page_no int, text string").collect())
    assert got == [("a.bin", None, "t"), ("b.bin", "no pages", None)]


def test_paths_stay_below_their_root(tmp_path):
    root = os.fspath(tmp_path)
    assert writers.safe_join(root, "a", "b").startswith(os.path.realpath(root))
    with pytest.raises(ValueError):
        writers.safe_join(root, "..", "x")


def test_packages_are_written_and_packed(spark, tmp_path):
    root = os.fspath(tmp_path / "out")
    m = spark.createDataFrame([(1, "a", "# x")], "doc_id long, scope_id string, markdown string")
    i = spark.createDataFrame([(1, "a", 1, "text", "t1", 1, "x")], "doc_id long, scope_id string, n int, item_type string, item_id string, page_no int, text string")
    assert writers.write_packages(m, i, root).count() == 1
    data, counts = writers.light_pack(root)
    assert counts == {"markdown": 1, "json": 2, "images": 0, "csv": 0} and len(data) > 100


def test_repeated_margin_texts_go_and_body_stays(spark):
    rows = [(1, p, i, t, [50.0, y, 300.0, y + 10]) for i, (p, t, y) in enumerate([(1, "页眉", 20.0), (2, "页 眉", 20.0), (1, "7", 790.0), (1, "正文", 300.0), (2, "页眉", 400.0), (1, "单独", 20.0)])]
    b = spark.createDataFrame(rows, "doc_id long, page_no int, block_no int, text string, bbox array<double>")
    assert [r["block_no"] for r in M.without_decoration(b).orderBy("block_no").collect()] == [3, 4, 5]


def test_parent_prefaces(spark):
    scopes = spark.createDataFrame([(1, "总则 / 范围", 3, 50.0)], "doc_id long, section_path string, start_page int, start_y double")
    heads = spark.createDataFrame([(1, 1, 0.0, "总则"), (1, 2, 0.0, "总则说明"), (1, 3, 50.0, "范围")], "doc_id long, page_no int, y double, title string")
    r = P.parent_prefaces(scopes, heads).first()
    assert (r["parent_path"], r["start_page"], r["start_y"], r["end_page"], r["end_y"]) == ("总则", 1, 0.0, 3, 50.0)


def test_stream_of_chunks_goes_on_where_it_stopped(spark, tmp_path):
    src, out, ck = (os.fspath(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "doc_id long, text string"
    for n in range(2):
        spark.createDataFrame([(n, "x" * 600)], schema).coalesce(1).write.mode("append").parquet(src)
        ingest.start(ingest.chunk_stream(ingest.document_stream(spark, src, schema)), out, ck).awaitTermination(60)
    assert spark.read.parquet(out).groupBy("doc_id").agg(F.count("*")).count() == 2 and spark.read.parquet(out).count() == 4


def test_command_line(spark, tmp_path, capsys):
    src, out = os.fspath(tmp_path / "c"), os.fspath(tmp_path / "chunks")
    spark.createDataFrame([(1, "营业执照", "正文 内容"), (2, "other", "x")], "candidate_id long, title string, content string").write.parquet(src)
    cli.main(["build-chunks", "--input", src, "--out", out])
    cli.main(["search", "--input", out, "--query", "执照", "-k", "1"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rank"] == 1
    assert cli.elapsed(61) == "1m 1s" and cli.flag("是") and not cli.flag("no")
