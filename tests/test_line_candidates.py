"""Line candidates against all pairs, and text helpers against Python's."""

import random
import unicodedata

from pyspark.sql import functions as F

from quirestone.functions import text as T
from quirestone.operators import matching as M


def test_no_scoring_pair_is_left_out(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcde身份证附件证明") for _ in range(r.randrange(1, 5)))
    titles = [" ".join(word() for _ in range(r.randrange(1, 4))) for _ in range(40)] + ["a", "", "等", "证明材料", "营业执照扫描件", "身份证及证明文件", "ab和cd"]
    rules = spark.createDataFrame([(i, t, "", "", t, "", "") for i, t in enumerate(titles)], "rule_id long, section_path string, sub_content_2 string, sub_content_3 string, sub_content_1 string, module_name string, file_type string")
    lines = [r.choice(["", "附件", "x "]) + (r.choice(titles) if r.random() < 0.5 else word()) + r.choice(["", word(), " 扫描件"]) for _ in range(150)]
    lines = spark.createDataFrame([(0, f"b{i}", 1, i, 0, t) for i, t in enumerate(lines) if t.strip()], "doc_id long, block_id string, page_no int, block_no int, line_no int, line string").withColumn("line_key", T.normalize_title(F.col("line")))
    rows = M.line_rules(M.rule_titles(rules)).cache()
    every = rows.join(lines, F.lit(True)).withColumn("m", M.line_score()).filter(F.round("m.score", 4) >= M.LEAST)
    want = sorted((x["rule_id"], x["block_id"], round(x["m"]["score"], 4), x["m"]["reason"]) for x in every.collect())
    got = sorted((x["rule_id"], x["block_id"], x["score"], x["reason"]) for x in M.line_matches(rows, lines).collect())
    assert got == want and len({x[3] for x in want}) >= 3


def test_nfkc_and_strip_of_every_character(spark):
    chars = [chr(i) for i in (*range(0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), 0x1680, *range(0x3000, 0x3020), *range(0x4E00, 0x4E20), *range(0xFF00, 0xFFF0))]
    texts = [f"a{c}b" for c in chars] + [c + "x" + c for c in chars]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", T.half_width(F.col("t")).alias("n"), T.strip(F.col("t")).alias("s")).orderBy("i").collect()
    white = set(T.WHITE_SPACE)
    assert [r["n"] for r in got] == [unicodedata.normalize("NFKC", t) for t in texts]
    assert [r["s"] for r in got] == [t.strip("".join(white)) for t in texts]
