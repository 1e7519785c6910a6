import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirestone.functions import geometry as G
from quirestone.functions import text as T
from quirestone.functions.ids import stable_id


def ask(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_and_preview(spark):
    assert ask(spark, T.clean_text, [None, "　a　b ", " x"]) == ["", "a b", "x"]
    assert ask(spark, lambda x: T.preview(x, 5), ["a \n\t b  c d"]) == ["a b c"]


def test_numbering_is_stripped_repeatedly(spark):
    values = ["一、投标", "（一）投标", "1.1 投标", "1.1 （二）投标", "一般说明", "2024年报", "１．２ 投标", ""]
    assert ask(spark, T.strip_numbering, values) == ["投标", "投标", "投标", "投标", "般说明", "年报", "投标", ""]


def test_titles_are_normalised(spark):
    assert ask(spark, T.normalize_title, ["一、 A B：c", "é（x）"]) == ["abc", "éx"]


def test_tokens_hold_runs_and_bigrams(spark):
    assert ask(spark, T.tokens, ["营业执照 ABC12 中", None]) == [["营业执照", "营业", "业执", "执照", "abc12", "中"], []]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ＡＢａ1２①é中国　 .\n", max_size=12), min_size=1, max_size=20))
def test_tokens_match_a_python_reading(spark, values):
    def plain(x):
        out = []
        for p in re.findall(r"[一-鿿]+|[a-z0-9]+", unicodedata.normalize("NFKC", x.replace("　", " ").strip()).lower()):
            out.append(p)
            if re.fullmatch(r"[一-鿿]{2,}", p):
                out += [p[i : i + 2] for i in range(len(p) - 1)]
        return out

    assert ask(spark, T.tokens, values) == [plain(v) for v in values]


@pytest.mark.parametrize(
    ("text", "level", "title"),
    [("1.2.3 资格", 3, "资格"), ("2、概述", 1, "概述"), ("（1.2）说明", 12, "说明"), ("三、总则", 1, "总则"), ("附：证书", 99, "证书"), ("正文", 50, "正文"), ("1.", 1, "1.")],
)
def test_heading_grammar(spark, text, level, title):
    assert ask(spark, T.heading_level, [text]) == [level]
    assert ask(spark, T.display_title, [text]) == [title]
    assert ask(spark, T.is_heading, [text]) == [level != 50]


def test_bool_words(spark):
    assert ask(spark, T.to_bool, ["是", "Y", "1", "否", "0", "", None, "-"]) == [True, True, True, False, False, False, False, False]


def test_indel_ratio_with_its_filter(spark):
    df = spark.createDataFrame([("abcd", "abed"), ("", ""), ("abc", "xyz")], "a string, b string")
    assert [r[0] for r in df.select(T.indel_ratio(F.col("a"), F.col("b"))).collect()] == [0.75, 1.0, 0.0]
    assert [r[0] for r in df.select(T.indel_ratio(F.col("a"), F.col("b"), 0.75)).collect()] == [0.75, 1.0, 0.0]


def test_stable_id_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    want = "p_" + hashlib.sha1(b"a||||3").hexdigest()[:12]
    assert df.select(stable_id("p", F.col("a"), F.col("b"), F.col("c"))).first()[0] == want


def test_reading_range_edges(spark):
    rows = [(1, 10.0, True), (1, 9.9, False), (2, 49.9, True), (2, 50.0, False), (3, 0.0, False)]
    df = spark.createDataFrame(rows, "page int, y double, want boolean")
    got = df.select("want", G.in_reading_range(F.col("page"), F.col("y"), F.lit(1), F.lit(10.0), F.lit(2), F.lit(50.0)).alias("g")).collect()
    assert all(r["want"] == r["g"] for r in got)
    whole = df.select(G.in_reading_range(F.col("page"), F.col("y"), F.lit(1), F.lit(None).cast("double"), F.lit(2), F.lit(None).cast("double")).alias("g")).collect()
    assert [r["g"] for r in whole] == [True, True, True, True, False]


def test_three_overlap_ratios_differ(spark):
    a, b = F.array(*[F.lit(float(v)) for v in (0, 0, 10, 10)]), F.array(*[F.lit(float(v)) for v in (5, 0, 25, 10)])
    r = spark.range(1).select(G.overlap_by_smaller(a, b), G.overlap_by_own(a, b), G.overlap_by_image(a, b)).first()
    assert tuple(r) == (0.5, 0.5, 0.25)
