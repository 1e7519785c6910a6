"""BM25 scores of (query, document) pairs stay in the tasks; only the best of each task travel."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quirestone.functions import text as T
from quirestone.operators import retrieval as R

DOCS, QUERIES = "doc_id {}, tokens array<string>", "query_id long, tokens array<string>"


def by_hand(docs, queries, k):
    """As in the SQL of ``bm25_topk``; an id that is null meets no score and comes last."""
    n, avgdl = len(docs), sum(len(x) for _, x in docs) / len(docs)
    df = Counter(w for _, x in docs for w in set(x))
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(raw.values()) / len(raw)
    out = {}
    for q, asked in queries:
        rows = []
        for i, x in docs:
            tf = Counter(x)
            s = sum((0.25 * mean if raw[w] < 0 else raw[w]) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(x) / avgdl)) for w in asked if w in tf)
            rows.append((-round(0.0 if i is None else s, 9), i is None, i if i is not None else 0, 0.0 if i is None else s))
        out[q] = [(None if none else i, pytest.approx(s)) for _, none, i, s in sorted(rows)[:k]]
    return out


def ranked(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize("cells", [R.CELLS, 40])
def test_bm25_in_tasks_is_that_by_hand_and_shuffles_no_pairs(spark, monkeypatch, cells):
    monkeypatch.setattr(R, "CELLS", cells)
    draw = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    docs = [(draw.randrange(10**6) * 1000 + i, [draw.choice(words[: draw.choice((3, 30))]) for _ in range(draw.choice((0, 1, 5, 40)))]) for i in range(300)]
    docs += [(10**12 + i, docs[0][1]) for i in range(7)] + [(2**53 + 1, ["rare", "w1"]), (2**53, ["rare", "w1"]), (None, ["rare"]), (None, ["w2"])]
    queries = [(q, [draw.choice(words) for _ in range(draw.choice((1, 2, 6)))]) for q in range(12)] + [(12, []), (13, ["nowhere"]), (14, ["rare", "rare"]), (15, ["w0"])]
    got = R.bm25(spark.createDataFrame(docs, DOCS.format("long")).repartition(3), spark.createDataFrame(queries, QUERIES), 5)
    assert ranked(got) == by_hand(docs, queries, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "HashAggregate" not in plan and "SortMergeJoin" not in plan


def test_text_ids_small_tables_and_ids_that_repeat(spark):
    words = [("b", ["x", "y"]), ("a", ["x", "y"]), ("c", ["z"])]
    queries = spark.createDataFrame([(0, ["x"]), (1, ["z", "x"])], QUERIES)
    got = ranked(R.bm25(spark.createDataFrame(words, DOCS.format("string")), queries, 5))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: ["c", "a", "b"], 1: ["c", "a", "b"]}
    twice = spark.createDataFrame([(1, ["x"]), (1, ["x"]), (2, ["y"]), (3, ["z"])], DOCS.format("long"))
    assert ranked(R.bm25(twice, queries, 2)) == ranked(R.joined_bm25(twice, queries, 2))
    assert R.bm25(twice.limit(0), queries, 2).collect() == [] and R.bm25(twice, queries.limit(0), 2).collect() == []


def test_tokens_extract_runs_once(spark):
    texts = ["Ａｂ１　ｘ", "ﬁx 中文字abc", "一", "", None, "～！", "鿿a一 Ω É"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i long, t string").select("i", T.tokens(F.col("t")).alias("k"))
    assert [r["k"] for r in df.orderBy("i").collect()] == [["ab1", "x"], ["fix", "中文字", "中文", "文字", "abc"], ["一"], [], [], [], ["鿿", "a", "一"]]
    assert "exists(" not in df._jdf.queryExecution().toString()
