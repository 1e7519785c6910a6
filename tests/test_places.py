"""First boxes met against all pairs by the Column functions, with missing and odd coordinates, equal boxes and ids on two pages."""

import random

from pyspark.sql import functions as F

from quirestone.functions import geometry as G
from quirestone.operators import masks as M
from quirestone.operators import places as P
from quirestone.operators import tables as TB

NAN, INF = float("nan"), float("inf")


def some_boxes(spark, seed: int, name: str, odd: bool):
    r = random.Random(seed)
    rows = []
    for i in range(260):
        x, y = r.randrange(0, 200, 10), r.randrange(0, 300, 15)
        b = [float(x), float(y), float(x + r.randrange(0, 90, 6)), float(y + r.randrange(0, 60, 6))]
        if odd and r.random() < 0.3:
            b[r.randrange(4)] = r.choice([None, NAN, INF, -INF])
        rows.append((None if odd and i % 50 == 0 else i % 2, f"{name}{i % 250}", i % 3, None if odd and i % 40 == 1 else b, i * 7 % 260))
    return spark.createDataFrame(rows, "doc_id long, region_id string, page_no int, bbox array<double>, ord int")


def check(spark, odd: bool):
    a, b = some_boxes(spark, 1, "a", odd).cache(), some_boxes(spark, 2, "b", odd).cache()
    x, y = F.col("bbox"), F.col("box")
    pairs = a.drop("ord").join(b.select("doc_id", "page_no", F.col("bbox").alias("box"), F.col("region_id").alias("b_id"), "ord"), ["doc_id", "page_no"]).cache()

    def ids(df, *c):
        return sorted(map(tuple, df.select(*c).collect()), key=str)

    for least, both in ((0.15, False), (0.8, True)):
        share = G.overlap_by_own(x, y) >= least
        hit = pairs.filter(G.center_inside(x, y) & share if both else G.center_inside(x, y) | share)
        want = hit.groupBy("doc_id", "region_id").agg(F.min_by("b_id", "ord").alias("b_id"))
        got = M.in_regions(a.withColumnRenamed("region_id", "item_id"), b, least, both)
        assert ids(got, "doc_id", "item_id", "region_id") == ids(want, "doc_id", "region_id", "b_id") != []
    inside = (G.overlap_by_own(y, x) >= 0.8) & (G.area(y) < 0.8 * G.area(x))
    bad = pairs.filter(~inside & ((G.overlap_by_smaller(x, y) >= 0.65) | G.center_inside(x, y) | (G.overlap_by_own(x, y) >= 0.3)))
    want = a.join(bad.select("doc_id", "region_id").distinct(), ["doc_id", "region_id"], "left_anti")
    assert ids(TB.drop_image_regions(a, b), "doc_id", "region_id") == ids(want, "doc_id", "region_id")

    same = pairs.filter(G.overlap_by_smaller(x, y) >= 0.8)
    rows = F.array(F.array("region_id"))
    empty = F.array().cast("array<array<string>>")
    model = a.select("doc_id", F.col("region_id").alias("table_id"), "page_no", "bbox", empty.alias("rows"))
    native = b.select("doc_id", F.col("region_id").alias("table_id"), "page_no", "bbox", rows.alias("rows"))
    best = same.groupBy("doc_id", "region_id").agg(F.min("b_id").alias("b_id"))
    filled = a.join(best, ["doc_id", "region_id"], "left").select("doc_id", "region_id", "b_id")
    rest = b.join(same.select("doc_id", F.col("b_id").alias("region_id")).distinct(), ["doc_id", "region_id"], "left_anti").select("doc_id", "region_id", F.col("region_id").alias("b_id"))
    got = TB.merge_sources(model, native).select("doc_id", "table_id", F.try_element_at(F.flatten("rows"), F.lit(1)).alias("cell"))
    assert ids(got, "doc_id", "table_id", "cell") == ids(filled.unionAll(rest), "doc_id", "region_id", "b_id")


def test_plain_boxes(spark):
    check(spark, False)


def test_missing_and_odd_coordinates(spark):
    check(spark, True)


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 7)
    check(spark, False)


def test_drop_image_regions_makes_no_pairs(spark):
    a = some_boxes(spark, 1, "a", False)
    plan = TB.drop_image_regions(a, a)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Inner" not in plan


def test_in_regions_makes_no_pairs(spark):
    a = some_boxes(spark, 1, "a", False)
    plan = M.in_regions(a.withColumnRenamed("region_id", "item_id"), a, 0.15)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Inner" not in plan


def test_merge_sources_makes_no_pairs(spark):
    a = some_boxes(spark, 1, "a", False)
    plan = TB.merge_sources(*[a.withColumn("table_id", F.col("region_id")).withColumn("rows", F.array(F.array("region_id")))] * 2)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Inner" not in plan


def test_overlapping_pairs_are_all_there_and_no_join_makes_them(spark):
    for odd in (False, True):
        a = some_boxes(spark, 3, "a", odd).cache()
        x, y = F.col("bbox"), F.col("box")
        other = a.select("doc_id", "page_no", F.col("bbox").alias("box"), F.col("region_id").alias("b_id"))
        want = a.join(other, ["doc_id", "page_no"]).filter((F.col("region_id") < F.col("b_id")) & (G.overlap_by_smaller(x, y) >= 0.65))
        want = want.select("doc_id", "region_id", "b_id", G.overlap_by_smaller(x, y), G.overlap_by_own(x, y))
        got = P.overlaps(a, 0.65)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect()))) != []
        assert "Join" not in got._jdf.queryExecution().toString()
