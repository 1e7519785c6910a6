"""Cells and texts: equal ones are compared once, and ids on several pages belong to their first table."""

from quirestone.operators import packaging as P


def sides(spark):
    tables = [(0, f"t{i:03}", 1, [0.0, 10.0, 100.0, 90.0], [["Anchor bolt, M20"], [f"own cell {i}"]]) for i in range(40)] + [(0, "a", 2, [0.0, 0.0, 9.0, 99.0], [["Second page"]]), (1, "t000", 1, [0.0, 0.0, 9.0, 50.0], [["nothing here"]])]
    texts = [(0, f"i{i}", 1, "Anchor bolt M20", [0.0, 20.0 + i, 5.0, 30.0 + i]) for i in range(50)]
    texts += [(0, "two", 1, "own cell 7", [0.0, 60.0, 5.0, 70.0]), (0, "two", 2, "see Second page", [0.0, 12.0, 5.0, 85.0]), (0, "two", 3, "no table", [0.0, 5.0, 5.0, 97.0]), (0, "bare", 1, None, [0.0, 0.0, 1.0, 1.0]), (0, "short", 1, "M20", [0.0, 0.0, 1.0, 1.0]), (1, "x", 1, "else", [0.0, 0.0, 1.0, 1.0])]
    return spark.createDataFrame(texts, "doc_id long, item_id string, page_no long, text string, bbox array<double>"), spark.createDataFrame(tables, "doc_id long, table_id string, page_no long, bbox array<double>, rows array<array<string>>")


def test_first_table_of_each_text(spark):
    got = {(r["doc_id"], r["item_id"]): r["table_id"] for r in P.cell_texts(*sides(spark)).collect()}
    assert got == {(0, f"i{i}"): "t000" for i in range(50)} | {(0, "two"): "a"}


def test_bounds(spark):
    texts, tables = sides(spark)
    got = {(r["doc_id"], r["table_id"]): (r["top"], r["bottom"]) for r in P.table_bounds(tables, texts).collect()}
    assert got[0, "t000"] == (20.0, 79.0) and got[0, "a"] == (5.0, 97.0) and got[0, "t007"] == (10.0, 90.0) and got[1, "t000"] == (0.0, 50.0) and len(got) == 42


def test_pairs_of_equal_texts_and_cells_are_made_once(spark):
    texts, tables = sides(spark)
    got = P._cell_tables(texts, tables)
    again = P._cell_tables(texts.unionAll(texts).unionAll(texts), tables)
    assert got.count() == texts.count() and again.count() == 3 * texts.count()
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains" if "Contains" in plan else "contains") > 0 and plan.count("Aggregate") >= 3
