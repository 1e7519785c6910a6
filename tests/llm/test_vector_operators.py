import numpy as np
import pytest

from quirestone.llm import curves, graph
from quirestone.llm import product_quantisation as PQ

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[50:70] = x[50] + rng.normal(size=(20, 16)).astype(np.float32) * 0.05
    x[100:110] = x[100]
    x[120] = x[50] * 3
    out = [(i, v.tolist(), i % 4) for i, v in enumerate(x)]
    bad = [None, [], [0.0] * 16, [None, *[1.0] * 15], [float("nan")] * 16, [float("inf")] * 16, [1.0] * 3]
    return out + [(500 + 20 * i, b, None) for i, b in enumerate(bad)] + [(5, x[5].tolist(), 1)]


def plain(rows):
    ok = [(i, np.array(v, np.float64)) for i, v, _ in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    return [i for i, _ in ok], np.stack([v for _, v in ok])


def test_links_by_brute_force(spark, rows):
    ids, x = plain(rows)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.95
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(link)):
        p, q = sorted((find(ids[a]), find(ids[b])))
        root[q] = p
    want = {}
    for a, i in enumerate(ids):
        want[i] = (int(link[a].sum()) - 1, find(i))
    got = PQ.linked(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, c = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (n, c, r["vec_id"] == c)
    assert PQ.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_search_reaches_its_recall(spark, rows):
    ids, x = plain(rows)
    got = curves.search(spark.createDataFrame(rows, SCHEMA), k=10).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    queries = sorted({i for i in ids if i % 20 == 0})
    assert sorted(by) == queries
    hit = 0
    for q in queries:
        s = x @ x[ids.index(q)]
        order = sorted({(-v, i) for v, i in zip(s, ids) if i != q})[:10]
        mine = [by[q][k][0] for k in range(1, 11)]
        hit += len({i for _, i in order} & set(mine))
        assert all(by[q][k][1] == pytest.approx(float(x[ids.index(by[q][k][0])] @ x[ids.index(q)])) for k in by[q])
    assert hit >= 0.9 * 10 * len(queries)
    few = curves.search(spark.createDataFrame(rows[:5], SCHEMA), k=10).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] and len(few) == 4
    assert curves.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hilbert_neighbours_are_neighbours():
    n = 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << n)] * 2, indexing="ij"), -1).reshape(-1, 2)
    key = curves.hilbert(cells, n)
    assert sorted(key.tolist()) == list(range(1 << 2 * n))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}
