"""Near-duplicates against brute force where the nearest candidate of a component isn't the one that links."""

import random
from collections import Counter

from quirestone.llm import minhash


def cluster(seed, n=14, size=240):
    r = random.Random(seed)
    words = lambda k: ["".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(k)]
    base, out = words(size), []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(2, 5)):
            w[r.randrange(size)] = words(1)[0]
        out.append(" ".join(w))
    return out


def brute(texts):
    sets = [Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if (sets[i] & sets[j]).total() >= 0.8 * (sets[i] | sets[j]).total():
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def test_partners_after_the_nearest_are_tried(spark):
    rows, want = [], {}
    for c, seed in enumerate((0, 13, 20, 22, 28)):
        texts = cluster(seed)
        rows += [(100 * c + i, t) for i, t in enumerate(texts)]
        want |= {100 * c + i: 100 * c + x for i, x in enumerate(brute(texts))}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in minhash.groups(docs).collect()} == want


def test_texts_under_null_and_repeated_ids_are_nodes_of_their_own(spark):
    a, b, c, d = (cluster(seed, 1)[0] for seed in (101, 102, 103, 104))
    near = lambda t: "changed " + t.split(" ", 1)[1]
    rows = [(None, a), (None, b), (None, b), (5, near(a)), (6, near(b)), (7, c), (7, d), (7, d), (8, near(d)), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.groups(docs).collect()}
    assert got == {(None, None, True), (5, None, False), (6, None, False), (7, 7, True), (8, 7, False)}
    kept = [(r["doc_id"], r["text"]) for r in minhash.deduplicated_documents(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(None, a), (None, b), (7, c), (7, d), (None, None)], key=repr)


def test_how_often_runs_occur_counts(spark):
    line, other = (cluster(seed, 1, 12)[0] for seed in (201, 202))
    texts = [" ".join([line] * 10), " ".join([line] * 9), " ".join([line] * 3), " ".join([line] * 10 + [other]), " ".join([line] * 2 + [other] * 8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(texts)
    assert want == [0, 0, 2, 0, 4]
    assert {r["doc_id"]: r["component_id"] for r in minhash.groups(docs).collect()} == dict(enumerate(want))


def test_large_buckets_in_tiles(spark, monkeypatch):
    whole = minhash._tiles
    monkeypatch.setattr(minhash, "_tiles", lambda u, d, name, most: whole(u, d, name, most, rows=8))
    rows, want = [], {}
    for c, seed in enumerate((0, 13, 20)):
        texts = cluster(seed, 40)
        rows += [(100 * c + i, t) for i, t in enumerate(texts)]
        want |= {100 * c + i: 100 * c + x for i, x in enumerate(brute(texts))}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in minhash.groups(docs).collect()} == want


def test_products_count_shared_units():
    texts = ["a b c d e f g " * 4, "a b c d e f g " * 3, "x y", "x y", "", "a b c d e f q r s t"] + cluster(3, 6)
    u = [minhash.units(t) for t in texts]
    bag = [Counter(tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))) if t else Counter() for t in texts]
    want = [[(x & y).total() for y in bag[2:]] for x in bag]
    assert minhash.shared_units(u, u[2:], 7).tolist() == minhash.shared_units(u, u[2:]).tolist() == want
    assert [len(x) for x in u] == [x.total() for x in bag]
