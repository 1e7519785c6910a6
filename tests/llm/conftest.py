import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string"


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8))) for _ in range(n))


def rows():
    out = []
    for i in range(40):
        out.append((i, words(i, 30 + i), "en" if i % 2 else "de", f"s{i % 3}"))
    base = words(100, 200)
    near = base.split()
    near[7] = "changed"
    out += [(50, base, "en", "s0"), (51, base.upper(), "en", "s1"), (52, " ".join(near), "en", None), (53, None, None, None), (54, "", "en", "s0"), (55, " \n\t", "en", "s0")]
    out += [(56, words(7, 6000), "de", "s0"), (57, "12 34 !!", "en", "s2"), (50, base, "en", "s0"), (None, "null id text", None, "s1"), (58, "漢字 かな é̂ nbsp half ½5 <|endoftext|> it's", "en", "s1")]
    return [(*r, None if r[1] is None else len(r[1]), 7, "clash") for r in out]


@pytest.fixture(scope="session")
def data():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
