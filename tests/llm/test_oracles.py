"""Queries that SQL can express, against DuckDB."""

import duckdb
import numpy as np
import pytest

from quirestone.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs):
    out = tmp_path_factory.mktemp("oracle")
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(2).write.parquet(f"{out}/documents.parquet")
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)).astype(np.float32)
    x[10:40] = x[10] + 0.08 * rng.normal(size=(30, 12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, []), (402, [0.0] * 12), (403, [float("nan")] * 12), (404, [None] * 12)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_is_its_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, str(folder))
    assert sorted(got.columns) == sorted(names)
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)
