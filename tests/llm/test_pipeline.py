import os

import corpus_pipeline


def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    folder = os.fspath(tmp_path)
    now = docs.select(*names)
    now.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, folder)
        path = f"{folder}/{name}"
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen[name] = now
        if name != "packing":
            assert now.columns == names
    assert {53, 54, 55, 57} & {r["doc_id"] for r in seen["language"].collect()} == set()
    ids = {r["doc_id"] for r in seen["near_duplicates"].collect()}
    assert 50 in ids and not {51, 52} & ids and set(range(40)) <= ids
    assert seen["secrets"].count() == seen["near_duplicates"].count()
    assert {r["doc_id"] for r in seen["mixture"].collect()} <= ids
    want = sorted(map(tuple, seen["packing"].select("doc_id", "start", "length", "ids_crc32").collect()), key=str)
    assert sum(r[2] for r in want) > 0
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == {r["doc_id"] for r in seen["packing"].collect()}
