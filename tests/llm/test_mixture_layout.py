"""The layout of the mixture: by shard, and within it by place."""

import random

from quirestone.llm import mixing


def test_mixture_is_laid_out_by_shard_and_place(spark):
    r = random.Random(5)
    rows = [(i if i % 9 else None, " ".join("w" for _ in range(r.randrange(1, 30))), "abc"[i % 7 % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    draws = [d for x in mixing.mix(docs, block_docs=8).collect() for d in zip(x["shards"], x["places"], [x["doc_id"]] * len(x["shards"]), [x["source"]] * len(x["shards"]))]
    want = [(i, s) for _, _, i, s in sorted(draws, key=lambda d: d[:2])]
    out = mixing.mixed_documents(docs, block_docs=8).collect()
    assert [(x["doc_id"], x["source"]) for x in out] == want
    assert len({d[0] for d in draws}) == 16
