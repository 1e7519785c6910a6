"""Ids over 2^53 beside null ids come out as they went in."""

import numpy as np
import public_tokenizers
import pytest

from quirestone.llm import binary_records, ngram_lm, packing, secret_scan, token_counts

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
IDS = [2**53 + 1, None, 2**53 + 3, None, -(2**62) - 1, 7]
OPERATORS = {
    "token_counts": lambda d: token_counts.count(d, BYTE), "secret_scan": secret_scan.scan, "packing": lambda d: packing.pack(d, WORD),
    "binary_records": lambda d: binary_records.round_trip(d, BYTE), "ngram_lm": ngram_lm.scored,
}


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([(i, f"text number {n} of few") for n, i in enumerate(IDS)], "doc_id long, text string").coalesce(1)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_large_ids_beside_null_ones(few, name):
    got = OPERATORS[name](few).collect()
    assert sorted({(r["doc_id"] is not None, r["doc_id"] or 0) for r in got}) == sorted({(i is not None, i or 0) for i in IDS})
    if name == "binary_records":
        order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
        assert order == sorted(IDS, key=lambda i: (i is not None, i or 0))


def test_files_roll_over_and_are_read_by_index(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(50)], "doc_id long, text string").coalesce(1)
    folder = f"{tmp_path}/records"
    manifest = binary_records.write(docs, BYTE, 2, folder, roll=1500).collect()
    assert len(manifest) == 5 and sum(r["n_records"] for r in manifest) == 50
    files, root = binary_records.file_system(folder)
    seen = []
    for r in sorted(manifest, key=lambda r: (r["shard"], r["part"])):
        got = list(binary_records.records(files, root, r["name"], r["n_records"], chunk=400))
        assert [x[1] for x in got] == np.cumsum([0, *(len(x[2]) for x in got)])[:-1].tolist()
        seen += [x[0] for x in got]
    assert seen == list(range(50))
