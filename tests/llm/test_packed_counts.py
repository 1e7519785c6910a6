"""Tokens hashed side by side, and counts that travel packed, against plain ones."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirestone.llm import ngram_lm

PARTS = [" ", "\n", "\t\x0b", "\x0c\r", "\x00", "\x00\x00", "a", "A", "b", "É", "é", "\x85", "\xa0", "\x1c", "漢字", "x" * 7, "x" * 8, "x" * 9, "y" * 63, "y" * 64, "y" * 200, "\ud800"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=8))
def test_tokens_share_a_hash_if_they_are_equal(texts):
    hashes, n = ngram_lm.token_hashes(texts)
    want = [[*ngram_lm.tokens(t), None] for t in texts]
    assert n.tolist() == [len(x) for x in want]
    flat = [w for x in want for w in x]
    pairs = set(zip(flat, hashes.tolist()))
    assert len(pairs) == len(set(flat)) == len({h for _, h in pairs})
    assert all(h >= 0 and (h == ngram_lm.END_HASH) == (w is None) for w, h in pairs)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 63), st.integers(1, 40), st.data())
def test_packed_counts_add_up(bits, parts, data):
    batches = data.draw(st.lists(st.lists(st.integers(0, (1 << bits) - 1) | st.sampled_from([0, (1 << bits) - 1]), max_size=40), max_size=4))
    rows = [r for b in batches for r in ngram_lm.packed_counts(np.array(b, np.int64), bits, parts).itertuples(index=False)]
    assert all(0 <= r.part < parts for r in rows) and len(rows) <= parts * len(batches)
    got: dict[int, int] = {}
    for p in {r.part for r in rows}:
        keys, n = ngram_lm.unpacked_counts([(r.once, r.often, r.n) for r in rows if r.part == p], bits)
        assert not got.keys() & set(keys.tolist())
        got |= dict(zip(keys.tolist(), n.tolist()))
    assert got == Counter(k for b in batches for k in b)


def test_no_row_for_each_pair_of_a_task(spark, docs, monkeypatch):
    rows = docs.selectExpr("cast(doc_id as string) as doc_id", "text", "false as held_out")
    trie, encoded = ngram_lm.train(rows)
    counts = ngram_lm._gram_counts(encoded.select("ids"), trie, 2)
    assert "HashAggregate" not in counts._jdf.queryExecution().toString()
    want = {tuple(r) for r in counts.collect()}
    monkeypatch.setattr(ngram_lm, "FLUSH", 500)
    monkeypatch.setattr(ngram_lm, "SUMMED", 1000)
    monkeypatch.setattr(ngram_lm, "CUT", 100)
    monkeypatch.setattr(ngram_lm, "WORDS", 20)
    trie, encoded = ngram_lm.train(rows)
    assert {tuple(r) for r in ngram_lm._gram_counts(encoded.select("ids"), trie, 2).collect()} == want and len(want) > 1000
    assert {tuple(r) for r in ngram_lm._gram_counts(encoded.select("ids"), trie, 2, 2).collect()} == {r for r in want if r[2] >= 2}
