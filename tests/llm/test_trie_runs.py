"""Runs of successors, and pairs of numbers that don't fit into one."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirestone.llm import ngram_lm
from quirestone.llm.elias_fano import Runs, Sequence, encode, encode_runs, select_in_word


@settings(max_examples=150, deadline=None)
@given(st.sets(st.tuples(st.integers(5, 40), st.integers(0, 200)), min_size=1, max_size=120), st.sampled_from([1, 10**9]))
def test_a_word_is_found_in_its_own_run_only(pairs, scale):
    at = sorted((c, w * scale) for c, w in pairs)
    c, w = (np.array(x, np.int64) for x in zip(*at))
    runs = Runs(encode_runs(c, w))
    ask = [(c, w) for c in range(3, 43) for w in sorted({w for _, w in at} | {0, 1, 200 * scale})]
    place = {x: i for i, x in enumerate(at)}
    got = runs.find(*(np.array(x, np.int64) for x in zip(*ask)))
    assert got.tolist() == [place.get(x, -1) for x in ask]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=300))
def test_places_of_a_sequence_that_repeats(keys):
    k = np.array(sorted(keys), np.int64)
    assert Sequence(encode(k)).at(np.arange(len(k))).tolist() == k.tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**50), st.integers(0, 2**40)), max_size=60), st.sampled_from([2**50 + 1, 2**62]))
def test_pairs_beyond_one_number(pairs, contexts):
    pairs = pairs + pairs[:5]
    c, w = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    uc, uw, back = ngram_lm.unique_pairs(c, w, contexts)
    want = sorted(set(pairs))
    assert list(zip(uc.tolist(), uw.tolist())) == want and [want[i] for i in back] == pairs
    counts = ngram_lm.counted_pairs(c, w, contexts, None)
    assert list(counts.columns) == ["context", "word", "n"] and counts["n"].tolist() == [pairs.count(x) for x in want]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 2**64 - 1), st.data())
def test_ones_of_a_word(x, data):
    places = [i for i in range(64) if x >> i & 1]
    r = data.draw(st.integers(0, len(places) - 1))
    assert select_in_word(np.array([x], np.uint64), np.array([r])).tolist() == [places[r]]


def test_counts_travel_in_either_form(spark, monkeypatch, docs):
    rows = docs.selectExpr("cast(doc_id as string) as doc_id", "text", "doc_id % 3 = 0 or doc_id is null as held_out").filter("doc_id <> 56")

    def entries():
        trie, encoded = ngram_lm.train(rows)
        return [{tuple(r) for r in ngram_lm._gram_counts(encoded.filter("not held_out").select("ids"), trie, n).collect()} for n in (2, 3)]

    one = entries()
    monkeypatch.setattr(ngram_lm, "fits", lambda contexts, vocabulary: False)
    assert entries() == one and len(one[0]) > 100


def test_shards_may_split_a_context(spark, monkeypatch):
    entries = [(c, w, 1) for c in (0, 1, 2, 7) for w in range(0, 40 if c == 1 else 6, 2)]
    monkeypatch.setattr(ngram_lm, "SHARD_KEYS", 5)
    trie = ngram_lm.Trie(ngram_lm.fresh_path(spark, "lm-test"), vocabulary=50)
    trie.levels = [ngram_lm.Level(n=8)]
    lv = ngram_lm._write_level(spark.createDataFrame(entries, ngram_lm.PAIRS), len(entries), trie, lambda c, w, n: {})
    trie.levels.append(lv)
    assert len(lv.names) > 3 and sum(c == 1 for c in lv.contexts) >= 2
    reader = ngram_lm.Reader.__new__(ngram_lm.Reader)
    reader.trie = trie
    place = {(c, w): i for i, (c, w, _) in enumerate(sorted(entries))}
    ask = [(c, w) for c in range(9) for w in range(42)]
    got = reader.ranks(1, *(np.array(x, np.int64) for x in zip(*ask)))
    assert got.tolist() == [place.get(x, -1) for x in ask]
    got = reader.ranks(1, *(np.array(x, np.int64) for x in zip(*(ask * 4))))
    assert got.tolist() == [place.get(x, -1) for x in ask * 4]
