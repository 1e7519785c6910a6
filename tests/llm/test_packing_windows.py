"""Windows at a task's end: closed at least slack, with nothing padded."""

import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quirestone.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([16, 64, 128]), st.sampled_from([4, 16, 4096]))
def test_pieces_are_whole_and_windows_full(lengths, window, pool):
    docs = [(i, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate(lengths)]
    got = defaultdict(list)
    whole = defaultdict(list)
    for doc, start, ids, total, sequence, offset in packing.pieces(iter(docs), window, pool):
        assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + len(ids) // 4)) and total == lengths[doc]
        got[sequence].append((offset, len(ids) // 4))
        whole[doc].append((start, len(ids) // 4))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(whole[doc]):
            assert start == at
            at += length
        assert at == n
    part = 0
    for x in got.values():
        assert [o for o, _ in x] == np.cumsum([0, *(n for _, n in x)])[:-1].tolist()
        size = sum(n for _, n in x)
        assert size == window or size & (size - 1) == 0
        part += size if size < window else 0
    assert part < window


def test_few_documents_are_cut():
    r = random.Random(2)
    docs = [(i, bytes(4 * r.randrange(20, 900))) for i in range(3000)]
    pieces = list(packing.pieces(iter(docs)))
    assert len(pieces) - len(docs) < 20
