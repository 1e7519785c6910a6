"""Chunks encoded together, against whole texts encoded alone."""

import random

import public_tokenizers
import pytest

from quirestone.llm.encoding import ChunkEncoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_texts_have_their_own_ids(name):
    enc = ChunkEncoder(public_tokenizers.path(name))
    assert (enc.line is not None) == name.startswith("byte")
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\x0b", "'", "'s", "'ll", "word", "Wörd", "naïve", "漢字", "é", "12", "½", "_", "...", "<", "|", "<|", "x" * 50, "\xa0", "́", "—", "ёлка", "\ud800"[:0], "A", "b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert enc.batch(texts) == [enc._whole(t) for t in texts]


def test_a_text_that_breaks_the_count_falls_back():
    enc = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    enc.line = enc.tokenizer.encode(" the", add_special_tokens=False).ids[0]
    assert enc.batch(["over the hill, the end"]) == [enc._whole("over the hill, the end")]
