"""Chunks of many texts cut and looked up side by side, against whole texts encoded alone."""

import random

import public_tokenizers
import pytest

from quirestone.llm import encoding
from quirestone.llm.encoding import FINE_DROPPED, ChunkEncoder, fine_spans

PARTS = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "'", "'s", "'LL", "''t", "word", "Wörd", "naïve", "é", "×", "÷", "ė", "12", "_", "...", "<", "|", "x" * 50, "y" * 70, "A", "b", "ſ", "ȿ"]
ODD = ["İ", "Ⱥ", "Ⱦ", "漢字", "½", "\xa0", "́", "—", "ёлка", "<|", "\x01", "﻿"]


@pytest.fixture(scope="module")
def word():
    return ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))


def texts(seed, parts, n=1500):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_spans_are_what_the_pattern_finds():
    for t in texts(1, PARTS):
        low = t.lower()
        data = f" {low} ".encode()
        assert [data[a:b].decode() for a, b in zip(*(x.tolist() for x in fine_spans(data)))] == FINE_DROPPED.findall(low)


@pytest.mark.parametrize("side", [1, 300, 4_000_000])
def test_ids_are_those_of_whole_texts(word, side, monkeypatch):
    monkeypatch.setattr(encoding, "SIDE_BY_SIDE", side)
    some = texts(side, PARTS + ODD) + texts(side, PARTS)
    assert word.batch(some) == [word._whole(t) for t in some]
    assert word.batch([]) == [] and word.batch(["", " \n"]) == [b"", b""]


def test_capitals_whose_small_letters_are_not_latin(word):
    for t in ("aȺb", "aȾb", "İx ȺȾ it's"):
        assert word.ids(t) == word._whole(t)


def test_new_chunks_share_an_encoding(word):
    assert word.mark is not None and ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json")).mark is None
    word.mark = word.tokenizer.encode("the", add_special_tokens=False).ids[0]  # a mark that breaks the count
    try:
        assert word.batch(["over thehills the end"]) == [word._whole("over thehills the end")]
    finally:
        word.mark = word._own_mark()
