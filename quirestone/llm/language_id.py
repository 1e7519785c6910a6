"""Language identification by words first, backing off to shorter and shorter character n-grams.

Training takes a bounded sample: of each language, at most ``sample_rows`` documents with text outside the
held-out fold, those of smallest hash of id and text (all, if there are fewer), so a rare language is learned
from as many documents as a frequent one. Word and n-gram counts per language are summed in Spark; words seen
at least twice and n-grams seen at least ``least`` times form the model. ``sample_rows`` is the classifier's
one bound; prediction reads every whole text.

A known word adds its smoothed log frequency in each language. An unseen word is walked from its first
character: at each place the longest known n-gram (5 to 1 characters, word boundaries marked) adds its
log frequency plus ``log(0.4)`` for each step down, scaled so that a word counts as one observation.
The score is the posterior of the best language under equal priors.

Defined cases: null text, and text without a letter, give ``und`` with score 0; with no labelled rows
at all every text gives ``und``; ties go to the language first in code point order.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, doc_hash, even, materialize, only_cache, tidied

WORDS = re.compile(r"[^\W\d_]+")
LONGEST = 5
STEP = math.log(0.4)
#: Steps of a document's draw for the sample.
DRAWS = 1 << 50


def grams(word: str) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(marked) - n + 1)]


class Model:
    """Rows of log frequencies by language: known words first, then a bounded cache of unseen words."""

    def __init__(self, words: list[tuple[str, str, int]], pieces: list[tuple[str, str, int]], cache_words: int = 250_000):
        self.langs = sorted({lang for _, lang, _ in words} | {lang for _, lang, _ in pieces})
        known, self.known = self._table(words, 0.05)
        grams_at, self.pieces = self._table(pieces, 0.5)
        # a step down from the longest n-gram costs STEP, whatever the place in the word
        self.grams = grams_at + STEP * np.array([[LONGEST - len(g)] for g in self.pieces] or np.zeros((0, 1)))
        self.rows = np.concatenate([known, np.zeros((cache_words, len(self.langs)))])
        self.at: dict[str, int] = dict(self.known)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": self.rows[: len(self.known)], "at": None, "room": len(self.rows)}

    def __setstate__(self, state: dict) -> None:
        rows, room = state.pop("rows"), state.pop("room")
        self.__dict__.update(state)
        self.rows = np.concatenate([rows, np.zeros((room - len(rows), len(self.langs)))])
        self.at = dict(self.known)

    def reset(self) -> None:
        """Forget the unseen words."""
        self.at = dict(self.known)

    def _table(self, entries, alpha: float) -> tuple[np.ndarray, dict[str, int]]:
        lang_at = {lang: i for i, lang in enumerate(self.langs)}
        at: dict[str, int] = {}
        for text, _, _ in entries:
            at.setdefault(text, len(at))
        counts = np.zeros((len(at), len(self.langs)))
        for text, lang, n in entries:
            counts[at[text], lang_at[lang]] += n
        return np.log((counts + alpha) / (counts.sum(0) + alpha * max(len(at), 1))), at

    def backed_off(self, word: str) -> np.ndarray:
        marked, get, found = f"<{word}>", self.pieces.get, []
        for i in range(len(marked)):
            for end in range(min(i + LONGEST, len(marked)), i, -1):
                g = get(marked[i:end])
                if g is not None:
                    found.append(g)
                    break
        return self.grams[found].sum(0) / len(found) if found else np.zeros(len(self.langs))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = WORDS.findall(text.lower()) if text else []
        # \w has numerals such as superscripts that are no letters; the first real word ends the search
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        at = list(map(self.at.get, words))
        if None in at:
            new = {w for w, a in zip(words, at) if a is None}
            if len(self.at) + len(new) > len(self.rows):
                self.at = dict(self.known)
                new |= set(words) - self.known.keys()
                if len(self.at) + len(new) > len(self.rows):  # a text with more unseen words than the cache holds
                    self.rows = np.concatenate([self.rows, np.zeros((len(new), len(self.langs)))])
            for w in new:
                i = self.at[w] = len(self.at)
                self.rows[i] = self.backed_off(w)
            at = list(map(self.at.__getitem__, words))
        total = self.rows[at].sum(0)
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def sampled(docs: DataFrame, folds: int, sample_rows: int) -> DataFrame:
    """(lang, text) of at most ``sample_rows`` documents of each language outside the held-out fold, chosen by a hash of id and text."""
    rows = docs.select(
        doc_hash("doc_id").alias("h"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(DRAWS)).alias("draw"),
    ).filter("lang is not null and text is not null")
    rows = rows.filter(F.col("h") % folds != 0)
    # half as many again as are wanted, and some more, pass the first sieve; the exact bound then cuts each language
    rates = rows.groupBy("lang").agg((F.lit((1.5 * sample_rows + 50) * DRAWS) / F.count(F.lit(1))).alias("below"))
    rates = materialize(rates, "lang-rates")
    first = Window.partitionBy("lang").orderBy("draw", "text")
    few = rows.join(bounded(rates, rates.count()), "lang").filter(F.col("draw") < F.col("below")).select("lang", "draw", "text")
    return few.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_rows).select("lang", "text")


def train(docs: DataFrame, folds: int = 5, sample_rows: int = 1000, least: int = 3) -> Model:
    """Fit on documents whose id hash modulo ``folds`` isn't 0; see the module text for the bound."""
    rows = sampled(docs, folds, sample_rows)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = Counter()
            for lang, text in zip(pdf["lang"], pdf["text"]):
                words.update((lang, w) for w in WORDS.findall((text or "").lower()))
            pieces: Counter = Counter()
            for (lang, w), n in words.items():
                for g in grams(w):
                    pieces[lang, g] += n
            got = [(0, lang, w, n) for (lang, w), n in words.items()] + [(1, lang, g, n) for (lang, g), n in pieces.items()]
            yield pd.DataFrame(got, columns=["kind", "lang", "gram", "n"])

    counts = rows.mapInPandas(count, "kind int, lang string, gram string, n long").groupBy("kind", "lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.filter(F.col("n") >= F.when(F.col("kind") == 0, 2).otherwise(least)).toPandas()
    counts = counts.sort_values(["n", "kind", "lang", "gram"], ascending=[False, True, True, True])
    entries = {k: list(g[["gram", "lang", "n"]].itertuples(index=False, name=None)) for k, g in counts.groupby("kind")}
    return Model(entries.get(0, []), entries.get(1, []))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The input rows with ``lang_pred`` and ``score`` added; only the text is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        only_cache("language", m.reset)
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_quirestone_lang", label(F.col("text").cast("string"))).select(
        *docs.columns, F.col("_quirestone_lang.lang_pred").alias("lang_pred"), F.col("_quirestone_lang.score").alias("score")
    )


@tidied
def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    model = train(docs)
    narrow = even(docs.select("doc_id", "text"))
    return predict(narrow, model).select("doc_id", (doc_hash("doc_id") % 5 == 0).alias("held_out"), "lang_pred", "score")


@tidied
def kept_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents with a language: ``und`` and posteriors under ``least`` go."""
    names = docs.columns
    got = predict(docs.select(*[F.col(c).alias(f"in_{c}") for c in names], "text"), train(docs))
    return got.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*[F.col(f"in_{c}").alias(c) for c in names])
