"""Token counts by offset-mapped attribution.

Each whole document is encoded once. The tokens' character spans are interval-joined (binary search in
the sorted section starts) to sections that tile the text, by default its lines, each with its line
break. A token inside one section counts there. A token that crosses a boundary is allocated by an
explicit rule: ``majority`` (most of its characters; ties to the earlier section, the default),
``start`` (its first character) or ``fraction`` (shares by characters).

The join stays in the task that encoded the document, so no token is ever shuffled, and memory is bound
by one Arrow batch of documents.

Defined cases: null or empty text is one section (0, 0) with no tokens; rows that repeat give rows that
repeat; the counts of a document's sections add up to its tokens under every rule.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import even, long_ids, texts_by_id
from .encoding import encoder

LINE = re.compile(r"[^\n]*\n|[^\n]+")
RULES = ("majority", "start", "fraction")


def line_starts(text: str) -> np.ndarray:
    """Starts of the lines of ``text``, then its length."""
    ends = np.cumsum([len(x) for x in LINE.findall(text)], dtype=np.int64) if text else np.zeros(1, np.int64)
    return np.concatenate([[0], ends]).astype(np.int64)


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section (float under ``fraction``, else whole) and how many of its own cross its end."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    n = len(bounds) - 1
    tokens, crossing = np.zeros(n, np.float64), np.zeros(n, np.int64)
    if n and len(starts):
        opens = bounds[:-1]
        first = np.clip(np.searchsorted(opens, starts, "right") - 1, 0, n - 1)
        last = np.maximum(first, np.clip(np.searchsorted(opens, np.maximum(ends - 1, starts), "right") - 1, 0, n - 1))
        inside = first == last
        tokens += np.bincount(first[inside], minlength=n)
        for i in np.flatnonzero(~inside):
            a, b = first[i], last[i]
            share = np.minimum(ends[i], bounds[a + 1 : b + 2]) - np.maximum(starts[i], bounds[a : b + 1])
            crossing[a] += 1
            if rule == "fraction":
                tokens[a : b + 1] += share / share.sum()
            else:
                tokens[a + (int(np.argmax(share)) if rule == "majority" else 0)] += 1
    return tokens, crossing


def count(docs: DataFrame, path: str, rule: str = "majority", sections: Callable[[str], np.ndarray] = line_starts) -> DataFrame:
    """doc_id, section (from 0), start, end, n_tokens, n_crossing, doc_tokens for each section."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            parts, sizes, totals = [], [], []
            for text in pdf["text"]:
                text = text or ""
                bounds = sections(text)
                starts, ends = enc.spans(text)
                tokens, crossing = attribute(starts, ends, bounds, rule)
                parts.append((np.arange(len(tokens)), bounds[:-1], bounds[1:], tokens, crossing))
                sizes.append(len(tokens))
                totals.append(len(starts))
            if not parts:
                continue
            section, start, end, tokens, crossing = (np.concatenate(x) for x in zip(*parts))
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].repeat(sizes).to_numpy(), "section": section, "start": start, "end": end,
                "n_tokens": tokens if rule == "fraction" else tokens.astype(np.int64), "n_crossing": crossing, "doc_tokens": np.repeat(totals, sizes),
            })

    kind = "double" if rule == "fraction" else "long"
    return long_ids(even(texts_by_id(docs)).mapInPandas(work, f"doc_id string, section long, start long, end long, n_tokens {kind}, n_crossing long, doc_tokens long"))
