"""Secret scanning: fixed patterns, plus a randomness test battery over long token runs.

A run of at least ``least`` characters from ``[A-Za-z0-9+/_-]``, with ``=`` only as padding at its end, is
a candidate. Its encoding is inferred as the smallest of the alphabets that holds all its characters. A run
that none holds is read in three ways, as parts between ``+ /``, between ``- _`` and between all four; the
parts are candidates, at three times their p-value; parts that overlap become one if each is below ``q``,
otherwise the one of least p-value stays. Three statistics are taken: chi-squared uniformity over that
alphabet, the number of runs of character classes, and the lag-1 serial correlation of letters, once of their
places in the alphabet and once as vowels and consonants, which alternate in words of any language. Uniformity,
runs and alternation are each turned into a p-value under the hypothesis "ordinary text" (letters as uneven as
prose, rare changes of class, vowels beside consonants); Fisher's method joins the three. A candidate that the
statistics show to be *not* random (chi-squared, runs or serial correlation beyond ``veto`` under the uniform
hypothesis) is dropped.

False discoveries are controlled over the whole table, by weighted Benjamini-Hochberg at level ``q`` with
weights in proportion to length, because short runs carry little evidence. With ``u = p / length`` the rule is
the largest ``u`` with ``u <= q * (candidates at or below u) / (sum of all lengths)``; one pass counts
candidates in bins of ``log10 u`` (``BINS`` to a decade), the driver sees one row a bin, and the rule is taken
at the bins' upper ends, which can only be stricter. The second pass keeps what is at or below that cut.

Defined cases: null text is empty; a document without findings has zero counts and an empty ``spans``;
rows that repeat give rows that repeat; offsets are code points, end exclusive; findings that overlap
a fixed-pattern span are left to it; a table without candidates has no cut and no random finding.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import even, long_ids, texts_by_id

# Patterns and the least lengths of a finding, in the order in which kinds are listed.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}

RUN = re.compile(r"[A-Za-z0-9+/_-]+=*")
#: Parts of a run that no alphabet holds: base64url, base64 and base62 ones.
PARTS = (re.compile(r"[A-Za-z0-9_-]+=*"), re.compile(r"[A-Za-z0-9+/]+=*"), re.compile(r"[A-Za-z0-9]+=*"))
HINTS = ("passw", "secret", "token", "api")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = sorted(
    (
        ("decimal", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER),
        ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER), ("BASE36", _DIGITS + _UPPER), ("letters", _LOWER + _UPPER),
        ("base62", _DIGITS + _LOWER + _UPPER), ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ),
    key=lambda x: len(x[1]),
)
_INDEX = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS}
#: Chance that two random letters of prose are equal, that neighbours differ in class (in mixed case, and in one case),
#: and that neighbouring letters are both vowels or both consonants (0.69 for random letters).
PROSE_COINCIDENCE, PROSE_CHANGE, PROSE_CHANGE_PLAIN, PROSE_ALIKE = 0.066, 0.15, 0.12, 0.42
VOWELS = frozenset("aeiouAEIOU")
#: Level of false discoveries among random findings, least length of a candidate, bins to a decade of p / length.
Q, LEAST_RUN, BINS = 1e-3, 20, 20


def _phi(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def infer_encoding(s: str) -> str | None:
    """The smallest alphabet that holds every character (padding aside), or None."""
    chars = set(s)
    return next((name for name, letters in ALPHABETS if chars <= set(letters)), None)


def battery(s: str, veto: float = 1e-3) -> float | None:
    """p-value of ``s`` under "ordinary text", or None if it isn't random-like in its encoding either."""
    s = s.rstrip("=")
    name = infer_encoding(s)
    n = len(s)
    if name is None or n < 8:
        return None
    index = _INDEX[name]
    size = len(index)
    counts = Counter(s)
    chi = sum(c * c for c in counts.values()) * size / n - n
    # uniform: Wilson-Hilferty upper tail
    df = size - 1
    upper = 1 - _phi((max(chi, 0.0) / df) ** (1 / 3) / math.sqrt(2 / (9 * df)) - (1 - 2 / (9 * df)) / math.sqrt(2 / (9 * df)))
    # ordinary text: letters as uneven as prose
    excess = max(size * PROSE_COINCIDENCE - 1, 0.35)
    p_chi = _phi((chi - df - (n - 1) * excess) / math.sqrt(2 * df + 4 * n * excess))
    kinds = [_class(c) for c in s]
    share = Counter(_class(c) for c in index)
    same = sum((v / size) ** 2 for v in share.values())
    runs = 1 + sum(a != b for a, b in zip(kinds, kinds[1:]))
    p_runs = 1.0
    if same < 1:
        expected = (n - 1) * (1 - same)
        if abs(runs - 1 - expected) > 3.3 * math.sqrt(max(expected * same, 1e-9)):
            return None
        # in names a capital opens a word: its step to small letters is no change
        turns = runs - 1 - sum(a == 1 and b == 0 for a, b in zip(kinds, kinds[1:]))
        rate = PROSE_CHANGE if size > 36 else PROSE_CHANGE_PLAIN
        p_runs = 1 - _phi((turns - 0.5 - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate)))
    at = [index[c] for c in s]
    mean = sum(at) / n
    var = sum((x - mean) ** 2 for x in at)
    if not var:
        return None
    serial = sum((x - mean) * (y - mean) for x, y in zip(at, at[1:])) / var
    if upper < veto or abs(serial) * math.sqrt(n) > 3.3:
        return None
    letters = [(x in VOWELS) == (y in VOWELS) for x, y in zip(s, s[1:]) if x.isalpha() and y.isalpha()]
    m, p_serial = len(letters), 1.0
    if m and size > 16:  # hex has too few letters for words
        p_serial = 1 - _phi((sum(letters) - 0.5 - m * PROSE_ALIKE) / math.sqrt(m * PROSE_ALIKE * (1 - PROSE_ALIKE)))
    x = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-x) * (1 + x + x * x / 2)  # Fisher: chi-squared with 6 degrees of freedom


def bin_of(p: float, length: int) -> int:
    """The bin of a candidate's p / length; a bin's upper end is ``10 ** (bin / BINS)``."""
    return math.ceil(BINS * math.log10(max(p, 1e-300) / length))


def cut_of(bins: list[tuple[int, int, int]], q: float = Q) -> int | None:
    """The last bin that Benjamini-Hochberg lets pass, of (bin, candidates, sum of lengths); None if none does."""
    total, rank, last = sum(x[2] for x in bins), 0, None
    for place, n, _ in sorted(bins):
        rank += n
        if 10 ** (place / BINS) <= q * rank / total:
            last = place
    return last


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Fixed-pattern findings by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if any(len(c) >= LEAST["hex"] for c in text.split()):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def tested(text: str, start: int, end: int, least: int = LEAST_RUN, q: float = Q) -> list[tuple[int, int, float]]:
    """(start, end, p) of a run, or of its parts where no alphabet holds the run."""
    run = text[start:end]
    if infer_encoding(run.rstrip("=")) is not None:
        p = battery(run)
        return [] if p is None else [(start, end, p)]
    parts = {m.span() for way in PARTS for m in way.finditer(run) if m.end() - m.start() >= least}
    ranked = sorted((min(1.0, len(PARTS) * p), start + s, start + e) for s, e in parts if (p := battery(run[s:e])) is not None)
    out: list[tuple[int, int, float]] = []
    for p, s, e in ranked:
        met = [x for x in out if x[0] < e and s < x[1]]
        if met and p > q:
            continue
        out = [x for x in out if x not in met] + [(min(s, *(x[0] for x in met)), max(e, *(x[1] for x in met)), min(x[2] for x in met)) if met else (s, e, p)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, str]], least: int = LEAST_RUN) -> list[tuple[int, int, float]]:
    """(start, end, p) of the runs and parts that the battery doesn't refuse."""
    if not any(len(c) >= least for c in text.split()):
        return []
    found = []
    for m in RUN.finditer(text):
        if m.end() - m.start() >= least and not any(s < m.end() and m.start() < e for s, e, _ in base):
            found += tested(text, m.start(), m.end(), least)
    return found


def all_spans(text: str, cut: int | None) -> list[tuple[int, int, str]]:
    """All findings, random ones up to the bin ``cut``."""
    base = base_spans(text)
    random_ = [] if cut is None else [(s, e, "random") for s, e, p in candidates(text, base) if bin_of(p, e - s) <= cut]
    return sorted(base + random_, key=lambda x: (x[0], KINDS.index(x[2])))


def corpus_cut(docs: DataFrame, q: float = Q) -> int | None:
    """The table's cut: candidates counted by bin in the tasks, one row a bin to the driver."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        lengths: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                for s, e, p in candidates(text or "", base_spans(text or "")):
                    place = bin_of(p, e - s)
                    n[place] += 1
                    lengths[place] += e - s
        yield pd.DataFrame([(k, n[k], lengths[k]) for k in n], columns=["bin", "n", "length"]).astype("int64")

    binned = even(docs.select(F.col("text").cast("string").alias("text"))).mapInPandas(work, "bin long, n long, length long")
    return cut_of([tuple(r) for r in binned.groupBy("bin").agg(F.sum("n"), F.sum("length")).collect()], q)


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for each row of ``docs``."""
    cut = corpus_cut(docs)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                spans = all_spans(text or "", cut)
                base = [x for x in spans if x[2] != "random"]
                n = Counter(k for _, _, k in spans)
                rows.append((n["assign"], n["access"], n["hex"], n["random"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    schema = "doc_id string, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return long_ids(even(texts_by_id(docs)).mapInPandas(work, schema))


def redact(text: str | None, cut: int | None, mark: str = "[secret]") -> str | None:
    """``text`` with every finding replaced; overlapping findings become one mark."""
    if not text:
        return text
    out, at = [], 0
    for s, e, _ in all_spans(text, cut):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame) -> DataFrame:
    """All documents, with secrets in their text replaced by a mark; other columns stay (n_chars follows)."""
    cut = corpus_cut(docs)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, cut) for t in texts], dtype=object)

    out = docs.withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        same = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(same))
    return out.select(*docs.columns)
