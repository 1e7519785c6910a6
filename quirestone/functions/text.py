"""Text functions as Column expressions. Java's classes are ASCII unless ``(?U)`` is given, so it always is."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Character classes of headings and numbering.
CJK_DIGITS = "一二三四五六七八九十"
CJK_NUMERALS = CJK_DIGITS + "百千万"
HEADING_PATTERNS = (
    r"^\d+(?:\.\d+)+(?:[、.．]|\s)+",
    r"^\d+[、.．]\s*",
    r"^[（(]\d+(?:\.\d+)*[）)](?:[、.．]|\s)*",
    rf"^[（(][{CJK_DIGITS}]+[）)](?:[、.．]|\s)*",
    rf"^[{CJK_DIGITS}]+[、.．]\s*",
    r"^附[:：]\s*",
)
NUMBERING_PATTERNS = (
    rf"\s*[{CJK_NUMERALS}]+[、.]?\s*",
    rf"\s*[（(][{CJK_DIGITS}0-9]+[)）]\s*",
    r"\s*\d+(?:\.\d+)*[、.]?\s*",
)


def _u(pattern: str) -> Column:
    return F.lit("(?U)" + pattern)


def _replace(x: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(x, _u(pattern), F.lit(by))


#: The characters with Unicode's property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    """Without white space at both ends, in Unicode's sense."""
    return F.btrim(x, F.lit(WHITE_SPACE))


def is_blank(x: Column) -> Column:
    """Null, empty, or nothing but white space."""
    return ~F.coalesce(x, F.lit("")).rlike(r"(?U)\S")


def clean_text(x: Column) -> Column:
    """Null becomes empty, ideographic spaces become plain ones, ends are stripped."""
    return strip(F.replace(F.coalesce(x.cast("string"), F.lit("")), F.lit("　"), F.lit(" ")))


@F.pandas_udf(StringType())
def _nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


#: Texts of these characters need no more than the table below: ASCII, Latin letters but those that NFKC takes apart,
#: CJK ideographs, marks that it keeps, and full-width forms of ASCII.
_PLAIN = r"^[\x00-\x7fÀ-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ɏ一-鿿、。“”‘’—–·　！-～]*$"
_WIDE = "　" + "".join(chr(i) for i in range(0xFF01, 0xFF5F))
_NARROW = " " + "".join(chr(i) for i in range(0x21, 0x7F))


def half_width(x: Column) -> Column:
    """NFKC. Spark has no such function: only texts that a table can't settle go through Python."""
    # translate looks up each character, which most texts don't need
    return F.coalesce(_nfkc(F.when(~x.rlike(_PLAIN), x)), F.when(x.rlike("[　！-～]"), F.translate(x, _WIDE, _NARROW)).otherwise(x))


def preview(x: Column, limit: int = 120) -> Column:
    return F.substring(_replace(clean_text(x), r"\s+", " "), 1, limit)


def compact(x: Column) -> Column:
    return _replace(x, r"\s+")


def strip_punctuation(x: Column) -> Column:
    return _replace(x, r"[^\w\x{4e00}-\x{9fff}]+")


def tokens(x: Column) -> Column:
    """Runs of CJK characters, each with its bigrams after it, and runs of a-z and 0-9."""
    text = F.lower(half_width(F.coalesce(x.cast("string"), F.lit(""))))
    runs = F.regexp_extract_all(text, F.lit(r"[\x{4e00}-\x{9fff}]+|[a-z0-9]+"), F.lit(0))

    def parts(r: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))
        return F.when((r >= "一") & (F.length(r) > 1), F.concat(F.array(r), pairs)).otherwise(F.array(r))  # a run is CJK or ASCII

    # the text is asked, as a test of the runs would extract them twice
    return F.when(text.rlike(r"[\x{4e00}-\x{9fff}]"), F.flatten(F.transform(runs, parts))).otherwise(runs)


def strip_numbering(x: Column) -> Column:
    """Leading numbers of all three kinds, as often as they come."""
    return strip(_replace(half_width(clean_text(x)), f"^(?:{'|'.join(NUMBERING_PATTERNS)})+"))


def normalize_title(x: Column) -> Column:
    return F.lower(compact(strip_punctuation(strip_numbering(x))))


def is_heading(x: Column) -> Column:
    t = strip(F.coalesce(x, F.lit("")))
    hit = F.lit(False)
    for p in HEADING_PATTERNS:
        hit = hit | t.rlike("(?U)" + p)
    return (t != "") & hit


def is_attachment_heading(x: Column) -> Column:
    return strip(F.coalesce(x, F.lit(""))).rlike("(?U)" + HEADING_PATTERNS[5])


def strip_heading_marker(x: Column) -> Column:
    """The first heading pattern that matches is cut off; never gives an empty title for a text."""
    t = strip(F.coalesce(x, F.lit("")))
    out = t
    for p in reversed(HEADING_PATTERNS):
        out = F.when(t.rlike("(?U)" + p), strip(_replace(t, p))).otherwise(out)
    return F.when(out == "", t).otherwise(out)


def display_title(x: Column) -> Column:
    return strip(_replace(strip_heading_marker(x), r"\s+", " "))


def attachment_title(x: Column) -> Column:
    t = strip(_replace(strip(F.coalesce(x, F.lit(""))), HEADING_PATTERNS[5]))
    return F.when(t == "", display_title(x)).otherwise(t)


def heading_level(x: Column) -> Column:
    """Depth of dotted numbers; 1 for simple and CJK numbers; 10 + depth in brackets; 99 for attachments; else 50."""
    t = strip(F.coalesce(x, F.lit("")))

    def depth(pattern: str) -> Column:
        return F.size(F.split(F.regexp_extract(t, "(?U)" + pattern, 1), r"\."))

    dotted, simple, bracket = r"^(\d+(?:\.\d+)+)(?:[、.．]|\s)+", r"^\d+[、.．]\s*", r"^[（(](\d+(?:\.\d+)*)[）)]"
    cjk = rf"^[（(]?([{CJK_DIGITS}]+)[）)]?[、.．]"
    return (
        F.when(t.rlike("(?U)" + dotted), depth(dotted)).when(t.rlike("(?U)" + simple), 1).when(t.rlike("(?U)" + bracket), 10 + depth(bracket))
        .when(t.rlike("(?U)" + cjk), 1).when(F.startswith(t, F.lit("附")), 99).otherwise(50)
    )


def section_level(title: Column) -> Column:
    dots = F.length(title) - F.length(F.replace(title, F.lit("."), F.lit("")))
    return F.when(title.rlike("^[（(]"), 2).when(F.contains(F.substring(title, 1, 6), F.lit(".")), F.least(dots + 1, F.lit(4))).otherwise(1)


def header_name(x: Column) -> Column:
    return F.lower(F.translate(clean_text(x), "（） _-", "()"))


def to_bool(x: Column) -> Column:
    """Words for true and false; anything else that isn't empty counts as true."""
    t = F.lower(clean_text(x))
    return ~t.isin("", "nan", "none", "-", "否", "n", "no", "false", "0")


def section_path(*parts: Column) -> Column:
    """Non-blank parts other than "-" joined with " / "."""
    cleaned = F.array(*[clean_text(p) for p in parts])
    return F.array_join(F.filter(cleaned, lambda p: (p != "") & (p != "-")), " / ")


def path_parts(path: Column, drop_root: bool = False) -> Column:
    parts = F.filter(F.transform(F.split(F.coalesce(path, F.lit("")), " / "), strip), lambda p: p != "")
    return F.slice(parts, 2, 1_000) if drop_root else parts


def path_leaf(path: Column) -> Column:
    return F.coalesce(F.try_element_at(path_parts(path), F.lit(-1)), F.lit(""))


def number_key(title: Column) -> Column:
    """Leading dotted numbers as an array of ints; arrays compare item by item. Null without a number."""
    n = F.regexp_extract(F.coalesce(title, F.lit("")), r"(?U)^\s*(\d+(?:\.\d+)*)", 1)
    return F.when(n != "", F.transform(F.split(n, r"\."), lambda p: p.cast("int")))


def lookup_key(x: Column) -> Column:
    """Key of the context service: NFKC, lower case, no separators."""
    return _replace(F.lower(half_width(clean_text(x))), r"[\s/\\>＞_\-—、，,。.：:（）()【】\[\]]+")


def cell_signature(x: Column) -> Column:
    """A table cell without white space, brackets, dashes and common punctuation; subscript two and micro signs are folded, case stays."""
    plain = F.translate(F.coalesce(x, F.lit("")), "₂μµ", "2uu")
    return _replace(plain, r"[\s，,。；;：:、（）()\[\]【】<>《》\-—_]+")


def safe_name(x: Column, limit: int = 80) -> Column:
    """A file name: illegal characters become "_"; long names end with a hash of the whole."""
    t = F.regexp_replace(clean_text(x), r'[\\/:*?"<>|\r\n\t]+', "_")
    t = F.when(t == "", F.lit("untitled")).otherwise(t)
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit - 9), F.lit("_"), F.substring(F.sha1(x.cast("binary")), 1, 8))).otherwise(t)


def json_fence(x: Column) -> Column:
    """The inside of a fenced JSON answer, or the text itself."""
    inner = F.regexp_extract(F.coalesce(x, F.lit("")), r"(?s)```(?:json)?\s*(.*?)```", 1)
    return strip(F.when(inner != "", inner).otherwise(F.coalesce(x, F.lit(""))))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, with one machine word row per character of ``b`` (bit-parallel)."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    mask, state = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & mask
    return len(a) - state.bit_count()


@F.pandas_udf(DoubleType())
def _indel(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else 1.0 if not x and not y else 2 * lcs_length(x, y) / (len(x) + len(y)) for x, y in zip(a, b)], dtype=float)


def indel_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """``2 LCS / (|a| + |b|)``. With ``least``, pairs that Levenshtein shows to be under it skip Python and give 0."""
    if not least:
        return _indel(a, b)
    room = F.floor((1 - least) * (F.length(a) + F.length(b)))
    possible = F.levenshtein(a, b) <= room
    return F.when(possible, _indel(F.when(possible, a), F.when(possible, b))).otherwise(F.lit(0.0))
