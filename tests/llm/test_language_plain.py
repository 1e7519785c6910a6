"""Language identification against a plain version, and its sample."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quirestone.llm import language_id


def plain(rows, texts):
    """(language, score) of each text by the module's rule, with dictionaries only."""
    words, pieces = defaultdict(Counter), defaultdict(Counter)
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5:
            words[lang].update(re.findall(r"[^\W\d_]+", text.lower()))
    for lang, c in words.items():
        for w, n in c.items():
            m = f"<{w}>"
            for i in range(len(m)):
                for k in range(1, 6):
                    if i + k <= len(m):
                        pieces[lang][m[i : i + k]] += n
    words = {x: {w: n for w, n in c.items() if n >= 2} for x, c in words.items()}
    pieces = {x: {w: n for w, n in c.items() if n >= 3} for x, c in pieces.items()}
    langs = sorted(x for x in words if words[x] or pieces[x])

    def table(counts, alpha):
        every = set().union(*(counts[x] for x in langs)) if langs else set()
        return {w: [math.log((counts[x].get(w, 0) + alpha) / (sum(counts[x].values()) + alpha * max(1, len(every)))) for x in langs] for w in every}

    known, parts = table(words, 0.05), table(pieces, 0.5)
    out = []
    for text in texts:
        ws = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not langs or not any(c.isalpha() for w in ws for c in w):
            out.append(("und", 0.0))
            continue
        total = [0.0] * len(langs)
        for w in ws:
            row = known.get(w)
            if row is None:
                m, found = f"<{w}>", []
                for i in range(len(m)):
                    g = next((m[i : i + k] for k in range(min(5, len(m) - i), 0, -1) if m[i : i + k] in parts), None)
                    if g:
                        found.append([x + (5 - len(g)) * math.log(0.4) for x in parts[g]])
                row = [sum(x) / len(found) for x in zip(*found)] if found else [0.0] * len(langs)
            total = [a + b for a, b in zip(total, row)]
        best = max(range(len(langs)), key=lambda i: (total[i], -i))
        out.append((langs[best], 1 / sum(math.exp(t - total[best]) for t in total)))
    return out


def test_predictions_by_a_plain_version(spark):
    r = random.Random(4)
    vocabulary = {x: ["".join(r.choice(s) for _ in range(r.randrange(2, 8))) for _ in range(40)] for x, s in {"de": "aeinrstüß", "en": "aehiotwy", "fr": "aeéilsuq"}.items()}
    rows = []
    for i in range(120):
        lang = ("de", "en", "fr", "en")[i % 4]
        text = " ".join(r.choice(vocabulary[lang if r.random() < 0.7 else "en"]) for _ in range(r.randrange(1, 9)))
        rows.append((i if i % 11 else None, text, lang if i % 7 else None))
    rows += [(900, None, "de"), (901, "", "en"), (902, "12 ½ !", "fr"), (903, "ÜßÜß Äqua WHATTHE x" * 3, None), (904, "de" * 4000, "en"), (5, rows[5][1], "en")]
    got = language_id.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()
    want = plain(rows, [x[1] for x in rows])
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], round(x[2], 6))
    mine = sorted(((x["doc_id"], x["lang_pred"], x["score"]) for x in got), key=key)
    for a, b in zip(mine, sorted(((x[0], *w) for x, w in zip(rows, want)), key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)


def test_every_language_is_sampled_up_to_its_bound(spark):
    rows = [(i if i % 3 else None, f"text {i % 2}", "big") for i in range(3000)] + [(i, f"rare {i}", "rare") for i in range(7)] + [(None, None, "none"), (1, "x", None)]
    got = Counter(x["lang"] for x in language_id.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), 5, 40).collect())
    held = sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(7))
    assert got == {"big": 40, "rare": 7 - held}
