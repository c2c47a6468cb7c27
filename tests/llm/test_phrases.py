import random
import re
from collections import Counter

import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import mine

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, prefix int"


def _plain(rows, least, longest, top):
    """lang -> rows as (rank, phrase, a, l, r, n, score), by counting every phrase."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    found = {}
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        inside = lambda w: any(list(w[i : i + len(words)]) == words for i in range(len(w) - len(words) + 1))
        if any(k[0] == lang and len(k) - 1 > len(words) and c >= least and 100 * c >= 50 * a and inside(k[1:]) for k, c in counts.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((score, a, " ".join(words), left, right))
    result = set()
    for lang, rows in found.items():
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        result |= {(lang, i, p, a, le, r, sizes[lang], s) for i, (s, a, p, le, r) in enumerate(rows[:top], 1)}
    return result


def _rows():
    random.seed(5)
    words = ["the", "The", "of", "a", "New", "york", "éa", "Éa", " ", "x y", "b|c", "z9"]
    texts = [
        "".join(random.choice(words) + random.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " \r"]) for _ in range(random.randint(0, 60)))
        for _ in range(200)
    ]
    texts += [None, "", " ", ".", "\n\n", "the " * 500, "new york city. " * 30, "a b c d e " * 40]
    texts += [texts[3]] * 5
    langs = ["en", "fr", None, "und", ""]
    return [(t, langs[i % 5] if i % 3 else "en") for i, t in enumerate(texts)]


@pytest.mark.parametrize("longest", [2, 3, 4])
@pytest.mark.parametrize("small", [False, True])
def test_phrases_match_plain_counts(spark, monkeypatch, longest, small):
    if small:  # many runs, hot prefixes in several segments, stripes merged in many parts
        monkeypatch.setattr(phrases, "RUN", 400)
        monkeypatch.setattr(phrases, "HOT", 7)
        monkeypatch.setattr(phrases, "ENTRIES", 5)
    rows = _rows()
    docs = spark.createDataFrame([(None, t, g, "x", "y", 1) for t, g in rows], SCHEMA).repartition(3)
    got = mine(docs, least=3, longest=longest, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) > 60
    assert set(found) == _plain(rows, 3, longest, 40)


def test_no_phrases(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, None, "en", "", "", 1), (2, "one two three", None, "", "", 1)], SCHEMA)
    assert mine(docs).collect() == []


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([("en", "a b", 2, 9 * 10**15)], "lang string, phrase string, length int, n long")
    counts = spark.createDataFrame([("en", "a", 9 * 10**15 + 1), ("en", "b", 9 * 10**15 + 7)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", 10**17)], "lang string, n long")
    row = phrases._ranked([frame], [counts], [], sizes, 50, 2, 10).first()
    a, left, right = 9 * 10**15, 9 * 10**15 + 1, 9 * 10**15 + 7
    assert row["score"] == 1_000_000 * a * a // (left * right) == 999_999
