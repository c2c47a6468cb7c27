import random
import re

import pytest

from tidemark.llm.contamination import contaminated

DOCS = "doc_id long, text string, lang string, item string, words string, n_hit int"
ITEMS = "item_id long, text string, doc_id string, digest int"


def _words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _plain(text, items, window=10):
    """n_words, n_hit, item ids of one text, by trying every window at every place."""
    words, hit, found = _words(text), set(), set()
    for item, other in items:
        own = _words(other)
        length = min(len(own), window)
        for start in range(len(own) - length + 1) if own else ():
            for at in range(len(words) - length + 1):
                if words[at : at + length] == own[start : start + length]:
                    hit |= set(range(at, at + length))
                    found |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(found)


def _tables():
    random.seed(9)
    alphabet = ["a", "b", "Éa", "The", "x9", "日本"]
    say = lambda n: "".join(random.choice(alphabet) + random.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    passages = [say(n) for n in (1, 2, 3, 9, 10, 11, 25, 40)] + ["same " * 15, "one two three four five six seven eight nine ten eleven"]
    items = list(enumerate(passages)) + [(10, passages[9]), (11, None), (12, " .,"), (None, passages[6]), (5, passages[4]), (100, "ÉA the")]
    texts = [say(random.randint(0, 80)) for _ in range(40)]
    texts += [say(5) + p + say(5) for p in passages] + [p + p for p in passages] + passages
    texts += [None, "", " \n", "same " * 300, "SAME same Same", passages[9][:-7], "eleven " + passages[9].replace("ten", "TEN")]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(0, texts[0]), (0, texts[1]), (None, passages[7]), (None, passages[7]), (None, None)] + [(7, texts[45])] * 4
    return rows, items


@pytest.mark.parametrize("most", [1 << 20, 0])
@pytest.mark.parametrize("window, shingle", [(10, 3), (4, 2), (3, 3)])
def test_hits_match_every_window_at_every_place(spark, window, shingle, most):
    rows, items = _tables()
    if window > 4:  # short items occur nearly everywhere in these few words
        items = [x for x in items if x[0] not in (0, 1)]
    docs = spark.createDataFrame([(i, t, "x", "y", "z", 1) for i, t in rows], DOCS).repartition(3)
    bench = spark.createDataFrame([(i, t, "d", 1) for i, t in items], ITEMS)
    got = contaminated(docs, bench, window=window, shingle=shingle, most_broadcast=most)
    assert got.columns == ["doc_id", "n_words", "n_hit", "items"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    expected = sorted(((i, *_plain(t, items, window)) for i, t in rows), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == expected
    assert sum(r[2] > 0 for r in expected) > 20


def test_no_python_in_the_plan(spark):
    rows, items = _tables()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plan = contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_nothing_to_meet(spark):
    none = spark.createDataFrame([], ITEMS)
    docs = spark.createDataFrame([(1, "some words", "", "", "", 1), (2, None, "", "", "", 1)], DOCS)
    assert sorted(map(tuple, contaminated(docs, none).collect())) == [(1, 2, 0, []), (2, 0, 0, [])]
    items = spark.createDataFrame([(1, "some words", "", 1), (2, "", "", 1)], ITEMS)
    assert contaminated(spark.createDataFrame([], DOCS), items).collect() == []
    assert sorted(map(tuple, contaminated(docs, items).collect())) == [(1, 2, 2, ["1"]), (2, 0, 0, [])]
