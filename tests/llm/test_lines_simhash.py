import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.line_runs import LineRuns, drop_common_lines, hashed_lines
from tidemark.llm.simhash import _spanning, fingerprint, links, near_duplicates


def _key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def _dropped(texts, min_docs):
    counts = Counter(k for t in texts for k in {_key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if counts[_key(x)] < min_docs) for t in texts]


def test_common_lines_go_everywhere(spark):
    random.seed(3)
    lines = ["Foo", " foo\t", "FOO ", "bar", "Ä", "ä", "", " ", " x", "x", "tail\r", "rare one", "b" * 3000]
    texts = ["\n".join(random.choice(lines) for _ in range(random.randint(0, 6))) for _ in range(60)] + [None, "", "\n", "only once"]
    rows = [(i, t, "z", i) for i, t in enumerate(texts)] + [(None, "foo\nnever seen", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string, n long")
    for batches in (1, 4):
        got = drop_common_lines(docs, 10, batches)
        assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
        found = {r["doc_id"]: r for r in got.collect()}
        expected = _dropped([r[1] for r in rows], 10)
        for (number, text, _, _), kept in zip(rows, expected):
            assert found[number]["text"] == kept
            assert found[number]["n_lines"] == len((text or "").split("\n"))
            if kept:
                assert found[number]["n_dropped"] == len((text or "").split("\n")) - len(kept.split("\n"))


def test_runs_are_levelled_and_met_batch_by_batch(spark):
    runs, stored = LineRuns(spark, buckets=3), LineRuns(spark, buckets=3)
    seen = set()
    for batch in range(3):
        texts = [f"line {i}\nown {batch}" for i in range(batch, batch + 3)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: r["text"] for r in runs.absorb(docs).collect()}
        assert got == {i: "\n".join(x for x in t.split("\n") if x not in seen) for i, t in enumerate(texts)}
        seen.update(x for t in texts for x in t.split("\n"))
        stored.add(hashed_lines(docs, "doc_id", "text"))
    assert [bool(run) for run in stored.levels] == [True, True]
    assert stored.known().count() == runs.known().count() == len(seen)
    twice = stored.known().join(runs.known().hint("merge"), ["h1", "h2"])
    assert twice.count() == len(seen)
    assert "Exchange" not in twice._jdf.queryExecution().executedPlan().toString()


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert drop_common_lines(docs).collect() == []
    assert near_duplicates(docs).collect() == []
    assert hashed_lines(docs, "doc_id", "text").collect() == []


def _plain_print(text, shingle=4):
    words, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    words += [word] * bool(word)
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in (None, "", " \n", "One", "a b c", "a b c d", "A  b\tc D e f É é x y", "r r r r r r r r", "q " * 20000):
        assert fingerprint(text) == _plain_print(text)


def _plain_components(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def _near_prints(n):
    random.seed(n)
    values = {0}
    while len(values) < n:
        base = random.choice(list(values)) if random.random() < 0.7 else random.getrandbits(64)
        for _ in range(random.randint(0, 6)):
            base ^= 1 << random.randrange(64)
        values.add(base)
    return sorted(values)


def test_bit_sliced_links_span_all_pairs():
    values = _near_prints(500)
    expected = _plain_components(values, 4)
    array = np.array(values, np.uint64)
    a, b = _spanning(array, np.array([0, len(array)]), np.ones(len(array), bool), 4)
    root = dict(zip(a.tolist(), b.tolist()))
    groups = {}
    for v in values:
        groups.setdefault(root.get(v, v), set()).add(v)
    wanted = {}
    for v, r in expected.items():
        wanted.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_links_in_buckets_and_hot_blocks(spark):
    values = _near_prints(400)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    expected = _plain_components(values, 4)
    for bucket in (4096, 16):
        found = links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), bucket=bucket)
        got = {r["id"] % (1 << 64): r["component"] % (1 << 64) for r in components(found).collect()}
        groups, wanted = {}, {}
        for v in values:
            groups.setdefault(got.get(v, v), set()).add(v)
            wanted.setdefault(expected[v], set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2001, 2000)]
    random.seed(1)
    random.shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}, 2000: 2000, 2001: 2000}


def test_near_duplicate_rows(spark):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [base] * 5 + [base.replace("word7 ", "other ")] + [None, "", "alone here"] + [base.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    prints = [_plain_print(t) for t in texts]
    parents = _plain_components(sorted(set(prints)), 4)
    for i, p in enumerate(prints):
        assert got[i]["fingerprint"] % (1 << 64) == p
        assert got[i]["component_id"] == min(j for j, o in enumerate(prints) if parents[o] == parents[p])
    assert len(got) == len(texts)
