"""The pipeline's stages against plain Python over the same rows."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_lines_simhash import _dropped, _plain_components, _plain_print
from tests.llm.test_packing_counts import _check, _whole

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert len(left) >= 0.99 * len(rows) and all(rows[i] == t for i, t in left.items())
    order = sorted(left)
    lines = dict(zip(order, _dropped([left[i] for i in order], 10)))
    prints = {i: _plain_print(t) for i, t in lines.items()}
    parents = _plain_components(sorted(set(prints.values())), 4)
    first = {}
    for i in order:
        first.setdefault(parents[prints[i]], i)
    packed = corpus_pipeline.run(spark, SF).collect()
    by_sequence, by_doc = _check(packed, 2048)
    assert sorted(by_doc) == sorted(first.values())
    for i in by_doc:
        ids = [x for r in sorted(packed, key=lambda r: r["start"]) if r["doc_id"] == i for x in np.frombuffer(r["ids"], "<u4")]
        assert ids == [*_whole(lines[i]), 1]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, component_id long, h1 int"
    empty = spark.createDataFrame([], schema)
    assert stage(spark, empty, SF).collect() == []
    random.seed(1)
    texts = [None, "", " \n ", "und " * 30000, "same text of some words"] + ["the same line\n" + random.choice("abc")] * 20
    rows = [(i, t, "en", None, None, "k", None, 1) for i, t in enumerate(texts)] + [(4, texts[4], "en", None, None, "k", None, 1)]
    got = stage(spark, spark.createDataFrame(rows, schema), SF)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == empty.columns
    assert got.count() > 0


def test_one_row_of_each_group_stays(spark):
    """Repeated ids, rows without ids and an id that names another group: one row per group."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id long, fingerprint string"
    groups = ["alpha beta gamma delta epsilon", "one two three four five", "", "red green blue"]
    rows = [
        (0, groups[0], "en", "x", 1), (0, groups[0], "en", "x", 1), (0, groups[0], "en", "a", 1), (None, groups[0], "en", "x", 1),
        (5, groups[1], "en", "x", 1), (2, groups[1].upper(), "en", "x", 1), (5, groups[3], "en", "x", 1),
        (9, "", "en", "x", 1), (8, None, "en", "x", 1), (None, None, "en", "x", 1),
        (None, "no id at all", "en", "b", 1), (None, "no id at all", "en", "b", 1), (None, "no id at all", None, "b", 1),
    ]
    docs = spark.createDataFrame([(*r, 7, "f") for r in rows], schema)
    got = corpus_pipeline.simhash_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted((tuple(r)[:5] for r in got.collect()), key=key) == [
        (0, groups[0], "en", "a", 1), (2, groups[1].upper(), "en", "x", 1), (5, groups[3], "en", "x", 1),
        (8, None, "en", "x", 1), (None, "no id at all", None, "b", 1),
    ]
