from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licences, pseudo_lm
from tidemark.llm.licences import TEMPLATES, UNKNOWN, paragraphs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_lines_and_wrapped_paragraphs():
    text = "one\ntwo\n\n" + "x" * 200 + "\n \nlast"
    assert [text[s:e] for s, e in paragraphs(text)] == ["one", "one\ntwo", "two", "x" * 200, "last"]
    assert paragraphs(None) == paragraphs("") == paragraphs(" \n\n") == []


def test_planted_notices_are_found_and_clean_texts_left_alone(spark, classifier):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    notices = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
    }
    found = classifier.scan([r["text"] for r in docs])
    with_notice = 0
    for r, got in zip(docs, found):
        expected = {family for notice, family in notices.items() if notice in r["text"]}
        with_notice += bool(expected)
        assert {x["family"] for x in got} == expected, r["doc_id"]
    assert with_notice > 5


def test_every_template_is_its_family(classifier):
    foreign = "En den ist voura then. "
    for family, templates in TEMPLATES.items():
        for template in templates:
            words = template.split()
            wrapped = "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))
            for text in (template, foreign + template, template.upper(), "before\n\n" + wrapped + "\n\nafter"):
                got = classifier.scan([text])[0]
                assert family in {x["family"] for x in got}, (family, text)


def test_licence_words_alone_are_not_a_licence(classifier):
    texts = ["The software version was under work.", "He had a license to drive in any conditions.", "apache mit gnu", ""]
    for got in classifier.scan(texts):
        assert all(x["family"] == UNKNOWN for x in got)


def test_scan_rows(spark, classifier):
    texts = [None, "", "word " * 30000, "Released under the MIT License.", "Released under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("licences", F.lit("clash"))
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs, classifier).collect()}
    assert [len(got[i]) for i in range(5)] == [0, 0, 0, 1, 1]
    assert got[3][0]["family"] == "MIT" and (got[3][0]["start"], got[3][0]["end"]) == (0, 31)
    assert licences.scan(docs.limit(0), classifier).collect() == []
    assert licences.fit(docs.limit(0)).families[0] == licences.NONE


def _sentences(n, seed):
    rng = np.random.default_rng(seed)
    subjects, verbs, objects = ["cat", "dog", "bird", "cow"], ["sees", "hears", "likes"], ["milk", "grass", "seeds"]
    return " ".join(
        f"the {subjects[rng.integers(4)]} {verbs[rng.integers(3)]} some {objects[rng.integers(3)]} ." for _ in range(n)
    )


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.createDataFrame([(i, _sentences(60, i)) for i in range(400)], "doc_id long, text string")
    return pseudo_lm.fit(docs)


def test_word_order_is_learned(network):
    text = _sentences(100, 9999)
    words = text.split()
    shuffled = " ".join(np.random.default_rng(1).permutation(words))
    (n, m), (real, mixed) = network.score([text, shuffled])
    assert n == m == len(words)
    assert real / n > -1.2 and mixed / m < real / n - 0.5


def test_scores_are_the_summed_conditionals(network):
    texts = ["the cat sees some milk .", "", None, "unseenword dog", "the"]
    sizes, sums = network.score(texts)
    ids, shares, _ = network.encode(texts)
    w = network.weights
    at = 2
    for text, size, got in zip(texts, sizes, sums):
        total = 0.0
        for place in range(at, at + size):
            h = np.tanh(w["bias"] + sum(w["context"][s, ids[place + d]] for s, d in enumerate(pseudo_lm.SIDES)))
            owner = ids[place] // 64
            classes = h @ w["class_out"] + w["class_bias"]
            own = slice(owner * 64, owner * 64 + 64)
            words = w["word_out"][own] @ h + w["word_bias"][own]
            total += classes[owner] - np.log(np.exp(classes).sum()) + words[ids[place] % 64] - np.log(np.exp(words).sum()) + shares[place]
        assert abs(total - got) < 1e-3 * max(1, abs(total))
        at += size + 2
    assert list(sizes) == [6, 0, 0, 2, 1] and sums[1] == sums[2] == 0


def test_score_rows(spark, network):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "the cat"), (3, "the cat"), (4, "cow " * 30000)], "doc_id long, text string")
    got = sorted(map(tuple, pseudo_lm.score(docs.withColumn("n_words", F.lit("x")), network).collect()), key=lambda r: r[0])
    assert got[0] == (1, 0, 0.0, None) and got[1] == (2, 0, 0.0, None)
    assert got[2] == got[3] and got[2][1] == 2 and got[2][3] == got[2][2] / 2
    assert got[4][1] == 30000
    empty = pseudo_lm.fit(docs.limit(0))
    assert pseudo_lm.score(docs.limit(0), empty).collect() == []
    _, sums = empty.score(["any word"])
    assert np.isfinite(sums).all()


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return pseudo_lm.fit(docs), [r["text"] for r in docs.collect()]


def test_invented_and_shuffled_text_scores_below_the_corpus(corpus):
    fitted, texts = corpus
    rng = np.random.default_rng(5)
    words = " ".join(texts).split()
    shuffled = [" ".join(rng.permutation(words)[:2_000]) for _ in range(20)]
    letters = list("abcdefghijklmnopqrstuvwxyz")
    invented = [" ".join("".join(rng.choice(letters, rng.integers(4, 10))) for _ in range(300)) for _ in range(20)]

    def mean(group):
        sizes, sums = fitted.score(group)
        return sums.sum() / sizes.sum()

    assert mean(shuffled) < mean(texts) - 0.05
    assert mean(invented) < mean(texts) - 3.0
    rare = [w for w, n in Counter(pseudo_lm.words_of(" ".join(texts))).items() if n == 1][:200]
    assert mean([" ".join(invented[0].split()[:200])]) < mean([" ".join(rare)]) - 0.3


def test_shares_are_those_of_the_counts(corpus):
    """Each bucket's words, known and new, take no more than the whole of it."""
    fitted, texts = corpus
    words = {w for t in texts for w in pseudo_lm.words_of(t)}
    ids, shares, _ = fitted.encode([" ".join(sorted(words))])
    taken = np.zeros(pseudo_lm.VOCABULARY + 1)
    np.add.at(taken, ids, np.exp(shares))
    top = ids < pseudo_lm.VOCABULARY - pseudo_lm.BUCKETS
    assert (shares[top] == 0).all()
    buckets = taken[pseudo_lm.VOCABULARY - pseudo_lm.BUCKETS : pseudo_lm.VOCABULARY]
    assert (buckets <= 1.001).all() and buckets.min() > 0.2
    assert len(fitted.rest.slots) >= len(words) / 8


def test_every_document_trains_the_network(spark):
    lines = [f"{_sentences(20, i)} mark{i}" for i in range(60)]
    docs = spark.createDataFrame([(None if i % 2 else i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    moved = pseudo_lm.fit(docs)
    # Only a document that is trained on moves the context weights of its own last word.
    start = pseudo_lm._start(np.zeros(pseudo_lm.VOCABULARY))
    change = np.abs(moved.weights["context"] - start["context"]).max(axis=(0, 2))
    assert all(change[moved.ids[f"mark{i}"]] > 1e-4 for i in range(60))


def test_fitting_and_scoring_in_one(spark):
    docs = spark.createDataFrame([(i, _sentences(10, i)) for i in range(30)] + [(None, None), (7, "")], "doc_id long, text string")
    found = {tuple(r)[:2]: r["log_prob"] for r in pseudo_lm.fit_and_score(docs).collect()}
    plain = {tuple(r)[:2]: r["log_prob"] for r in pseudo_lm.score(docs, pseudo_lm.fit(docs)).collect()}
    assert found.keys() == plain.keys() and all(abs(found[k] - plain[k]) < 0.02 * max(1, abs(plain[k])) for k in found)


def test_words_are_looked_up_together_and_once(network, monkeypatch):
    """Not text by text; and as if they were."""
    texts = ["the cat", None, "", "sees un1 un2 un1", "w" * 70 + " the w", "\ud800 cat", "un2"] * 3
    single = [network.encode([t]) for t in texts]
    asked, codes = [], network._codes
    monkeypatch.setattr(network, "_codes", lambda words: asked.append(len(words)) or codes(words), raising=False)
    ids, shares, sizes = network.encode(texts)
    distinct = {w for t in texts for w in pseudo_lm.words_of(t)}
    assert asked == [len(distinct)]
    assert list(sizes) == [n for _, _, sizes in single for n in sizes]
    for all_at_once, part in ((ids, 0), (shares, 1)):
        assert list(all_at_once) == list(single[0][part][:2]) + [v for one in single for v in one[part][2:]]
