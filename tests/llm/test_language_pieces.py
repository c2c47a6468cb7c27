import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.pieces import _Lattices, _runs, decode_ids, encode, sample, vocabulary, with_decoded
from tidemark.llm.queries import op2_language

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def models(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return language.fit(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op2_language(spark, SF).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.98
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_probabilities_follow_the_formula(models):
    """Each context's probabilities of all known characters and the rest sum to one."""
    letters = sorted(set("abcdefghijklmnopqrstuvwxyz äöüßéèêçàñíóáú"))
    for context in ("the", "x th", "qqz", "ent"):
        (base,), (size,), _ = models.cross_entropies([context])
        more, sizes, _ = models.cross_entropies([context + c for c in letters])
        shares = np.exp(base * size - more * sizes[:, None]).sum(axis=0)
        assert np.all(shares <= 1 + 1e-3) and np.all(shares > 0.9), shares


def test_batches_do_not_matter(models):
    texts = ["the of and", "", None, "123 ...", "a", "Ünd der! die", "que los", "x" * 20000, "the of and"]
    together, _, _ = models.cross_entropies(texts)
    for text, row in zip(texts, together):
        assert np.allclose(models.cross_entropies([text])[0][0], row, atol=1e-4)


def test_rejections_and_unknown(spark, models):
    rng = np.random.default_rng(0)
    noise = "".join(chr(0x4E00 + i) for i in rng.integers(0, 3000, 300))
    random = " ".join("".join(rng.choice(list("qxzjkvwp"), 7)) for _ in range(50))
    texts = [None, "", "12 %% 4", "the and of the in", noise, random]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.predict(docs, models).collect()}
    assert [got[i]["lang_pred"] == "und" for i in range(6)] == [True, True, True, False, False, False]
    assert [got[i]["rejected"] for i in range(6)] == [True, True, True, False, True, True]
    kept = language.without_rejected(docs, models)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [3]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    models = language.fit(docs, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(docs, models).collect()}
    assert got == {1: ("und", 0.0, False), 2: ("und", 0.0, False)}
    assert language.predict(docs.limit(0), models).collect() == []
    # One labelled text: learned from, or kept for calibration, but never a failure.
    for i in range(6):
        lone = language.fit(docs.limit(0).union(spark.createDataFrame([(i, "the and of", "en")], docs.schema)), F.lit(True))
        assert lone.predict(["the of", None])["lang_pred"].tolist() in (["en", "und"], ["und", "und"])


def _all_segmentations(run, words):
    if not run:
        return {(): 1.0}
    found = {}
    for n in range(1, len(run) + 1):
        edge = words.edge(run[:n])
        if edge:
            for rest, weight in _all_segmentations(run[n:], words).items():
                found[(edge[0], *rest)] = weight * np.exp(edge[1])
    return found


@pytest.mark.parametrize("text", ["the", "hello", "aé▁"])
def test_sampled_shares_are_those_of_all_segmentations(text):
    words = vocabulary(PIECES)
    exact = {}
    for ids, weight in _all_segmentations(_runs(text)[0], words).items():
        spelled = tuple(itertools.chain.from_iterable([i] if i >= 0 else [words.bytes[b] for b in chr(-1 - i).encode()] for i in ids))
        exact[spelled] = exact.get(spelled, 0) + weight
    total = sum(exact.values())
    n = 20000
    seeds = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    got = Counter(tuple(x.tolist()) for x in sample([text] * n, seeds, PIECES))
    assert set(got) <= set(exact)
    for ids, weight in exact.items():
        p = weight / total
        assert abs(got[ids] / n - p) <= 5 * np.sqrt(p * (1 - p) / n) + 1e-9


def test_lattices_built_together_are_the_plain_ones():
    words = vocabulary(PIECES)
    runs = ["▁", "▁▁", "▁the", "▁international", "▁日本x", "▁\ud800a", "▁a\nb", "▁" + "ab" * 20]
    together, plain = _Lattices(words), _Lattices(words)
    together.of(runs)
    for run in runs:
        plain._append(run)
    assert list(together.starts) == list(plain.starts) and list(together.codes) == list(plain.codes)
    assert np.allclose(together.sums, plain.sums, atol=1e-9)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab the▁ \n日é\x00👩Z."), max_size=30), min_size=1, max_size=5))
def test_decoding_is_lossless_and_batches_do_not_matter(texts):
    seeds = np.arange(len(texts), dtype=np.uint64) + np.uint64(5)
    together = sample(texts, seeds, PIECES)
    for text, seed, ids in zip(texts, seeds, together):
        assert decode_ids(ids.tolist(), PIECES) == text
        assert sample([text], np.array([seed]), PIECES)[0].tolist() == ids.tolist()


def test_encode_and_decode_rows(spark):
    texts = [None, "", " ", "tail ", "▁ mark", "long " * 4000, "x" * 3000, "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    encoded = encode(docs, PIECES)
    again = {r["doc_id"]: r["ids"] for r in encode(docs.repartition(7), PIECES).collect()}
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == again
    assert {r["doc_id"]: r["text"] for r in with_decoded(encoded, PIECES).collect()} == dict(enumerate(texts))
    assert again[0] is None and again[1] == []
    other = {r["doc_id"]: r["ids"] for r in encode(docs, PIECES, seed=1).collect()}
    assert other[5] != again[5]
    assert with_decoded(encode(docs.limit(0), PIECES), PIECES).collect() == []


def test_a_language_of_one_document_is_learned(spark):
    """Whatever its id, which decides what is counted of a language with many documents."""
    usual = [(i, f"the ferry {i} came and went with the tide and the wind", "en") for i in range(60)]
    rare = "zgodnie z rozkładem prom odpływa jutro rano kiedy wiatr się uspokoi"
    docs = spark.createDataFrame(usual, "doc_id long, text string, lang string")
    for number in (1000, 1001, 1002, 1003, 1004, 1005):
        both = docs.union(spark.createDataFrame([(number, rare, "pl")], docs.schema))
        models = language.fit(both, both["lang"].isNotNull())
        assert models.languages == ["en", "pl"]
        found = models.predict([rare, "the tide came with the wind"])
        assert found["lang_pred"].tolist() == ["pl", "en"] and not found["rejected"][0]
