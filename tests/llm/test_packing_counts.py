import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.packing import assemble, cut, pack, pack_documents, shortest_pack_first
from tidemark.llm.token_counts import count, token_counts
from tidemark.llm.word_bpe import WordBpe, word_bpe

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", "It's A\ttest\r\nwith\x0b odd spaces here", "x<|endoftext|>y", "İstanbul ΣΑΣ ς", "é é",
    "́ mark", "日本語 text", "a▁b ▁ ▁▁c", "\x00\x01", "no" * 3000, "a" * 5000, "tail ", "👩‍👩‍👧 ok", "\n\n\n", "▁", "▁▁ ",
]
texts = st.text(st.sampled_from("ab .,'sÉ é▁\n\t  日0ΣİA"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_ids_are_those_of_the_tokenizer(text):
    assert word_bpe(WORDS).encode_batch([text])[0].tolist() == _whole(text)


_TOKENIZER = Tokenizer.from_file(WORDS)


def _whole(text):
    return _TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts():
    more = ["don't I'LL we're you've 'm 'search !'s ''s s'' 12'3 x'", "½ ²a ªº × ÷ß ÿĀſ ŉ ǅ", "naïve Öl-Färbung, 10%"]
    for text, ids in zip(ODD + more, word_bpe(WORDS).encode_batch(ODD + more)):
        assert ids.tolist() == _whole(text), text[:50]


def _thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch):
    """Long words whose polynomial hashes agree, and short ones that are made to agree."""
    for n in (512, 1024, 2048, 4096):
        pair = [_thue_morse(n), _thue_morse(n).translate(str.maketrans("ab", "ba"))]
        assert [x.tolist() for x in word_bpe(WORDS).encode_batch(pair)] == [_whole(t) for t in pair]
    keys = WordBpe._keys
    monkeypatch.setattr(WordBpe, "_keys", lambda self, *args: (keys(self, *args)[0] % np.uint64(3), keys(self, *args)[1]))
    texts = ["the cat's hat, they're Here 12 times; the CAT", "a b c d e f g h", "été the cat", None, "", "12 the 12"] * 3
    own = WordBpe(WORDS)
    for batch in (texts, texts[::-1], texts):
        assert [x.tolist() for x in own.encode_batch(batch)] == [_whole(t or "") for t in batch]


def test_ids_of_the_documents(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text, ids in zip(texts, word_bpe(WORDS).encode_batch(texts)):
        assert ids.tolist() == _whole(text)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_counts_are_those_of_the_library(text):
    assert count(text, PIECES) == len(_model().encode(text))


def _model():
    from tidemark.llm.token_counts import _processor

    return _processor(PIECES)


def test_counts_of_odd_texts():
    for text in ODD:
        assert count(text, PIECES) == len(_model().encode(text)), text[:50]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_patterns_use_up_the_histogram(histogram):
    patterns = shortest_pack_first(histogram, 64)
    used = {}
    for n, lengths in patterns:
        assert n > 0 and sum(lengths) <= 64
        for length in lengths:
            used[length] = used.get(length, 0) + n
    assert used == histogram
    assert len(patterns) <= 2 * max(1, len(histogram))


def _check(rows, capacity):
    """Each sequence is gapless from 0; each document's ids lie in exactly one piece each."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence, by_doc


def test_packed_documents(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*ODD, None, *["same text of a hot group"] * 300, *["w " * i for i in range(300)]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    packed = pack_documents(docs, WORDS, capacity=128).collect()
    by_sequence, by_doc = _check(packed, 128)
    assert sorted(by_doc) == list(range(len(rows)))
    ids = {}
    for r in sorted(packed, key=lambda r: (r["doc_id"], r["start"])):
        got = ids.setdefault(r["doc_id"], [])
        assert r["start"] == len(got) and r["length"] * 4 == len(r["ids"])
        got.extend(np.frombuffer(r["ids"], "<u4").tolist())
    for number, text, _ in rows:
        assert ids[number] == [*_whole(text or ""), 1]
        assert by_doc[number][0][2] == len(ids[number])
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= -(-total // 128) + 2
    whole = assemble(spark.createDataFrame(packed), 128).collect()
    assert len(whole) == len(by_sequence)
    for r in whole:
        assert len(r["ids"]) == 4 * (r["n_tokens"] if r["n_tokens"] & (r["n_tokens"] - 1) == 0 else 128)
    crc = spark.createDataFrame(packed).select("ids", F.crc32("ids").alias("c")).first()
    assert crc["c"] == zlib.crc32(crc["ids"])


def test_ranks_over_many_buckets(spark):
    pieces = spark.range(20000).select(
        F.col("id").alias("key"), F.lit(0).cast("long").alias("start"), (F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40 + 1)).cast("long").alias("length")
    )
    packed = pack(pieces, 64).withColumn("doc_tokens", F.lit(0)).withColumnRenamed("key", "doc_id").collect()
    by_sequence, by_doc = _check(packed, 64)
    assert len(by_doc) == 20000 and sorted(by_sequence) == list(range(len(by_sequence)))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, WORDS).collect() == []
    assert token_counts(docs, PIECES).collect() == []
    assert cut(docs, WORDS).collect() == []


def test_count_rows(spark):
    rows = [(1, "ä b"), (1, "ä b"), (2, None), (None, ""), (3, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = sorted(map(tuple, token_counts(docs, PIECES).collect()), key=str)
    many = len(_model().encode("word " * 5000))
    two = len(_model().encode("ä b"))
    assert got == sorted([(1, 4, two, False), (1, 4, two, False), (2, 0, 0, False), (None, 0, 0, False), (3, 25000, many, True)], key=str)
