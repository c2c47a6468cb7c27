"""Token counts by a sentence-piece model, with the whole-token shortcut.

No piece of the vocabulary holds a space mark behind another character, so no merge ever
crosses from a word into the next space: a text's tokens are those of its runs "space marks,
then other characters". `prove` checks this for the model and lists the vocabulary strings that
encode alone as one token; a run that is one of them counts one, and only the rest is merged by
the library (and remembered in a bounded cache).

Defined results: null and empty texts have 0 tokens; a null text has 0 bytes; repeated rows are
counted each; other columns are not read.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import WordCache, by_batch, keyed_text, with_fields

MARK = "▁"
RUNS = re.compile(f"{MARK}+[^{MARK}]*")


@cache
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def prove(path: str) -> frozenset[str]:
    """Words that, after one space, are exactly one token. Raises if runs can not be cut apart."""
    model = _processor(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    usual = [i for i in range(len(pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    if any(re.search(f"[^{MARK}]{MARK}", pieces[i]) for i in usual):
        raise ValueError("a piece of this vocabulary spans two words")
    if model.encode("a b") != model.encode("a") + model.encode("b"):
        raise ValueError("this model does not put a space mark before a text")
    words = [pieces[i][1:] for i in usual if re.fullmatch(f"{MARK}[^{MARK}]+", pieces[i])]
    return frozenset(w for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1)


@cache
def _rest(path: str) -> WordCache:
    model = _processor(path)
    lone_mark = len(model.encode("a ")) - len(model.encode("a"))

    def fill(words: list[str]) -> list[int]:
        return [len(ids) if w else lone_mark for w, ids in zip(words, model.encode(words, num_threads=1))]

    return WordCache(fill, entries=900_000)


def runs(text: str) -> list[str]:
    """A text's runs without their first space mark, further marks as spaces."""
    if MARK not in text and "  " not in text and text[0] != " ":
        return text.split(" ")
    return [r[1:].replace(MARK, " ") for r in RUNS.findall(MARK + text.replace(" ", MARK))]


def count(text: str | None, path: str) -> int:
    if not text:
        return 0
    whole = prove(path)
    words = runs(text)
    rest = [w for w in words if w not in whole]
    return len(words) - len(rest) + sum(_rest(path).values_of(rest))


def token_counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens, over_limit."""
    prove(model)
    read = keyed_text(docs, key, text)

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers = [count(t, model) for t in batch.column("text").to_pylist()]
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0)
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), sizes.cast(pa.int64()), pa.array(numbers, pa.int64())],
            names=["key", "n_bytes", "n_tokens"],
        )

    rows = by_batch(read, counted, with_fields(read, "key", more="n_bytes long, n_tokens long"))
    return rows.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
