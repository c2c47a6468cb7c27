"""Phrase collocations of each language by stripes.

A stripe is a prefix of words with an associative counter of its next words. Tasks build stripes
from runs of texts, the shuffle brings those of one prefix together, and they are merged
elementwise. The merged stripes hold all that is asked: large entries are the prefix's extensions
(the phrases one word longer), the sum of a word's stripe is that word's frequency as its entries
are those of two-word prefixes, and the largest entry tells whether a longer phrase subsumes the
prefix. Stripes are built for prefixes of one word, then of two and so on; a phrase can only be
frequent if the phrase without its last word and that without its first one are, so each level
reads the texts with a bitmap of the frequent phrases of the level before (`plans.keyset`, bounded
in size; what passes by mistake is counted and found rare). Occurrences of a word without such a
next word count under the empty word, so that sums are whole.

The stripe of a prefix with very many occurrences is cut into segments by the hash of the next
word, so that it does not meet in one task. A task merges stripes in the order of their prefixes
and holds a bounded number of entries besides the stripe it is at.

Defined results: texts that are null or empty hold no words; a null language is `und`, as is that
name itself; repeated rows count each time; an empty table gives no phrases; other columns are not
read. Counts are exact below 10^16 occurrences; beyond, decimal overflow raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written
from tidemark.plans.keyset import KeySet

LEAST = 10
LONGEST = 3
SUBSUMED = 50  # a longer candidate with this percentage of the occurrences takes a phrase's place
TOP = 2000
MILLION = 1_000_000
# Characters that a task counts at a time, and entries that it merges at a time.
RUN = 1 << 23
ENTRIES = 1 << 19
# A prefix is hot above this many occurrences or, in large corpora, above this share of all words.
HOT = 1_000
HOT_SHARES = 20_000

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(
    _BREAKS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_BREAKS) + b" abcdefghijklmnopqrstuvwxyz"
)
_BITS = 0xFFFFFFFFFFFFFFFF


@dataclass(frozen=True)
class Frequent:
    """Which phrases of one length may be frequent, and into how many segments hot ones are cut."""

    words: np.ndarray
    segments: dict[tuple[str, bytes], int]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        one, low = np.uint64(1), np.uint64(63)
        mask = np.zeros(len(hashes), np.uint64)
        for at in (0, 6, 12):
            mask |= one << (hashes >> np.uint64(at) & low)
        slots = hashes >> np.uint64(64 - (len(self.words).bit_length() - 1))
        return self.words[slots] & mask == mask


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(language, its words, ids of its words in order with -1 at breaks) of runs of texts."""

    def flushed():
        for lang, texts in held.items():
            words = [w for w in b" \n ".join(texts).replace(b"\n", b" \n ").split(b" ") if w]
            coded = pa.array(words, pa.binary()).dictionary_encode()
            del words
            ids = coded.indices.to_numpy().astype(np.int64)
            at = pc.index(coded.dictionary, b"\n").as_py()
            if at >= 0:
                ids[ids == at] = -1
            yield lang, coded.dictionary, ids

    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            text = text.translate(_CLEAN)
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size > RUN:
                yield from flushed()
                held, size = {}, 0
    yield from flushed()


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _word_counts(texts: DataFrame) -> DataFrame:
    """lang, phrase, n for words; the row without a word has the number of all words."""

    def count(batches):
        for lang, words, ids in _runs(batches):
            ids = ids[ids >= 0]
            n = np.bincount(ids, minlength=len(words))
            some = np.nonzero(n)[0]
            phrase = pa.concat_arrays([words.take(pa.array(some)).cast(pa.string()), pa.nulls(1, pa.string())])
            n = np.append(n[some], len(ids))
            yield _rows(lang=pa.array([lang] * len(n)), phrase=phrase, n=pa.array(n))

    rows = texts.mapInArrow(count, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _grams(
    lang: str, words: pa.Array, ids: np.ndarray, known: list[Frequent]
) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """For each place the id of the phrase that begins there, of as many words as there are levels
    known, or -1 where it can not be frequent; the phrases; and the hashes of the words."""
    digest = xxhash.xxh64_intdigest
    seed = digest(lang.encode(), 42)
    phrases = spelled_words = words.to_pylist()
    word_hashes = hashes = np.fromiter((digest(w, seed) for w in phrases), np.uint64, len(phrases))
    good = np.append(known[0].holds(hashes), False)  # the last one stands for breaks
    grams = np.where(good[ids], ids, -1)
    single = grams
    for length, level in enumerate(known[1:], 2):
        # Both the phrase without its last word and the one without its first word are frequent.
        both = np.nonzero((grams[:-1] >= 0) & (grams[1:] >= 0))[0]
        last = single[np.minimum(both + length - 1, len(single) - 1)]
        pairs, inverse = np.unique(grams[both] * len(words) + last, return_inverse=True)
        before, last = (part.tolist() for part in np.divmod(pairs, len(words)))
        spelled = [phrases[p] + b" " + spelled_words[w] for p, w in zip(before, last)]
        hashes = np.fromiter((digest(p, seed) for p in spelled), np.uint64, len(spelled))
        good = level.holds(hashes)
        grams = np.full(len(ids), -1)
        grams[both] = np.where(good[inverse], inverse, -1)
        phrases = spelled
    return grams, phrases, word_hashes


def _stripes(texts: DataFrame, known: list[Frequent]) -> DataFrame:
    """lang, prefix, segment, next (words), n (their counts), many rows for one prefix."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def stripes(batches):
        levels = shared.value
        length, segments = len(levels), levels[-1].segments
        for lang, words, ids in _runs(batches):
            grams, phrases, hashes = _grams(lang, words, ids, levels)
            follows = np.append(grams[1:] >= 0, False)
            # The sums of longer prefixes are entries of the level before.
            at = np.nonzero(grams >= 0 if length == 1 else (grams >= 0) & follows)[0]
            if not len(at):
                continue
            follows = follows[at]
            after = np.full(len(at), len(words))  # the empty word
            after[follows] = ids[at[follows] + length]
            pairs, n = np.unique(grams[at] * (len(words) + 1) + after, return_counts=True)
            prefix, after = np.divmod(pairs, len(words) + 1)
            hot = {p: n for (of, p), n in segments.items() if of == lang}
            parts = np.fromiter((hot.get(p, 1) for p in phrases), np.int64, len(phrases)) if hot else np.ones(len(phrases), np.int64)
            spread = np.append(hashes >> np.uint64(24), np.uint64(0)).astype(np.int64) & 0xFFFFFF
            segment = spread[after] % parts[prefix]
            order = np.lexsort((segment, prefix))
            prefix, segment, after, n = prefix[order], segment[order], after[order], n[order]
            new = np.append(True, (prefix[1:] != prefix[:-1]) | (segment[1:] != segment[:-1]))
            first = np.nonzero(new)[0]
            offsets = pa.array(np.append(first, len(n)), pa.int32())
            spelled = pa.concat_arrays([words, pa.array([b""], pa.binary())]).take(pa.array(after)).cast(pa.string())
            yield _rows(
                lang=pa.array([lang] * len(first)),
                prefix=pa.array(phrases, pa.binary()).take(pa.array(prefix[first])).cast(pa.string()),
                segment=pa.array(segment[first]),
                next=pa.ListArray.from_arrays(offsets, spelled),
                n=pa.ListArray.from_arrays(offsets, pa.array(n)),
            )

    return texts.mapInArrow(stripes, "lang string, prefix string, segment long, next array<string>, n array<long>")


_KEY = ["lang", "prefix", "segment"]


def _merged(stripes: DataFrame, least: int, sums: bool) -> DataFrame:
    """lang, prefix, next, n: the entries of `least` or more of each prefix and, with `sums`, for
    each of its segments the sum of all entries, as that of the empty word."""

    def flat(batch: pa.RecordBatch) -> pa.Table:
        row = pc.list_parent_indices(batch.column("next"))
        keys = {c: batch.column(c).take(row) for c in _KEY}
        return pa.table(keys | {"next": pc.list_flatten(batch.column("next")), "n": pc.list_flatten(batch.column("n"))})

    def added(parts: list[pa.Table]) -> pa.Table:
        merged = pa.concat_tables(parts).group_by([*_KEY, "next"], use_threads=False).aggregate([("n", "sum")])
        return merged.rename_columns([*_KEY, "next", "n"])

    def result(done: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = [done.filter(pc.and_(pc.greater_equal(done["n"], least), pc.not_equal(done["next"], "")))]
        if sums:
            total = done.group_by(_KEY, use_threads=False).aggregate([("n", "sum")]).rename_columns([*_KEY, "n"])
            parts.append(total.append_column("next", pa.array([""] * len(total), pa.string())))
        for part in parts:
            yield from part.select(["lang", "prefix", "next", "n"]).to_batches()

    def merge(batches):
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                held.append(flat(batch.slice(at, 4096)))
                size += len(held[-1])
                if size < ENTRIES:
                    continue
                both = added(held)
                last = held[-1].slice(len(held[-1]) - 1).to_pylist()[0]
                # Rows come in the order of the keys: only the last one's stripe is not whole yet.
                open_ = pc.and_(
                    pc.and_(pc.equal(both["lang"], last["lang"]), pc.equal(both["prefix"], last["prefix"])),
                    pc.equal(both["segment"], last["segment"]),
                )
                yield from result(both.filter(pc.invert(open_)))
                held = [both.filter(open_)]
                # A stripe that stays large is merged again only once as much has come.
                size = len(held[0]) // 2 if len(held[0]) > ENTRIES else 0
        if held:
            yield from result(added(held))

    placed = stripes.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return placed.mapInArrow(merge, "lang string, prefix string, next string, n long")


def _frequent(phrases: DataFrame, unit: int) -> Frequent:
    """The bitmap of (lang, phrase) rows and their hot ones; `HOT_SHARES` of these at most."""
    found = KeySet.of(phrases, F.xxhash64("lang", "phrase"), phrases.count())
    rows = found.collected()
    words = np.zeros(found.words, np.uint64)
    words[rows["slot"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    hot = phrases.filter(F.col("n") > unit).collect()
    return Frequent(words, {(r["lang"], r["phrase"].encode()): -(-r["n"] // unit) for r in hot})


def _last_words(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def _first_words(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def mine(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    subsumed: int = SUBSUMED,
    top: int = TOP,
) -> DataFrame:
    """The best `top` phrases of 2 to `longest` words of each language: lang, rank, phrase, a (its
    occurrences), l and r (those of its two parts at the cut that scores lowest), n (all words), score."""
    texts = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text")
    ).filter(F.length("text") > 0)
    words = _word_counts(texts)
    words = written(words.filter(F.col("phrase").isNull() | (F.col("n") >= least)), "words")
    sizes = words.filter("phrase is null").select("lang", "n")
    unit = max(HOT, (sizes.agg(F.sum("n")).first()[0] or 0) // HOT_SHARES)
    phrases = words.filter("phrase is not null")

    known: list[Frequent] = []
    candidates, above = [], []
    for length in range(1, longest):
        known.append(_frequent(phrases, unit))
        entries = written(_merged(_stripes(texts, known), least, length == 1), f"stripes-{length}")
        if length == 1:
            total = entries.filter("next = ''").groupBy("lang", F.col("prefix").alias("phrase"))
            counts = [total.agg(F.sum("n").alias("f"))]
        else:
            counts.append(phrases.withColumnRenamed("n", "f"))
        grown = entries.filter("next != ''")
        phrases = grown.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "n")
        candidates.append(phrases.withColumn("length", F.lit(length + 1)))
        if length > 1:
            ends = F.concat_ws(" ", _last_words(F.col("prefix"), length - 1), "next")
            for part in (F.col("prefix"), ends):
                above.append(grown.select("lang", part.alias("phrase"), F.col("n").alias("longer")))
    return _ranked(candidates, counts, above, sizes, subsumed, longest, top)


def _ranked(candidates, counts, above, sizes, subsumed, longest, top) -> DataFrame:
    def together(frames):
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    phrase, of = F.col("phrase"), F.col("length")
    kept = together(candidates).withColumnRenamed("n", "a")
    if above:
        longer = together(above).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        kept = kept.join(longer, ["lang", "phrase"], "left").filter(
            F.col("longer").isNull() | (100 * F.col("longer") < subsumed * F.col("a"))
        )
    cuts = [
        F.struct(F.lit(k).alias("k"), _first_words(phrase, k).alias("first"), _last_words(phrase, n - k).alias("rest"), F.lit(n).alias("of"))
        for n in range(2, longest + 1)
        for k in range(1, n)
    ]
    cut = F.explode(F.filter(F.array(*cuts), lambda c: c["of"] == of))
    cut_up = kept.select("lang", "phrase", "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.k", "cut.first", "cut.rest")
    counts = together(counts)
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = (
        cut_up.join(firsts, ["lang", "first"])
        .join(rests, ["lang", "rest"])
        .select(
            "lang", "phrase", "a", "k", "l", "r",
            F.expr(
                f"({MILLION} * cast(a as decimal(20, 0)) * cast(a as decimal(20, 0)))"
                " div (cast(l as decimal(20, 0)) * cast(r as decimal(20, 0)))"
            ).alias("score"),
        )
    )
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (
        lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
