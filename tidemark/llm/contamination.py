"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations throughout.

An item's windows are its runs of `window` consecutive words (a shorter item is one window). A
window occurs in a document if all its shingles do, side by side, so any one of them must be
there: the necessary prefix of a window, for whole containment, is its rarest shingle. Shingles
are put in order of rarity by their counts over all documents. Documents' shingles meet the
windows' prefixes by hash; a meeting counts only if the window fits at the place that the prefix
has in it (positional bound) within the document's words (length bound), and the words there are
the window's (verification).

The windows are broadcast while they are known to stay below `MOST_BROADCAST` bytes. Beyond that
the documents' shingles are first thinned by a bitmap of bounded size (`plans.keyset`) and then
shuffled with the few words around them.

Defined results: null and empty texts have no words; a document's result depends on its text
only, so repeated rows get the same; an item id that repeats counts once, one that is null marks
words but is not listed; items without words do not occur; without items or documents there are
no hits or rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import with_fields, written
from tidemark.plans.keyset import KeySet

WINDOW = 10
SHINGLE = 3
# Bytes of windows that are broadcast, counted with what a hash table adds to each.
MOST_BROADCAST = 32 << 20
ROW_BYTES = 120

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spelled(text: Column) -> Column:
    """The words of a text, with one space between them."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _NO_WORD, " "))


def _word_list(words: Column) -> Column:
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def _shingle(words: Column, at: Column, length: int) -> Column:
    """The hash of the shingle at a place, null where it does not fit."""
    parts = [F.get(words, at + i) for i in range(length)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(length), *parts))


def windows_of(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, window, length): the distinct windows of each item, as words with spaces."""
    words, size = F.col("words"), F.size("words")
    last = F.greatest(size - window, F.lit(0))
    return (
        items.select(items[item].alias("item"), _word_list(spelled(items[text])).alias("words"))
        .filter(size > 0)
        .select("item", "words", F.explode(F.sequence(F.lit(1), last + 1)).alias("start"))
        .select("item", F.concat_ws(" ", F.slice(words, F.col("start"), window)).alias("window"), F.least(size, F.lit(window)).alias("length"))
        .distinct()
    )


def _shingles_of(windows: DataFrame, shingle: int, lengths: list[int]) -> DataFrame:
    """(window, length, offset, h): all shingles of distinct windows."""
    found = None
    rows = windows.select("window", "length").distinct()
    rows = rows.withColumn("words", F.split("window", " ")).select("*", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("offset"))
    for size in lengths:
        own = rows.filter(F.least(F.col("length"), F.lit(shingle)) == size)
        part = own.select("window", "length", "offset", _shingle(F.col("words"), F.col("offset"), size).alias("h"))
        found = part if found is None else found.union(part)
    return found.filter("h is not null")


def _places(texts: DataFrame, lengths: list[int], *kept: str) -> DataFrame:
    """Each shingle of each document: its hash h, its place `at`, the document's `words`, and `kept`."""
    rows = texts.filter("n_words > 0").select(*kept, _word_list(F.col("spelled")).alias("words"))
    rows = rows.select(*kept, "words", F.posexplode("words").alias("at", "word"))
    hashes = [_shingle(F.col("words"), F.col("at"), n) for n in lengths]
    if len(hashes) == 1:
        return rows.select(*kept, "at", "words", hashes[0].alias("h")).filter("h is not null")
    return rows.select(*kept, "at", "words", F.explode(F.array(*hashes)).alias("h")).filter("h is not null")


def hits(texts: DataFrame, windows: DataFrame, shingle: int = SHINGLE, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc, digest, start, length, window): every occurrence of a window in `texts` (doc, digest,
    spelled, n_words)."""
    size = F.least(F.col("length"), F.lit(shingle))
    facts = windows.agg(
        F.count("*").alias("n"),
        F.sum("length").alias("shingles"),
        F.max("length").alias("longest"),
        F.sum(F.octet_length("window") + ROW_BYTES).alias("bytes"),
        F.collect_set(size).alias("lengths"),
    ).first()
    lengths = sorted(facts["lengths"])
    if not lengths:
        return texts.sparkSession.createDataFrame([], with_fields(texts, "doc", "digest", more="start int, length int, window string"))
    shingles = written(_shingles_of(windows, shingle, lengths), "window-shingles")
    # A window has fewer shingles than words, `WINDOW` at most.
    small = facts["bytes"] <= most_broadcast
    side = F.broadcast if small else (lambda rows: rows.hint("merge"))

    places = _places(texts, lengths)
    if not small:
        known = KeySet.of(shingles, F.col("h"), facts["shingles"])
        places = known.keep_possible(places.select("h"), F.col("h"))
    counts = places.join(side(shingles.select("h").distinct()), "h", "left_semi").groupBy("h").agg(F.count("*").alias("n"))
    rarest = (
        shingles.join(counts, "h")
        .groupBy("window", "length")
        .agg(F.min(F.struct("n", "h", "offset")).alias("prefix"))
        .select("window", "length", "prefix.h", "prefix.offset")
    )
    prefixes = written(rarest, "window-prefixes")

    places = _places(texts, lengths, "doc", "digest", "n_words")
    start = (F.col("at") - F.col("offset")).alias("start")
    inside = (F.col("at") >= F.col("offset")) & (F.col("at") - F.col("offset") + F.col("length") <= F.col("n_words"))
    if small:
        found = places.join(side(prefixes), "h").filter(inside)
        there = F.slice("words", F.col("at") - F.col("offset") + 1, F.col("length"))
    else:
        # Only the words that a window around this place can have go along.
        longest = facts["longest"]
        first = F.greatest(F.col("at") - longest + 1, F.lit(0))
        known = KeySet.of(prefixes, F.col("h"), facts["n"])
        near = known.keep_possible(places, F.col("h")).select(
            "doc", "digest", "n_words", "h", "at", first.alias("first"), F.slice("words", first + 1, 2 * longest).alias("words")
        )
        found = near.join(side(prefixes), "h").filter(inside)
        there = F.slice("words", F.col("at") - F.col("offset") - F.col("first") + 1, F.col("length"))
    return found.filter(F.concat_ws(" ", there) == F.col("window")).select("doc", "digest", start, "length", "window")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """One row per document: key, n_words, n_hit (words inside an occurring window), items (ids of
    the items with such windows, as strings in order)."""
    words = docs.select(docs[key].alias("doc"), spelled(docs[text]).alias("spelled"))
    texts = written(
        words.select(
            "doc", F.unhex(F.sha2("spelled", 256)).alias("digest"), F.size(_word_list(F.col("spelled"))).cast("long").alias("n_words"), "spelled"
        ),
        "spelled",
    )
    windows = written(windows_of(items, item, item_text, window), "windows")
    found = written(hits(texts, windows, shingle, most_broadcast), "hits")

    of = ["doc", "digest"]
    runs = found.groupBy(*of, "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy(*of).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reached = runs.select(*of, "start", end.alias("end"), F.max(end).over(before).alias("reached"))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce("reached", F.lit(0))), F.lit(0))
    n_hit = reached.groupBy(*of).agg(F.sum(fresh).alias("n_hit"))
    ids = windows.filter("item is not null").select("window", F.col("item").cast("string").alias("item"))
    listed = (
        found.select(*of, "window").distinct().join(ids, "window").select(*of, "item").distinct()
        .groupBy(*of).agg(F.sort_array(F.collect_list("item")).alias("items"))
    )

    result = texts.select("doc", "digest", "n_words")
    for facts in (n_hit, listed):
        facts = facts.withColumnsRenamed({"doc": "doc_", "digest": "digest_"})
        same = result["doc"].eqNullSafe(facts["doc_"]) & (result["digest"] == facts["digest_"])
        result = result.join(facts, same, "left").drop("doc_", "digest_")
    return result.select(
        F.col("doc").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
