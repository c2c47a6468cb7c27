"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint is the bitwise majority of the XXH64 of its word shingles. Fingerprints
that differ in at most `radius` of 64 bits are linked. With radius + 1 bit bands, linked
fingerprints agree on one band at least, so distinct fingerprints meet in the buckets of equal
band values, and nothing is lost. Within the buckets of a task fingerprints lie vertically: word
w of plane p holds bit p of 64 neighbours. One query meets 64 of them at once: planes that differ
are added into carry-save counters, and a (query, word) whose 64 distances all exceed the radius
is abandoned. Buckets above `BUCKET` fingerprints are cut into blocks that meet pairwise, so a hot
band value is spread over tasks. Tasks give back spanning links, not all pairs.

Defined results: A-Z lower-cased, words are runs without space, tab and line breaks; fewer words
than the shingle length make one shingle; null texts and texts without words have fingerprint 0
and are linked like any other; copies share a fingerprint and so a component; repeated rows stay
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.shared import by_batch, keyed_text, with_fields, written

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 4096
# (query, word) pairs compared at a time, and planes between two looks at who may be abandoned.
AT_ONCE = 1 << 18
PLANES = 8
_PRINT, _ROOT = "__tm_fingerprint", "__tm_root"
_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().translate(_SPACE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), last.tolist())), np.uint64, n
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at : at + (1 << 14)]
        set_bits += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, fingerprint as a signed long."""
    read = keyed_text(docs, key, text)

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(values.view(np.int64))], names=["key", "fingerprint"]
        )

    return by_batch(read, hashed, with_fields(read, "key", more="fingerprint long"))


def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit p of 64 neighbouring values in each word of plane p, zero-padded."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # (n, 64)
    packed = np.packbits(bits.reshape(-1, 64, 64), axis=1, bitorder="little")  # lanes of a word
    return np.ascontiguousarray(packed.transpose(2, 0, 1)).view(np.uint64).reshape(64, -1)


def _within(planes: np.ndarray, words: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For (query, word) pairs: which pairs have close lanes, and those lanes as a bit mask."""
    active = np.arange(len(words))
    digits = radius.bit_length()
    # The counters start so that passing the radius carries out of the highest digit.
    start = (1 << digits) - radius - 1
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(words), full if start >> d & 1 else np.uint64(0)) for d in range(digits)]
    over = np.zeros(len(words), np.uint64)
    for plane in range(64):
        bit = (queries >> np.uint64(plane)) & np.uint64(1)
        carry = planes[plane][words] ^ (np.uint64(0) - bit)
        for d in range(digits):
            carry, counters[d] = counters[d] & carry, counters[d] ^ carry
        over |= carry
        if plane % PLANES == PLANES - 1:
            keep = over != full
            active, words, queries, over = active[keep], words[keep], queries[keep], over[keep]
            counters = [c[keep] for c in counters]
            if not len(active):
                break
    return active, ~over


def _union(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining a[i] with b[i]; vectorised hooking and pointer jumping."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        a, b = a[apart], b[apart]
        low, high = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
        np.minimum.at(roots, high, low)
        while (jumped := roots[roots]).tobytes() != roots.tobytes():
            roots = jumped


def _spanning(values: np.ndarray, bounds: np.ndarray, left: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the values of each group [bounds[i], bounds[i + 1]).

    Where `left` is set only partly in a group, left values meet right ones; else all meet.
    """
    n = len(values)
    sizes = np.diff(bounds)
    n_words = -(-sizes // 64)
    first_word = np.concatenate(([0], np.cumsum(n_words)))
    group = np.repeat(np.arange(len(sizes)), sizes)
    lane = np.arange(n) - bounds[group]
    padded = np.zeros(first_word[-1] * 64, np.uint64)
    slot = first_word[group] * 64 + lane
    padded[slot] = values
    owner = np.full(first_word[-1] * 64, -1, np.int64)
    owner[slot] = np.arange(n)
    planes = _planes(padded)
    roots = np.arange(n)
    # A query meets its own word and later ones only: each pair once. In groups of two blocks it
    # starts at the first word that holds a right value.
    n_left = np.add.reduceat(left.astype(np.int64), bounds[:-1])
    first_right = np.where(n_left < sizes, first_word[:-1] + n_left // 64, 0)
    start_word = np.maximum(slot // 64, first_right[group])
    todo = np.where(left, first_word[group + 1] - start_word, 0)
    ends = np.cumsum(todo)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        counts = todo[at:upto]
        query = np.repeat(np.arange(at, upto), counts)
        step = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
        words = start_word[query] + step
        found, masks = _within(planes, words, values[query], radius)
        if len(found):
            lanes = np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, bit = np.nonzero(lanes)
            a, b = query[found[pair]], owner[words[found[pair]] * 64 + bit]
            real = (b >= 0) & (a != b)
            roots = _union(roots, a[real], b[real])
        at = upto
    linked = np.nonzero(roots != np.arange(n))[0]
    return values[linked], values[roots[linked]]


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between fingerprints (one `fingerprint` column, distinct) whose transitive
    closure is that of all pairs within the radius."""
    bands = radius + 1
    edges = [round(i * 64 / bands) for i in range(bands + 1)]
    value = F.col("fingerprint")
    keys = [
        F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(value, low).bitwiseAND((1 << (high - low)) - 1).alias("part"))
        for i, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    placed = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select("fingerprint", "k.band", "k.part")
    sizes = placed.groupBy("band", "part").agg(F.count("*").alias("n"))
    hot = sizes.filter(F.col("n") > bucket).select("band", "part", F.ceil(F.col("n") / bucket).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    # Block b meets all blocks: as the left side of (b, j >= b), as the right side of (i < b, b).
    meets = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = (
        placed.join(hot, ["band", "part"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(meets))
        .select(
            "fingerprint", "band", "part",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") <= F.col("other")).alias("left"),
        )
    )
    group = ["band", "part", "i", "j"]

    def compare(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        del tables
        names = [rows.column(c).to_numpy() for c in group]
        values = rows.column("fingerprint").to_numpy().view(np.uint64)
        left = rows.column("left").to_numpy(zero_copy_only=False)
        order = np.lexsort((values, ~left, *names[::-1]))
        names, values, left = [c[order] for c in names], values[order], left[order]
        new = np.zeros(len(values), bool)
        new[0] = True
        for c in names:
            new[1:] |= c[1:] != c[:-1]
        bounds = np.append(np.nonzero(new)[0], len(values))
        a, b = _spanning(values, bounds, left, radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(parts, *group).mapInArrow(compare, "a long, b long").distinct()


def _roots(printed: DataFrame, fingerprint: str, first: Column, radius: int) -> DataFrame:
    """(fingerprint, first, root): each distinct fingerprint, an aggregate of its rows, and the
    fingerprint that its component goes by."""
    distinct = printed.groupBy(F.col(fingerprint).alias("fingerprint")).agg(first.alias("first"))
    joined = components(links(distinct.select("fingerprint"), radius))
    return distinct.join(joined, distinct["fingerprint"] == joined["id"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("root")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per document: key, fingerprint (long), component_id (smallest key reachable)."""
    printed = written(fingerprints(docs, key, text, shingle), "fingerprints")
    # Components carry a fingerprint; the smallest key of a component names it.
    roots = written(_roots(printed, "fingerprint", F.min("key"), radius), "roots")
    named = roots.join(roots.groupBy("root").agg(F.min("first").alias("component_id")), "root")
    return printed.join(named.select("fingerprint", "component_id"), "fingerprint").select(
        F.col("key").alias(key), "fingerprint", "component_id"
    )


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of `docs` for each component: the one with the smallest key, then text, then other
    columns in their order; rows without a key only where no row of the component has one. Rows
    that repeat, whole or by their key alone, are in one component or stay apart by their texts.

    The smallest row is aggregated before the shuffle, so a large component leaves a task as one row.
    """
    where = docs.columns.index(text)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, shingle) for t in batch.column(where).cast(pa.string()).to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.view(np.int64))], schema=batch.schema.append(pa.field(_PRINT, pa.int64())))

    schema = T.StructType([*docs.schema.fields, T.StructField(_PRINT, T.LongType())])
    printed = written(by_batch(docs, add, schema), "printed-rows")
    roots = _roots(printed, _PRINT, F.count("*"), radius).select(F.col("fingerprint").alias(_PRINT), F.col("root").alias(_ROOT))
    names = [key, text, *[c for c in docs.columns if c not in (key, text)]]
    order = F.struct(F.col(f"`{key}`").isNull().alias("c"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    kept = printed.join(roots, _PRINT).groupBy(_ROOT).agg(F.min(order).alias("row"))
    return kept.select(*[F.col("row")[f"c{names.index(c)}"].alias(c) for c in docs.columns])
