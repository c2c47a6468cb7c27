"""Packing: tokenised documents into sequences of at most `capacity` tokens with little padding.

Shortest-pack-first over the length histogram. A document is cut into full pieces and one rest;
the histogram of piece lengths has at most `capacity` rows, so it is placed on the driver:
lengths go longest first, each into the emptiest pattern that still has room, and only the
patterns' counts change. The patterns are then joined back to the pieces by their rank among
pieces of equal length. Ranks come from (length, bucket) groups with the buckets' offsets, so
that a length which holds a third of all pieces is spread over many tasks.

Defined results: a null text counts as empty and yields one piece that holds only the end id;
repeated rows are packed each for themselves; an empty table gives no pieces; other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import by_batch, keyed_text, with_fields, written
from tidemark.llm.word_bpe import word_bpe

CAPACITY = 2048
END_ID = 1
BYTES = 4
# Pieces per rank bucket, all lengths together; the fewest buckets.
BUCKET_ROWS = 100_000
LEAST_BUCKETS = 64


def cut(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of documents: key, start, length, doc_tokens, ids (little-endian binary)."""
    read = keyed_text(docs, key, text)
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = capacity * BYTES

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, starts, lengths, totals, ids = [], [], [], [], []
        for row, own in enumerate(word_bpe(tokenizer).encode_batch(batch.column("text").to_pylist())):
            buffer = own.tobytes() + end
            for at in range(0, len(buffer), step):
                part = buffer[at : at + step]
                rows.append(row)
                starts.append(at // BYTES)
                lengths.append(len(part) // BYTES)
                totals.append(len(buffer) // BYTES)
                ids.append(part)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key").take(pa.array(rows, pa.int64())),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=["key", "start", "length", "doc_tokens", "ids"],
        )

    schema = with_fields(read, "key", more="start long, length long, doc_tokens long, ids binary")
    return by_batch(read, pieces, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (count, lengths) that use up the histogram.

    Each step uses up a pattern or a length, and only the latter adds patterns, two at most, so
    there are at most two patterns for each distinct length.
    """
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    room: list[int] = []  # free lengths of open packs, largest first, as negative numbers

    def put(free: int, count: int, lengths: tuple[int, ...]) -> None:
        packs = open_packs.setdefault(free, [])
        if not packs:
            heapq.heappush(room, -free)
        packs.append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed = []  # of this length; back in the pool for its next piece as well
        while left:
            if room and -room[0] >= length:
                free = -room[0]
                count, lengths = open_packs[free].pop()
                if not open_packs[free]:
                    heapq.heappop(room)
                used = min(left, count)
                if used < count:
                    placed.append((free, count - used, lengths))
                put(free - length, used, (*lengths, length))
                left -= used
            else:
                # No pack has room: new ones are filled with this length, one after the other.
                each = capacity // length
                for count, copies in ((left // each, each), (int(left % each > 0), left % each)):
                    if count:
                        put(capacity - copies * length, count, (length,) * copies)
                left = 0
            for pack in placed:
                put(*pack)
            placed.clear()
    return [pack for free in sorted(open_packs) for pack in open_packs[free]]


def _slots(patterns: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
    """For each length, which ranks belong to which sequences and at which offset."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            rows.append((length, first, base, offset))
            taken[length] = first + count
            offset += length
        base += count
    return pd.DataFrame(rows, columns=["length", "first", "base", "offset"]).sort_values(["length", "first"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (key, start, length, any payload) with `sequence_id` and `offset`.

    Reads `pieces` several times: pass a written table.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(shortest_pack_first(histogram, capacity))
    buckets = max(LEAST_BUCKETS, sum(histogram.values()) // BUCKET_ROWS)
    spread = pieces.withColumn("__bucket", F.pmod(F.xxhash64("key", "start"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("length", "__bucket")
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    within = Window.partitionBy("length", "__bucket").orderBy("key", "start", *(["ids"] if "ids" in pieces.columns else []))
    ranked = spread.withColumn("__row", F.row_number().over(within) - 1).join(offsets, ["length", "__bucket"])

    lengths, firsts = slots["length"].to_numpy(np.int64), slots["first"].to_numpy(np.int64)
    bases, inside = slots["base"].to_numpy(np.int64), slots["offset"].to_numpy(np.int64)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wanted, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        low = np.searchsorted(lengths, wanted, "left")
        high = np.searchsorted(lengths, wanted, "right")
        while (open_rows := high - low > 1).any():  # binary search among the slots of each length
            middle = (low + high) // 2
            right = firsts[middle] <= ranks
            low = np.where(open_rows & right, middle, low)
            high = np.where(open_rows & ~right, middle, high)
        return pd.DataFrame({"sequence_id": bases[low] + ranks - firsts[low], "offset": inside[low]})

    placed = ranked.withColumn("__place", place("length", F.col("__before") + F.col("__row")))
    return placed.select(*pieces.columns, "__place.sequence_id", "__place.offset")


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenised, cut and packed documents: one row per piece with its ids, sequence and offset."""
    packed = pack(written(cut(docs, tokenizer, key, text, capacity), "pieces"), capacity)
    return packed.withColumnRenamed("key", key)


def assemble(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Whole sequences: sequence_id, n_tokens, ids (little-endian binary), padded to `capacity`
    unless the sequence's length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    pad = np.array([pad_id], dtype="<u4").tobytes()

    def fill(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = []
        for n, pieces in zip(batch.column("n_tokens").to_pylist(), batch.column("parts").to_pylist()):
            missing = 0 if n & (n - 1) == 0 else capacity - n
            ids.append(b"".join(p["ids"] for p in pieces) + pad * missing)
        return pa.RecordBatch.from_arrays(
            [batch.column("sequence_id"), batch.column("n_tokens"), pa.array(ids, pa.binary())],
            names=["sequence_id", "n_tokens", "ids"],
        )

    return by_batch(joined, fill, "sequence_id long, n_tokens long, ids binary")
