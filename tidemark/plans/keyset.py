"""A set of keys as a bitmap of bounded size: what is not in it is not among the keys.

A key's 64-bit hash names a word of 64 bits by its upper bits, and three bits of that word by its
lower ones (a blocked Bloom filter). An aggregate builds the words with partial `bit_or`s before
its one small shuffle, so neither hot keys nor many keys gather anywhere. The bitmap holds
`MOST_WORDS` words at most, whatever the number of keys: the frame to broadcast is bounded by
that, and a set too large for it only lets more rows through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 1 Mi words of 8 bytes, some 24 MB as a broadcast relation: 4 million keys at 16 bits each.
MOST_WORDS = 1 << 20
LEAST_WORDS = 1 << 6
BITS_PER_KEY = 16

_SLOT = "__tm_slot"
_WORD = "__tm_word"


def words_for(keys: int, most: int = MOST_WORDS) -> int:
    """The number of words, a power of two, for so many keys."""
    wanted = max(LEAST_WORDS, -(-keys * BITS_PER_KEY // 64))
    return min(most, 1 << (wanted - 1).bit_length())


def slot_of(hashed: Column, words: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - (words.bit_length() - 1)).cast("int")


def mask_of(hashed: Column) -> Column:
    bits = [F.shiftrightunsigned(hashed, at).bitwiseAND(F.lit(63)).cast("int") for at in (0, 6, 12)]
    set_bits = [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits]
    return set_bits[0].bitwiseOR(set_bits[1]).bitwiseOR(set_bits[2])


@dataclass(frozen=True)
class KeySet:
    """The words that have bits set: one row (slot, word) each, `words` rows at most."""

    bitmap: DataFrame
    words: int

    @staticmethod
    def of(rows: DataFrame, hashed: Column, keys: int, most: int = MOST_WORDS) -> KeySet:
        """The keys of `rows`, repeats welcome; `keys` is about how many there are."""
        words = words_for(keys, most)
        bits = rows.select(slot_of(hashed, words).alias(_SLOT), mask_of(hashed).alias(_WORD))
        return KeySet(bits.groupBy(_SLOT).agg(F.bit_or(_WORD).alias(_WORD)), words)

    def keep_possible(self, rows: DataFrame, hashed: Column) -> DataFrame:
        """Rows whose key may be in the set: all that are, and a few others. No shuffle of `rows`."""
        names = rows.columns
        marked = rows.withColumn(_SLOT, slot_of(hashed, self.words))
        mask = mask_of(hashed)
        return (
            marked.join(F.broadcast(self.bitmap), _SLOT)
            .filter(F.col(_WORD).bitwiseAND(mask) == mask)
            .select(*[F.col(f"`{n}`") for n in names])
        )

    def collected(self) -> pa.Table:
        """The rows (slot, word) on the driver, `words` of them at most."""
        return self.bitmap.select(F.col(_SLOT).alias("slot"), F.col(_WORD).alias("word")).toArrow()


def key_hash(names: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])
