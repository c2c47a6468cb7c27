"""What the operators of this package share: written tables, batch functions, bounded caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.lineage import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, under names of its own; other columns do not matter."""
    return docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))


# Rows that a batch function gets at a time.
ROWS = 2048


def by_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str
) -> DataFrame:
    """`function` over slices of Arrow batches, which Spark bounds in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield function(batch.slice(at, ROWS))

    return df.mapInArrow(run, schema)


def stretches(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of texts with about `size` characters."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text or "") > size:
            yield first, i
            first, held = i, 0
        held += len(text or "") + 1
    if held:
        yield first, len(texts)


def with_fields(df: DataFrame, *names: str, more: str) -> T.StructType:
    """A schema of columns of `df` followed by the fields of a DDL string."""
    return T.StructType([df.schema[n] for n in names] + T.StructType.fromDDL(more).fields)


class WordCache(dict):
    """word -> value with misses filled in bulk; emptied when full, so that its size is bounded.

    Words longer than `longest` are worked out each time and never kept.
    """

    def __init__(self, fill: Callable[[list[str]], list], entries: int = 600_000, longest: int = 64):
        super().__init__()
        self._fill, self._entries, self._longest = fill, entries, longest

    def values_of(self, words: list[str]) -> list:
        try:
            return list(map(self.__getitem__, words))
        except KeyError:
            pass
        missing = [w for w in set(words) if w not in self]
        found = dict(zip(missing, self._fill(missing)))
        if len(self) + len(missing) > self._entries:
            found.update((w, self[w]) for w in set(words) if w in self)
            self.clear()
        values = [found[w] if w in found else self[w] for w in words]
        self.update((w, v) for w, v in found.items() if len(w) <= self._longest)
        return values


def distinct(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct words, in the order in which they first come, and the place of each word among them."""
    try:
        coded = pa.array(words, pa.string())
    except UnicodeEncodeError:  # halves of surrogate pairs
        coded = pa.array([w.encode("utf-8", "surrogatepass") for w in words], pa.binary())
    places = coded.dictionary_encode().indices.to_numpy()
    firsts = np.flatnonzero(np.diff(np.maximum.accumulate(places), prepend=-1))
    return [words[i] for i in firsts.tolist()], places


def spread(column: str, parts: int):
    """A place for each value that does not change when a task runs again."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(parts)).cast("int")
