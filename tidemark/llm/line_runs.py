"""Line dedup over levelled sorted runs of line hashes.

`LineRuns` keeps, for every line key, in how many documents it was met. Each batch of documents
adds one run: a table of (hash, documents) bucketed and sorted by hash. Two runs of a level are
merged into one run of the next, so n batches leave at most log(n) runs and every row is
rewritten once per level. Runs share their bucketing: merging them, and joining a batch against
them, sorts and shuffles only the batch.

* `add` stores a batch; `compact` merges what is left of the levels; `known` gives the keys that
  reach a number of documents;
* `anti_join` drops a batch's lines whose keys are known;
* `absorb` is the incremental step: merge-anti-join the batch with the runs, then add it.

A line's key is the line without spaces, tabs and line breaks at both ends, A-Z lower-cased.
Keys are compared by their 128-bit hash. Defined results: a null or empty text is one empty line
and stays empty; empty keys are never dropped; a key counts once per row, so repeated rows count
each; a document whose lines all go keeps an empty text; empty tables give empty results; all
columns of the input are kept, the text replaced.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import by_batch, keyed_text, written
from tidemark.plans.lineage import scratch_path

BLANK = b" \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]
# No more keys than this can each have more than this share of all (key, document) pairs.
COMMON = 2000
_DROPS = "__line_drops"


def line_keys(text: str | None) -> list[bytes]:
    """Keys of all lines of a text, in order. Only ASCII letters change under bytes.lower()."""
    return [line.strip(BLANK).lower() for line in (text or "").encode().split(b"\n")]


def key_hash(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def hashed_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, h1, h2: one row for each distinct non-empty line key of each document."""
    read = keyed_text(docs, key, text)

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, first, second = [], [], []
        for row, value in enumerate(batch.column("text").to_pylist()):
            for line in set(line_keys(value)):
                if line:
                    h1, h2 = key_hash(line)
                    rows.append(row)
                    first.append(h1)
                    second.append(h2)
        return pa.RecordBatch.from_arrays(
            [batch.column("key").take(pa.array(rows, pa.int64())), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
            names=["key", *_HASH],
        )

    schema = T.StructType([read.schema["key"], T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
    return by_batch(read, lines, schema)


class LineRuns:
    """Levelled runs of one corpus; `buckets` is fixed for the store's life."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self._spark = spark
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[str | None] = []

    def _store(self, counts: DataFrame) -> str:
        """Write one sorted run: one file for each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.repartition(self._buckets, *_HASH)
            .write.bucketBy(self._buckets, *_HASH)
            .sortBy(*_HASH)
            .option("path", scratch_path(self._spark, name))
            .saveAsTable(name)
        )
        return name

    def _merge(self, a: str, b: str) -> str:
        """Two runs become one: a merge join of sorted buckets, without a shuffle."""
        more = self._spark.table(b).withColumnRenamed("n_docs", "more")
        both = self._spark.table(a).join(more.hint("merge"), _HASH, "full")
        run = self._store(both.select(*_HASH, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs")))
        for name in (a, b):
            self._spark.sql(f"drop table {name}")
        return run

    def add(self, lines: DataFrame) -> None:
        """A batch of `hashed_lines` becomes a run; two runs of a level become one of the next."""
        run = self._store(lines.groupBy(*_HASH).agg(F.count("*").alias("n_docs")))
        for level, held in enumerate(self.levels):
            if held is None:
                self.levels[level] = run
                return
            run, self.levels[level] = self._merge(held, run), None
        self.levels.append(run)

    def compact(self) -> str | None:
        """All runs become one, the small ones first: about twice the largest is written."""
        held = [name for name in self.levels if name]
        if not held:
            return None
        run = held[0]
        for other in held[1:]:
            run = self._merge(other, run)
        self.levels = [None] * (len(self.levels) - 1) + [run]
        return run

    def known(self, min_docs: int = 1) -> DataFrame:
        """h1, h2, n_docs of the keys met in at least `min_docs` documents."""
        run = self.compact()
        if run is None:
            return self._spark.createDataFrame([], "h1 long, h2 long, n_docs long")
        return self._spark.table(run).filter(F.col("n_docs") >= min_docs)

    def anti_join(self, docs: DataFrame, lines: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """`docs` without the lines whose keys are known, with n_lines and n_dropped.

        Only hashes meet the runs; each document then gets the hashes it loses. The lines of a
        very common key would all meet in one task: such keys, `COMMON` at most, are broadcast.
        """
        total = known.agg(F.sum("n_docs")).first()[0] or 0
        common = F.col("n_docs") > total // COMMON
        hot = F.broadcast(known.filter(common).select(*_HASH))
        usual = known.filter(~common).select(*_HASH)
        lost = lines.join(hot, _HASH, "left_semi").unionByName(
            lines.join(hot, _HASH, "left_anti").join(usual.hint("merge"), _HASH, "left_semi")
        )
        drops = lost.groupBy(F.col("key").alias("__key")).agg(F.collect_list(F.struct(*_HASH)).alias(_DROPS))
        joined = docs.join(drops, docs[key].eqNullSafe(drops["__key"]), "left").drop("__key")
        names = docs.columns
        at = names.index(text)

        def filtered(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept, n_lines, n_dropped = [], [], []
            for value, drop in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                whole = (value or "").split("\n")
                if drop:
                    gone = {(d["h1"], d["h2"]) for d in drop}
                    keys = line_keys(value)
                    rest = [line for line, k in zip(whole, keys) if not (k and key_hash(k) in gone)]
                else:
                    rest = whole
                kept.append("\n".join(rest))
                n_lines.append(len(whole))
                n_dropped.append(len(whole) - len(rest))
            columns = [pa.array(kept, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*names, "n_lines", "n_dropped"],
            )

        kept_fields = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema]
        schema = T.StructType([*kept_fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
        return by_batch(joined, filtered, schema)

    def absorb(self, docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 1) -> DataFrame:
        """A new batch without lines already met in `min_docs` documents; then adds the batch.

        The result is written before the batch's own run, so it never sees its own lines.
        """
        lines = written(hashed_lines(docs, key, text), "lines")
        result = written(self.anti_join(docs, lines, self.known(min_docs), key, text), "kept")
        self.add(lines)
        return result


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, batches: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without lines whose keys occur in at least `min_docs` documents of the whole table.

    All batches are added to the runs first; the documents then meet the complete runs.
    """
    lines = written(
        hashed_lines(docs, key, text).withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches))), "lines"
    )
    runs = LineRuns(docs.sparkSession)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch))
    return runs.anti_join(docs, lines, runs.known(min_docs), key, text)
