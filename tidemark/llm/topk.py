"""Exact top-k search by inner product, with norm-bucketed retrieval.

Vectors are sorted by length into buckets of at most `BUCKET` rows, each one row of a table with
its largest length. A query's k-th best product within the longest bucket is a lower bound that
every further result must reach. Divided by the query's length and a bucket's largest length it
becomes the bucket's local cosine threshold, which decides how the bucket is read:

* above 1, no vector of the bucket can qualify: the bucket is left out;
* low thresholds: length pruning, which keeps the vectors long enough to reach the bound;
* high thresholds: coordinate pruning, which keeps the vectors whose share on the query's largest
  coordinates allows the cosine.

What is left is verified by exact integer products. A task gets a shard of the buckets and a group of
the query blocks, through a shuffle: buckets are dealt over the shards and go to each group, query blocks
go to each shard, and the longest bucket of a dimension goes to all tasks for the bounds. There a query
keeps its best k so far, whose last raises its bound for the buckets that follow, longest first.
No join is left to Spark's estimates: blocks of alike vectors are far smaller in files than in memory.

Defined results: vectors that are null, empty or hold null or non-finite components take no part;
a query meets vectors of its own dimension and of other ids; ties go to the smaller id; fewer
candidates give fewer rows; repeated rows are candidates each; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import written

K = 10
BUCKET = 2048
QUERIES = 512
# Local cosine thresholds from here on are read by coordinates; how many of them.
COORDINATE = 0.4
FOCUS = 4
SLACK = 1e-9
# Tasks for each core of the cluster, and the numbers that a task's queries hold.
WAVES = 8
HELD = 1 << 24
_BLOCK = "block long, dim int, longest double, ids binary, vectors binary"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    low, high = int(matrix.min()), int(matrix.max())
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return matrix.astype(kind)


def _blocks(rows: DataFrame, total: int, size: int) -> DataFrame:
    """Rows (id, dim, norm, vector) as blocks of neighbours in length, longest first."""
    parts = max(1, -(-total // (size * 4)))

    def build(batches):
        kept = [b for b in batches if b.num_rows]
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        ids, norms = table.column("id").to_numpy(), table.column("norm").to_numpy()
        dims = table.column("dim").to_numpy()
        vectors = table.column("vector").combine_chunks()
        flat, offsets = vectors.flatten().to_numpy(), np.concatenate(([0], np.cumsum(dims)))
        number = 0
        for dim in np.unique(dims):
            chosen = np.nonzero(dims == dim)[0]
            chosen = chosen[np.lexsort((ids[chosen], -norms[chosen]))]
            for at in range(0, len(chosen), size):
                part = chosen[at : at + size]
                matrix = _narrow(flat[offsets[part][:, None] + np.arange(dim)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                        "dim": pa.array([dim], pa.int32()),
                        "longest": pa.array([float(norms[part[0]])]),
                        "ids": pa.array([ids[part].tobytes()], pa.binary()),
                        "vectors": pa.array([matrix.tobytes()], pa.binary()),
                    }
                )
                number += 1

    return rows.repartitionByRange(parts, "dim", "norm", "id").mapInArrow(build, _BLOCK)


class Vectors:
    """Ids, integer vectors and their lengths; other forms are made when they are asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(self.lengths.max())
        self._forms: dict = {}

    @classmethod
    def read(cls, ids: bytes, vectors: bytes, dim: int, *more):
        numbers = np.frombuffer(ids, np.int64)
        kind = np.dtype(f"i{len(memoryview(vectors)) // (len(numbers) * dim)}")
        return cls(numbers, np.frombuffer(vectors, kind).reshape(-1, dim), *more)

    def form(self, kind) -> np.ndarray:
        if kind not in self._forms:
            self._forms[kind] = self.vectors.astype(kind)
        return self._forms[kind]

    def columns(self) -> np.ndarray:
        """(coordinates, vectors): shares of unit vectors."""
        if "columns" not in self._forms:
            self._forms["columns"] = np.ascontiguousarray((self.vectors / np.maximum(self.lengths, 1e-300)[:, None]).T, np.float32)
        return self._forms["columns"]

    def focus(self) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, FOCUS): the coordinates of the largest shares, and these shares."""
        if "focus" not in self._forms:
            units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
            places = np.argsort(-np.abs(units), axis=1, kind="stable")[:, :FOCUS]
            self._forms["focus"] = places, np.take_along_axis(units, places, axis=1)
        return self._forms["focus"]


class Asked(Vectors):
    """A block of queries with their bounds and their best k so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        super().__init__(ids, vectors)
        self.least = np.full(len(ids), -np.inf)
        self.held = np.zeros(len(ids), np.int64)
        self.top_ids, self.top_scores = np.zeros((len(ids), k), np.int64), np.zeros((len(ids), k), np.int64)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Takes candidates of the queries at q in."""
        own, place = np.unique(q, return_inverse=True)
        k = self.top_ids.shape[1]
        held = np.arange(k) < self.held[own][:, None]
        place = np.concatenate((np.nonzero(held)[0], place))
        ids, scores = np.concatenate((self.top_ids[own][held], ids)), np.concatenate((self.top_scores[own][held], scores))
        order = np.lexsort((ids, -scores, place))
        place = place[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        best = rank < k
        place, rank, order = place[best], rank[best], order[best]
        self.top_ids[own[place], rank], self.top_scores[own[place], rank] = ids[order], scores[order]
        self.held[own] = np.bincount(place, minlength=len(own))
        full = own[self.held[own] == k]
        self.least[full] = np.maximum(self.least[full], self.top_scores[full, k - 1])


def _kind(q: Vectors, p: Vectors):
    """A type that computes products exactly: any partial sum is an integer of at most the lengths' product."""
    reach = q.longest * p.longest * (1 + SLACK)
    return np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64


def bounds(query_ids, queries, ids, vectors, k: int) -> np.ndarray:
    """Each query's k-th best product within one bucket; minus infinity if it holds fewer."""
    return _bounds(Vectors(query_ids, queries), Vectors(ids, vectors), k)


def _bounds(asked: Vectors, bucket: Vectors, k: int) -> np.ndarray:
    kind = _kind(asked, bucket)
    scores = (asked.form(kind) @ bucket.form(kind).T).astype(np.float64)
    scores[asked.ids[:, None] == bucket.ids[None, :]] = -np.inf
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, -k, axis=1)[:, -k].copy()  # else the block's bounds keep all its products


def _verified(asked: Vectors, bucket: Vectors, least: np.ndarray, rows: np.ndarray, fit: int):
    """(query, place, score) of the queries at `rows` and the first `fit` of the bucket that reach the bounds."""
    kind = _kind(asked, bucket)
    queries = asked.form(kind)
    scores = (queries if len(rows) == len(queries) else queries[rows]) @ bucket.form(kind)[:fit].T
    bound = least[rows][:, None]
    enough = np.flatnonzero(scores >= (bound if kind is np.int64 else bound.astype(kind)))
    q, y = np.divmod(enough, fit)
    return rows[q], y, scores.ravel()[enough].astype(np.int64)


def _by_shares(asked: Vectors, bucket: Vectors, least: np.ndarray, rows: np.ndarray, fit: np.ndarray, local: np.ndarray):
    """As _verified, for queries of high thresholds: coordinates first, then what they leave."""
    places, shares = (x[rows] for x in asked.focus())
    # A vector of length l needs a cosine of bound / (length * l) >= local.
    t, size = np.minimum(local, 1.0)[:, None], np.abs(shares)
    spread = np.sqrt(np.maximum(0.0, (1 - t * t) * (1 - size * size))) + 1e-6
    lowest = t * size - spread
    # A share that reaches t alone allows any rest: up to a vector along the coordinate.
    highest = np.where(size >= t, 1.0 + 1e-6, t * size + spread)
    low, high = np.where(shares < 0, -highest, lowest).astype(np.float32), np.where(shares < 0, -lowest, highest).astype(np.float32)
    columns, n = bucket.columns(), int(fit.max())
    share = columns[places[:, 0], :n]
    keep = share >= low[:, :1]
    keep &= share <= high[:, :1]
    keep &= np.arange(n) < fit[:, None]
    found = np.flatnonzero(keep)
    if len(found) * 8 > keep.size:
        return _verified(asked, bucket, least, rows, n)
    q, y = np.divmod(found, n)
    for f in range(1, places.shape[1]):
        share = columns[places[q, f], y]
        keep = (share >= low[q, f]) & (share <= high[q, f])
        q, y = q[keep], y[keep]
    q, kind = rows[q], _kind(asked, bucket)
    kind = np.float64 if kind is np.float32 else kind
    scores = np.empty(len(q), np.int64)
    for at in range(0, len(q), 1 << 14):
        own = slice(at, at + (1 << 14))
        scores[own] = np.einsum("ij,ij->i", asked.vectors[q[own]].astype(kind), bucket.vectors[y[own]].astype(kind))
    enough = scores >= least[q]
    return q[enough], y[enough], scores[enough]


def _candidates(asked: Vectors, bucket: Vectors, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place in the bucket, score) of all vectors of other ids that reach the queries' bounds."""
    reach = asked.lengths * bucket.longest
    local = np.where(reach > 0, least / np.maximum(reach, 1e-300), np.where(least <= 0, -np.inf, np.inf))
    # Lengths fall within a bucket: those long enough come first.
    needed = np.where(local > 0, least / np.maximum(asked.lengths, 1e-300) * (1 - SLACK), 0.0)
    fit = np.searchsorted(-bucket.lengths, -needed, "right")
    read = (local <= 1 + SLACK) & (fit > 0)
    short, long = np.flatnonzero(read & (local < COORDINATE)), np.flatnonzero(read & (local >= COORDINATE))
    found = []
    if len(short):
        found.append(_verified(asked, bucket, least, short, int(fit[short].max())))
    if len(long):
        found.append(_by_shares(asked, bucket, least, long, fit[long], local[long]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    q, y, scores = (np.concatenate(x) for x in zip(*found))
    other = asked.ids[q] != bucket.ids[y]
    return q[other], y[other], scores[other]


def search(query_ids, queries, least, ids, vectors, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of each query's best k within one bucket that reach its bound."""
    asked, bucket = Asked(query_ids, queries, k), Vectors(ids, vectors)
    q, y, scores = _candidates(asked, bucket, least)
    if len(q):
        asked.add(q, bucket.ids[y], scores)
    return [(number, i[:n], x[:n]) for number, n, i, x in zip(query_ids, asked.held, asked.top_ids, asked.top_scores) if n]


def top_products(rows: DataFrame, is_query: Column, k: int = K, id: str = "id", vector: str = "vector") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer products of each query row.

    `rows` has an id and a vector (array<bigint>) column; `is_query` marks the query rows.
    """
    spark = rows.sparkSession
    v = F.col("vector")
    read = rows.select(rows[id].cast("long").alias("id"), rows[vector].alias("vector"), is_query.alias("ask"))
    read = read.filter(v.isNotNull() & (F.size(v) > 0) & F.col("id").isNotNull()).select(
        "id", "ask", "vector", F.size(v).alias("dim"),
        F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm"),
    )
    read = written(read, "vectors")
    total, asking, width = read.agg(F.count("*"), F.coalesce(F.sum(F.col("ask").cast("long")), F.lit(0)), F.max("dim")).first()
    buckets = written(_blocks(read.select("id", "dim", "norm", "vector"), total, BUCKET), "buckets")
    asked = written(_blocks(read.filter("ask").select("id", "dim", "norm", "vector"), asking, QUERIES), "queries")
    # One bucket of at most BUCKET vectors for each dimension.
    longest = Window.partitionBy("dim").orderBy(F.desc("longest"), "block")
    first = buckets.select("block", "dim", "longest").withColumn("n", F.row_number().over(longest)).filter("n = 1")
    shards, groups = _grid(spark, total, asking, width or 1)
    number = F.shiftright("block", 32) * 4 + F.col("block").bitwiseAND((1 << 32) - 1)
    shard, group = F.pmod(number, F.lit(shards)), F.pmod(number, F.lit(groups))
    every, own = F.sequence(F.lit(0), F.lit(shards * groups - 1)), F.sequence(shard * groups, shard * groups + (groups - 1))
    # In a task: the longest bucket, the queries, then buckets by falling length.
    seeds = buckets.join(F.broadcast(first.select("block", "dim")), ["block", "dim"])
    met = (
        seeds.withColumn("kind", F.lit(0)).withColumn("task", F.explode(every.cast("array<long>")))
        .unionByName(asked.withColumn("kind", F.lit(1)).withColumn("task", F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda x: x * groups + group))))
        .unionByName(buckets.withColumn("kind", F.lit(2)).withColumn("task", F.explode(own)))
    )

    def searched(batches):
        key, seed, blocks = None, None, []
        for batch in batches:
            for row in range(batch.num_rows):
                task, dim, kind = (batch.column(c)[row].as_py() for c in ("task", "dim", "kind"))
                if (task, dim) != key:
                    yield from results(blocks)
                    key, seed, blocks = (task, dim), None, []
                raw = [batch.column(c)[row].as_buffer() for c in ("ids", "vectors")]
                if kind == 0:
                    seed = Vectors.read(*raw, dim)
                elif kind == 1:
                    block = Asked.read(*raw, dim, k)
                    block.least = _bounds(block, seed, k)
                    blocks.append(block)
                elif blocks:
                    bucket = Vectors.read(*raw, dim)
                    for block in blocks:
                        q, y, scores = _candidates(block, bucket, block.least)
                        if len(q):
                            block.add(q, bucket.ids[y], scores)
        yield from results(blocks)

    def results(blocks):
        for block in blocks:
            held = np.arange(k) < block.held[:, None]
            if held.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(block.ids, block.held)), pa.array(block.top_ids[held]), pa.array(block.top_scores[held])],
                    names=["query_id", "vec_id", "score"],
                )

    tasks = shards * groups
    met = met.repartition(min(4 * tasks, tasks + 1024) if tasks > 1 else 1, "task")
    met = met.sortWithinPartitions("task", "dim", "kind", F.desc("longest"), "block")
    results_of_tasks = met.select("task", "dim", "kind", "ids", "vectors").mapInArrow(
        searched, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = results_of_tasks.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _grid(spark: SparkSession, total: int, asking: int, width: int) -> tuple[int, int]:
    """Shards of the buckets and groups of the queries: as many tasks as keep the cluster busy, with little sent twice."""
    blocks, asks = max(1, -(-total // BUCKET)), max(1, -(-asking // QUERIES))
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), WAVES * spark.sparkContext.defaultParallelism, blocks * asks)
    shards = min(blocks, wanted, max(1, round((wanted * total / max(1, asking)) ** 0.5)))
    # Queries of a task: their numbers bounded, so that its memory is.
    groups = max(-(-wanted // shards), -(-asking * width // HELD))
    return shards, min(groups, asks)
