"""Embedding near-duplicates by product quantisation.

For each dimension, coarse centroids and, for the residuals, one codebook per subspace are fitted on
a bounded sample (`SAMPLE` vectors, `CELLS` lists at most, for all dimensions together); dimensions
with less than `CODES` sampled vectors are one list each and compared without codes. Every vector
is indexed: its list, the codes of its residual and the length of what the codes miss. A query probes every list that can hold a
neighbour: with r the distance of two unit vectors at the threshold, y can only lie in list c if
the border between c and the query's own list is within r of the query. In a list, distances come
from per-query tables over the codes; a vector stays a candidate unless the table distance exceeds
r plus its own quantisation error, so pruning loses nothing. Candidates are reranked by their
exact cosine in double precision.

Exact copies are indexed once with their number; rows find their class again by a hash, and by the
vector as well where hashes of two classes agree. The lists of a (label, dimension) stand in a row
that is cut into regions of equal size, through a hot list where need be. A task holds one region
with its lists: the region's own vectors meet there, and vectors of earlier regions come once for each
later region that has a list they probe, whatever the number of these lists. So each pair is met
once, a vector crosses the network as it was read, and codes and tables are made where they are used.
Tasks give back link counts and spanning links, never all pairs.

Defined results: rows whose label is null, or whose vector is null, empty, zero or holds null or
non-finite components link with nothing and are their own component; vectors link within their dimension
only; repeated vectors link with each other; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.shared import written
from tidemark.llm.simhash import _union
from tidemark.llm.topk import usable

THRESHOLD = 0.98
SAMPLE = 20_000
CELLS = 1024
LIST = 2000
SUBSPACES = 8
CODES = 64
# Vectors of a region: eight blocks at least, at most REGION; and how many labels of more than a region there can be.
BLOCK = 2048
REGION = 1 << 16
LAYOUTS = 4096
ROUNDS = 8
# Elements of a table distance matrix, and pairs that wait to be counted.
STEP = 1 << 19
PAIRS = 1 << 18
# What table distances may miss, in single precision.
SLACK = 1e-5


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :]
    return np.maximum(squares, 0.0)


def _kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows; empty lists keep their centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest = _distances(x, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        order = np.argsort(nearest, kind="stable")
        sums = np.zeros_like(centres)
        filled = sizes > 0
        sums[filled] = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(sizes[filled])[:-1])))
        centres[filled] = sums[filled] / sizes[filled][:, None]
    return centres


class Quantiser:
    """Coarse centroids and residual codebooks of one dimension."""

    def __init__(self, sample: np.ndarray, cells: int, subspaces: int = SUBSPACES, codes: int = CODES):
        self.dim = sample.shape[1]
        self.centres = _kmeans(sample, cells)
        residuals = sample - self.centres[_distances(sample, self.centres).argmin(axis=1)]
        self.cuts = np.linspace(0, self.dim, min(subspaces, self.dim) + 1).astype(int)
        self.books = [_kmeans(residuals[:, a:b], codes, 4) for a, b in zip(self.cuts, self.cuts[1:])]
        self.apart = np.sqrt(_distances(self.centres, self.centres))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each vector, and squared distances to all centres."""
        to_centres = _distances(x, self.centres)
        cell = to_centres.argmin(axis=1)
        residual = x - self.centres[cell]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        missed = np.zeros(len(x))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            d = _distances(residual[:, a:b], self.books[m])
            codes[:, m] = d.argmin(axis=1)
            missed += ((residual[:, a:b] - self.books[m][codes[:, m]]) ** 2).sum(axis=1)
        return cell, codes, np.sqrt(missed), to_centres

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List of each vector, and squared distances to all centres."""
        to_centres = _distances(x, self.centres)
        return to_centres.argmin(axis=1), to_centres

    def probes(self, cell: np.ndarray, to_centres: np.ndarray, radius: float) -> np.ndarray:
        """(vectors, lists): whether a list can hold a vector within the radius."""
        own = to_centres[np.arange(len(cell)), cell]
        return to_centres - own[:, None] <= 2 * radius * self.apart[cell] + 1e-9

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(subspaces * codes, queries): products of the queries with all codes, which hold for every list.

        With residual r = x - c and code z, (r - z)^2 = r^2 + (z^2 + 2cz) - 2xz: the first is the distance to
        the centre, the bracket belongs to the indexed vector (`weights`), the last is in these tables.
        """
        parts = [book @ queries[:, a:b].T for a, b, book in zip(self.cuts, self.cuts[1:], self.books)]
        return np.concatenate(parts).astype(np.float32)

    def weights(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What an indexed vector adds to its table distances from all queries."""
        total = np.zeros(len(cell))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            z = self.books[m][codes[:, m]]
            total += (z * (z + 2 * self.centres[cell, a:b])).sum(axis=1)
        return total

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """(subspaces, vectors): rows of the tables that the codes stand for."""
        return np.ascontiguousarray((codes + np.concatenate(([0], np.cumsum([len(book) for book in self.books])[:-1]))).T)


class Whole:
    """One list without codes, for a dimension with few vectors: every pair is compared."""

    def __init__(self, dim: int):
        self.dim = dim
        self.books: list[np.ndarray] = []

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(x)
        return np.zeros(n, np.int64), np.empty((n, 0), np.uint8), np.zeros(n), np.zeros((n, 1))

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(len(x), np.int64), np.zeros((len(x), 1))

    def probes(self, cell: np.ndarray, to_centres: np.ndarray, radius: float) -> np.ndarray:
        return np.ones((len(cell), 1), bool)


def _models(sample: list[list[float]], total: int, cells: int) -> dict[int, Quantiser]:
    """A quantiser for each dimension that the sample has enough vectors of."""
    by_dim: dict[int, list] = {}
    for vector in sample:
        by_dim.setdefault(len(vector), []).append(vector)
    models = {}
    for dim, own in by_dim.items():
        if len(own) >= CODES:
            share = len(own) / len(sample)
            lists = int(np.clip(int(total * share) // LIST, 1, max(1, int(cells * share))))
            models[dim] = Quantiser(_unit(np.array(own, np.float64)), lists)
    return models


def _near(model, tables, away, queries, index, rows, limits, threshold):
    """(query row, index row) pairs of one list with an exact cosine of at least the threshold, piece by piece.

    `tables` has the queries' products, `away` their squared distances to the list's centre; `rows` are the
    index vectors' rows in the tables, `limits` their weights less the square of what is near.
    """
    step = max(1, STEP // max(1, len(index)))
    for at in range(0, len(queries), step):
        part = queries[at : at + step]
        dense = None
        if model.books:
            own = np.ascontiguousarray(tables[:, at : at + step])
            products = np.take(own, rows[0], axis=0)
            taken = np.empty_like(products)
            for codes in rows[1:]:
                products += np.take(own, codes, axis=0, out=taken, mode="clip")
            products -= (limits / 2 - SLACK).astype(np.float32)[:, None]
            y, q = np.divmod(np.flatnonzero(products >= (away[at : at + step] / 2).astype(np.float32)), len(part))
            if len(q) * 8 > products.size:
                dense = part @ index.T
        else:
            dense = part @ index.T
        if dense is not None:
            q, y = np.nonzero(dense >= threshold - 1e-9)
            close = dense[q, y] >= threshold + 1e-9
            edge = np.flatnonzero(~close)
            close[edge] = np.einsum("ij,ij->i", part[q[edge]], index[y[edge]]) >= threshold
        else:
            close = np.empty(len(q), bool)
            for piece in range(0, len(q), 1 << 14):
                own = slice(piece, piece + (1 << 14))
                close[own] = np.einsum("ij,ij->i", part[q[own]], index[y[own]]) >= threshold
        if close.any():
            yield q[close] + at, y[close]


def _match(model, cell, queries, index, codes, errors, radius, threshold) -> tuple[np.ndarray, np.ndarray]:
    """(query row, index row) pairs of one list with an exact cosine of at least the threshold."""
    tables = away = rows = limits = None
    if model.books:
        tables, away = model.tables(queries), _distances(queries, model.centres[cell][None, :])[:, 0]
        rows, limits = model.rows(codes), model.weights(np.full(len(codes), cell), codes) - (radius + errors) ** 2
    found = [*_near(model, tables, away, queries, index, rows, limits, threshold)]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *(q for q, _ in found)]), np.concatenate([none, *(y for _, y in found)])


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def near_duplicates(
    rows: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    cells: int = CELLS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = F.col("vector")
    element = getattr(rows.schema[vector].dataType, "elementType", None)
    kind = "float" if isinstance(element, T.FloatType) else "double"
    read = rows.select(
        rows[id].cast("long").alias("id"), rows[label].cast("string").alias("label"), rows[vector].cast(f"array<{kind}>").alias("vector")
    )
    valid = usable(v) & F.col("label").isNotNull() & F.exists(v, lambda x: x != 0)
    read = read.withColumn("valid", F.coalesce(valid, F.lit(False)))
    classes = written(
        read.filter("valid").groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies")),
        "classes",
    )
    total, hashes = classes.agg(F.count("*"), F.countDistinct(_hash())).first()
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    if total:
        share = min(1.0, 1.2 * sample / total)
        chosen = classes.filter(F.pmod(F.xxhash64("first"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        fit = chosen.orderBy("first").limit(sample).select("vector").toArrow()
        models = _models(fit.column("vector").to_pylist(), total, cells)
        found = written(_links(classes, models, radius, threshold, total, np.float32 if kind == "float" else np.float64), "found")
    else:
        found = read.sparkSession.createDataFrame([], "a long, b long, n long")
    linked = components(found.filter("n is null").select("a", "b"))
    counts = found.filter("n is not null").groupBy(F.col("a").alias("first")).agg(F.sum("n").alias("others"))
    # Where two classes have one hash, their rows are told apart by label and vector.
    exact = [] if hashes == total else ["label", "vector"]
    named = (
        classes.withColumn("hash", _hash()).select("hash", "first", "copies", *exact).join(counts, "first", "left")
        .join(linked, F.col("first") == linked["id"], "left")
        .select(
            "hash",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
            *exact,
        )
    )
    usable_rows = read.filter("valid").withColumn("hash", _hash()).select("id", "hash", *exact).join(named, ["hash", *exact])
    result = usable_rows.select("id", "n_links", "component_id").union(
        read.filter("not valid").select("id", F.lit(0).cast("long"), "id")
    )
    return result.select(
        F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _hash() -> Column:
    """The same for 0.0 and -0.0, as grouping has it."""
    return F.xxhash64("label", "vector")


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as one binary value each."""
    data = np.ascontiguousarray(matrix)
    ends = np.arange(len(data) + 1, dtype=np.int64) * data.shape[1] * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


class Layout:
    """Where the lists of a (label, dimension) stand, and the cuts of that row into regions of equal size."""

    def __init__(self, cells: np.ndarray, sizes: np.ndarray, lists: int, region: int):
        self.sizes = np.ones(lists, np.int64)  # also for lists without vectors, as rounding may differ at a border
        self.sizes[cells] = sizes
        self.ends = np.cumsum(self.sizes)
        self.total = int(self.ends[-1])
        self.regions = -(-self.total // region)
        # Askers of a region are dealt into parts, each with the region's rows.
        before = np.arange(self.regions) * self.total // self.regions
        self.parts = np.maximum(1, -(-before // (4 * region)))

    def region(self, cell: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Regions of vectors in these lists; share is in 0 to 1 and spreads a list over its places."""
        sizes = self.sizes[cell]
        place = self.ends[cell] - sizes + np.minimum((share * sizes).astype(np.int64), sizes - 1)
        return place * self.regions // self.total

    def asked(self, probed: np.ndarray) -> np.ndarray:
        """(vectors, regions): whether a region has places of a probed list."""
        first, last = (x * self.regions // self.total for x in (self.ends - self.sizes, self.ends - 1))
        out = np.zeros((len(probed), self.regions), bool)
        for g in range(self.regions):
            out[:, g] = probed[:, np.searchsorted(last, g) : np.searchsorted(first, g, "right")].any(axis=1)
        return out


_MET = "label string, dim int, region int, part int, ask boolean, first long, copies long, vector binary"


def _links(classes: DataFrame, models: dict[int, Quantiser], radius: float, threshold: float, total: int, kind: type) -> DataFrame:
    """Per class (a, null, n): copies it links with, in parts; and (a, b, null): spanning links."""
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Two tasks for each core: more regions would keep it no busier, and more of them are asked.
    cores = classes.sparkSession.sparkContext.defaultParallelism
    region = max(8 * BLOCK, min(REGION, total // (2 * cores)), total // LAYOUTS)
    sized = classes.withColumn("dim", F.size("vector"))
    large = {(r["label"], r["dim"]) for r in sized.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > region).collect()}

    def pieces(batches):
        """(label or none, dim, rows, their vectors): by label where it has more than a region."""
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    same = part.filter(pa.array(dims == dim)) if (dims != dim).any() else part
                    vectors = same.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    coded = same.column("label").dictionary_encode()
                    own = [i for i, label in enumerate(coded.dictionary.to_pylist()) if (label, dim) in large]
                    places = coded.indices.to_numpy()
                    for i in own:
                        yield coded.dictionary[i].as_py(), dim, same, np.flatnonzero(places == i), vectors
                    yield None, dim, same, np.flatnonzero(~np.isin(places, own)), vectors

    def listed(batches):
        for label, dim, _, rows, vectors in pieces(batches):
            if label is not None:
                cells, sizes = np.unique((models.get(dim) or Whole(dim)).lists(_unit(vectors[rows].astype(np.float64)))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(cells)), pa.array(np.full(len(cells), dim, np.int32)), pa.array(cells.astype(np.int32)), pa.array(sizes)],
                    names=["label", "dim", "cell", "n"],
                )

    layouts = {}
    if large:
        sizes = sized.select("label", "dim", "vector").mapInArrow(listed, "label string, dim int, cell int, n long")
        sizes = sizes.groupBy("label", "dim", "cell").agg(F.sum("n").alias("n"))
        for r in sizes.groupBy("label", "dim").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("sizes")).toLocalIterator():
            lists = models[r["dim"]].centres if r["dim"] in models else [None]
            layouts[r["label"], r["dim"]] = Layout(np.array(r["cells"]), np.array(r["sizes"]), len(lists), region)

    def placed(batches):
        for label, dim, batch, rows, vectors in pieces(batches):
            regions = deals = np.zeros(len(rows), np.int64)
            asking = np.zeros(len(rows), bool)
            if label is not None:
                model, layout = models.get(dim) or Whole(dim), layouts[label, dim]
                cell, to_centres = model.lists(_unit(vectors[rows].astype(np.float64)))
                place = batch.column("place").to_numpy()[rows]
                own = layout.region(cell, place / (1 << 30))
                asker, asked = np.nonzero(layout.asked(model.probes(cell, to_centres, radius)) & (np.arange(layout.regions) > own[:, None]))
                copies = layout.parts[own]
                held = np.repeat(np.arange(len(rows)), copies)
                deals = np.arange(len(held)) - np.repeat(np.cumsum(copies) - copies, copies)
                deals = np.concatenate((deals, place[asker] % layout.parts[asked]))
                regions = np.concatenate((own[held], asked))
                asking = np.arange(len(regions)) >= len(held)
                rows = rows[np.concatenate((held, asker))]
            for at in range(0, len(rows), 1 << 14):
                some = slice(at, at + (1 << 14))
                part = batch.take(pa.array(rows[some]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label"),
                        part.column("dim"),
                        pa.array(regions[some].astype(np.int32)),
                        pa.array(deals[some].astype(np.int32)),
                        pa.array(asking[some]),
                        part.column("first"),
                        part.column("copies"),
                        _binary(vectors[rows[some]].astype(kind, copy=False)),
                    ],
                    names=["label", "dim", "region", "part", "ask", "first", "copies", "vector"],
                )

    group = ["label", "dim", "region", "part"]

    def compare(batches):
        key, held, current = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows, bool)
            for c in (*group, "ask"):
                column = batch.column(c)
                change[1:] |= pa.compute.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for s, e in zip(starts, starts[1:]):
                part = batch.slice(s, e - s)
                now, ask = tuple(part.column(c)[0].as_py() for c in group), part.column("ask")[0].as_py()
                if now != key:
                    if held:
                        yield from (current or Region(key, held, models, radius, threshold, kind)).ended()
                    key, held, current = now, [], None
                if not ask:
                    held.append(part)
                elif held:
                    current = current or Region(key, held, models, radius, threshold, kind)
                    yield from current.ask(part)
        if held:
            yield from (current or Region(key, held, models, radius, threshold, kind)).ended()

    place = F.pmod(F.xxhash64("first"), F.lit(1 << 30))
    met = sized.withColumn("place", place).mapInArrow(placed, _MET)
    tasks = max(parts, min(4 * parts, total // BLOCK))
    return met.repartition(tasks, *group).sortWithinPartitions(*group, "ask").mapInArrow(compare, "a long, b long, n long")


def _found(a: np.ndarray, b: np.ndarray, counted: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Links (a, b, null) and counts (counted, null, n)."""
    last = np.arange(len(a) + len(counted)) >= len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((a, counted))),
            pa.array(np.concatenate((b, np.zeros(len(counted), np.int64))), mask=last),
            pa.array(np.concatenate((np.zeros(len(a), np.int64), n)), mask=~last),
        ],
        names=["a", "b", "n"],
    )


class Region:
    """The lists of one region, whose vectors meet each other and those that ask."""

    def __init__(self, key: tuple, batches: list, models: dict[int, Quantiser], radius: float, threshold: float, kind: type):
        _, self.dim, _, part = key
        self.model, self.radius, self.threshold, self.kind = models.get(self.dim) or Whole(self.dim), radius, threshold, kind
        first, copies, unit = self._read(pa.Table.from_batches(batches))
        n = len(first)
        cell, limits, rows = np.zeros(n, np.int64), np.zeros(n), np.zeros((len(self.model.books), n), np.int64)
        for at in range(0, n if self.model.books else 0, 4096):
            own = slice(at, at + 4096)
            cell[own], codes, errors, _ = self.model.encode(unit[own])
            limits[own] = self.model.weights(cell[own], codes) - (radius + errors) ** 2
            rows[:, own] = self.model.rows(codes)
        order = np.argsort(cell, kind="stable")
        self.first, self.copies, self.unit = first[order], copies[order], unit[order]
        self.cell, self.limits, self.rows = cell[order], limits[order], rows[:, order]
        self.cells, self.starts = np.unique(self.cell, return_index=True)
        self.ends = np.append(self.starts[1:], n)
        # Nodes of the links, by rising id: a component's root is its smallest.
        self.names, self.node = np.unique(self.first, return_inverse=True)
        self.roots, self.counts = np.arange(n), np.zeros(n, np.int64)
        for at in range(0, n if part == 0 and n > 1 else 0, 2048):
            own = slice(at, at + 2048)
            self.counts[own] += self._meet(self.unit[own], self.copies[own], at)[0]

    def _read(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), self.kind).reshape(-1, self.dim)
        unit = np.empty(raw.shape)
        for at in range(0, len(raw), 4096):
            unit[at : at + 4096] = _unit(raw[at : at + 4096].astype(np.float64))
        return table.column("first").to_numpy(), table.column("copies").to_numpy(), unit

    def _pairs(self, queries: np.ndarray, offset: int | None):
        """(query, place) that link. Queries that stand in the region from `offset` on meet later places only."""
        cell, to_centres = self.model.lists(queries)
        probed = self.model.probes(cell, to_centres, self.radius)[:, self.cells]
        if offset is not None:
            probed &= offset + np.arange(len(queries))[:, None] < self.ends
        tables = self.model.tables(queries) if self.model.books else None
        for k in np.flatnonzero(probed.any(axis=0)).tolist():
            s, e, q = self.starts[k], self.ends[k], np.flatnonzero(probed[:, k])
            mine = (None, None) if tables is None else (np.take(tables, q, axis=1), to_centres[q, self.cells[k]])
            for a, b in _near(self.model, *mine, queries[q], self.unit[s:e], self.rows[:, s:e], self.limits[s:e], self.threshold):
                a, b = q[a], b + s
                if offset is not None:
                    later = a + offset < b
                    a, b = a[later], b[later]
                if len(a):
                    yield a, b

    def _meet(self, queries: np.ndarray, copies: np.ndarray, offset: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Copies that each query links with, and the queries' roots; what the places link with is added up here."""
        n, counts = len(self.first), np.zeros(len(queries), np.int64)
        nodes = n + np.arange(len(queries)) if offset is None else self.node[offset : offset + len(queries)]
        roots = np.concatenate((self.roots, nodes)) if offset is None else self.roots
        pending, waiting = [], 0

        def count():
            a, b = (np.concatenate(x) for x in zip(*pending))
            pending.clear()
            counts[:] += np.bincount(a, weights=self.copies[b], minlength=len(counts)).astype(np.int64)
            self.counts += np.bincount(b, weights=copies[a], minlength=n).astype(np.int64)
            return _union(roots, self.node[b], nodes[a])

        for a, b in self._pairs(queries, offset):
            pending.append((a, b))
            waiting += len(a)
            if waiting >= PAIRS:
                roots, waiting = count(), 0
        if pending:
            roots = count()
        self.roots = roots[:n]
        return counts, roots[n:]

    def ask(self, batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 2048):
            ids, copies, queries = self._read(pa.Table.from_batches([batch.slice(at, 2048)]))
            counts, roots = self._meet(queries, copies)
            some = np.flatnonzero(counts)
            if len(some):
                yield _found(ids[some], self.names[roots[some]], ids[some], counts[some])

    def ended(self):
        """Links and counts of the region's own vectors."""
        apart, some = np.flatnonzero(self.roots != np.arange(len(self.roots))), np.flatnonzero(self.counts)
        if len(some):
            yield _found(self.names[apart], self.names[self.roots[apart]], self.first[some], self.counts[some])
