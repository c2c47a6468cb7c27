"""Sampled sentence-piece segmentations and lossless decoding.

Forward filtering, backward sampling over the lattice of all pieces: a piece has the weight
exp(alpha * log p), with log p from its rank in the vocabulary (Zipf's law: 1 / rank), and a
segmentation the product of its pieces' weights. Forward sums are taken from left to right; a
segmentation is then drawn backwards, each piece with its exact conditional probability.

No piece spans two words (`token_counts.prove` checks it), so the lattice falls apart into runs of
space marks and the characters after them. Lattices of distinct runs are kept in flat arrays, and
all runs of a batch are sampled at once. Draws are hashes of (seed, row key, run, position): a row
gets the same segmentation whatever batch, task or attempt it is in.

Defined results: null texts have null ids and decode to null; empty texts have no ids; characters
without a piece are bytes; the space mark itself, when it stands in a text, is spelled as bytes, so
that decoding returns exactly the text; rows of equal key and text get equal segmentations; other
columns are not read.
"""

from __future__ import annotations

from array import array
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import by_batch, keyed_text, stretches, with_fields
from tidemark.llm.token_counts import MARK, RUNS, _processor, prove

ALPHA = 1.0
# Bytes weigh like pieces of this rank; runs up to this length have their lattices built together.
BYTE_RANK = 1_000_000
TOGETHER = 48
# Lattice edges kept before the arrays are emptied, and characters sampled at a time.
EDGES = 2_000_000
AT_ONCE = 300_000
# Stands for a space mark within a text; can not occur in one.
_LITERAL = "\ud800"


class Vocabulary:
    """Pieces with ids and log weights, bytes, and what each id spells."""

    def __init__(self, path: str, alpha: float):
        prove(path)
        model = _processor(path)
        self.ids: dict[str, int] = {}
        self.weight: dict[str, float] = {}
        self.spelled: list[bytes] = []
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        by_byte = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        rank = 0
        for i in range(model.get_piece_size()):
            if i in by_byte:
                self.spelled.append(by_byte[i])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                rank += 1
                piece = model.id_to_piece(i)
                self.ids[piece] = i
                self.weight[piece] = -alpha * float(np.log(rank))
                self.spelled.append(piece.replace(MARK, " ").encode())
        self.byte_weight = -alpha * float(np.log(BYTE_RANK))
        self.longest = max(map(len, self.ids))

    def edge(self, part: str) -> tuple[int, float] | None:
        """Code and log weight of a piece; a character without one has the code -1 - its number."""
        if part in self.ids:
            return self.ids[part], self.weight[part]
        if len(part) == 1:
            shown = MARK if part == _LITERAL else part
            return -1 - ord(shown), self.byte_weight * len(shown.encode())
        return None

    def lattice(self, run: str) -> list[list[tuple[int, int, float]]]:
        """For each end 1 .. len(run): (start, code, probability given the end)."""
        forward, ends = [0.0], []
        for end in range(1, len(run) + 1):
            into = []
            for start in range(max(0, end - self.longest), end):
                found = self.edge(run[start:end])
                if found:
                    into.append((start, found[0], forward[start] + found[1]))
            most = max(w for _, _, w in into)
            total = most + float(np.log(sum(np.exp(w - most) for _, _, w in into)))
            forward.append(total)
            ends.append([(s, c, float(np.exp(w - total))) for s, c, w in into])
        return ends


@cache
def vocabulary(path: str, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(path, alpha)


class _Lattices:
    """Flat lattices of many runs: the edges into node g begin at `firsts[g]`, and their
    cumulated probabilities, the last of which is 1, are kept as g + p."""

    def __init__(self, words: Vocabulary):
        self._words = words
        # All pieces as a tree: the step from a node by a character leads to the node with the
        # number of the step, and 0 is the root.
        steps: dict[int, int] = {}
        held: dict[int, str] = {}
        for piece in words.ids:
            node = 0
            for c in piece:
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            held[node] = piece
        self._steps = pd.Index(np.fromiter(steps, np.int64, len(steps)))
        self._ids = np.full(len(steps) + 1, -1, np.int64)
        self._logs = np.zeros(len(steps) + 1)
        for node, piece in held.items():
            self._ids[node], self._logs[node] = words.ids[piece], words.weight[piece]
        self.clear()

    def clear(self) -> None:
        self.nodes: dict[str, int] = {}
        self.count = 0
        self.sums, self.starts, self.codes, self.firsts = array("d"), array("i"), array("i"), array("i")

    def of(self, runs: list[str]) -> list[int]:
        """First node of each run, the lattices built where they are new."""
        if len(self.sums) > EDGES:
            self.clear()
        new = [r for r in dict.fromkeys(runs) if r not in self.nodes]
        short = [r for r in new if len(r) <= TOGETHER]
        for at in range(0, len(short), 20_000):
            self._build(short[at : at + 20_000])
        for run in new:
            if len(run) > TOGETHER:
                self._append(run)
        return [self.nodes[r] for r in runs]

    def _append(self, run: str) -> None:
        base = self.count
        self.firsts.append(len(self.sums))
        for end, into in enumerate(self._words.lattice(run), 1):
            total = 0.0
            self.firsts.append(len(self.sums))
            for place, (start, code, p) in enumerate(into):
                total += p
                self.sums.append(base + end + (1.0 if place == len(into) - 1 else min(total, 1.0)))
                self.starts.append(base + start)
                self.codes.append(code)
        self.nodes[run] = base
        self.count = base + len(run) + 1

    def _build(self, runs: list[str]) -> None:
        """Lattices of short runs at once: all pieces from all places, then all runs in step."""
        if not runs:
            return
        sizes = np.array([len(r) for r in runs])
        chars = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), np.int32).astype(np.int64)
        run = np.repeat(np.arange(len(runs)), sizes)
        position = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node = position + (np.cumsum(sizes + 1) - sizes - 1)[run]  # counted from the first new one
        left = sizes[run] - position
        start, length, code, weight = self._edges(chars, left)
        end = position[start] + length
        order = np.argsort((node[start] + length) * 32 + 32 - length)
        start, length, code, weight, end = (x[order] for x in (start, length, code, weight, end))
        into = node[start] + length
        nodes = int(len(chars) + len(runs))
        forward = np.zeros(nodes)
        cumulated = np.empty(len(start))
        by_end = np.argsort(end.astype(np.uint8), kind="stable")
        bounds = np.searchsorted(end[by_end], np.arange(1, int(sizes.max()) + 2))
        for low, high in zip(bounds, bounds[1:]):
            edges = by_end[low:high]
            target = into[edges]
            first = np.nonzero(np.append(True, target[1:] != target[:-1]))[0]
            each = np.diff(np.append(first, len(edges)))
            values = forward[node[start[edges]]] + weight[edges]
            most = np.maximum.reduceat(values, first)
            shares = np.exp(values - np.repeat(most, each))
            totals = np.add.reduceat(shares, first)
            forward[target[first]] = most + np.log(totals)
            shares /= np.repeat(totals, each)
            sums = np.cumsum(shares)
            sums -= np.repeat(sums[first] - shares[first], each)
            sums[first + each - 1] = 1.0
            cumulated[edges] = np.minimum(sums, 1.0)
        counts = np.bincount(into, minlength=nodes)
        self.firsts.frombytes((len(self.sums) + np.cumsum(counts) - counts).astype(np.int32).tobytes())
        self.sums.frombytes((self.count + into + cumulated).tobytes())
        self.starts.frombytes((self.count + node[start]).astype(np.int32).tobytes())
        self.codes.frombytes(code.astype(np.int32).tobytes())
        self.nodes.update(zip(runs, (self.count + node[position == 0]).tolist()))
        self.count += nodes

    def _edges(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place, length, code, log weight) of all pieces, and of characters without one."""
        found = []
        place, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        for length in range(1, self._words.longest + 1):
            node = self._steps.get_indexer(node << 21 | chars[place + length - 1]) + 1
            place, node = place[node > 0], node[node > 0]
            whole = self._ids[node] >= 0
            found.append((place[whole], np.full(int(whole.sum()), length), self._ids[node[whole]], self._logs[node[whole]]))
            if length == 1:
                bare = np.ones(len(chars), bool)
                bare[place[whole]] = False
                bare = np.nonzero(bare)[0]
                shown = np.where(chars[bare] == ord(_LITERAL), ord(MARK), chars[bare])
                spelled = 1 + (shown >= 0x80) + (shown >= 0x800) + (shown >= 0x10000)
                found.append((bare, np.ones(len(bare), np.int64), -1 - shown, self._words.byte_weight * spelled))
            more = left[place] > length
            place, node = place[more], node[more]
            if not len(place):
                break
        return tuple(np.concatenate(x) for x in zip(*found))


def _uniform(seed: np.ndarray, run: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on nothing but the arguments."""
    with np.errstate(over="ignore"):
        x = seed + run.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for _ in range(2):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = (x ^ (x >> np.uint64(31))) + position.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
            position = np.zeros_like(position)
    # So few digits that adding a node's number loses none of them.
    return (x >> np.uint64(36)).astype(np.float64) * 2.0**-28


@cache
def _lattices(path: str, alpha: float) -> _Lattices:
    return _Lattices(vocabulary(path, alpha))


def _runs(text: str) -> list[str]:
    if MARK in text:
        text = text.replace(MARK, _LITERAL)
    return RUNS.findall(MARK + text.replace(" ", MARK))


def sample(texts: list[str | None], seeds: np.ndarray, path: str, alpha: float = ALPHA) -> list[np.ndarray | None]:
    """Ids of one sampled segmentation for each text."""
    code, bounds = _sampled(texts, seeds, path, alpha)
    return [None if t is None else code[bounds[i] : bounds[i + 1]] for i, t in enumerate(texts)]


def _sampled(texts: list[str | None], seeds: np.ndarray, path: str, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's begin and end."""
    lattices = _lattices(path, alpha)
    split = [_runs(t) if t else [] for t in texts]
    flat = [r for runs in split for r in runs]
    counts = np.array([len(runs) for runs in split], np.int64)
    if not flat:
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    base = np.array(lattices.of(flat), np.int64)
    sums, firsts = np.frombuffer(lattices.sums, np.float64), np.frombuffer(lattices.firsts, np.int32)
    starts, codes = np.frombuffer(lattices.starts, np.int32), np.frombuffer(lattices.codes, np.int32)
    number = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    seed = np.repeat(seeds.astype(np.uint64), counts)
    node = base + np.fromiter(map(len, flat), np.int64, len(flat))
    active = np.arange(len(flat))
    drawn = []
    while len(active):
        here, own = node[active], base[active]
        sought = here + _uniform(seed[active], number[active], here - own)
        edge = firsts[here].astype(np.int64)
        late = np.nonzero(sums[edge] <= sought)[0]
        while len(late):
            edge[late] += 1
            late = late[sums[edge[late]] <= sought[late]]
        drawn.append((active, codes[edge]))
        to = starts[edge]
        node[active] = to
        active = active[to != own]
    del sums, firsts, starts, codes  # the arrays can not grow while they are looked at
    # A run's pieces were drawn from its end: the last draw comes first.
    sizes = np.zeros(len(flat), np.int64)
    for run, _ in drawn:
        sizes[run] += 1
    ends = np.cumsum(sizes)
    code = np.empty(int(ends[-1]), np.int32)
    for step, (run, own) in enumerate(drawn):
        code[ends[run] - 1 - step] = own
    if (code < 0).any():
        code, ends = _with_bytes(code, ends, vocabulary(path, alpha))
    return code, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]


def _with_bytes(code: np.ndarray, ends: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece spelled as bytes; the places after each run move along."""
    odd = np.nonzero(code < 0)[0]
    spelled = [[words.bytes[b] for b in chr(-1 - c).encode()] for c in code[odd].tolist()]
    times = np.ones(len(code), np.int64)
    times[odd] = [len(ids) for ids in spelled]
    after = np.concatenate(([0], np.cumsum(times)))
    longer = np.repeat(code, times)
    for at, ids in zip(after[odd].tolist(), spelled):
        longer[at : at + len(ids)] = ids
    return longer, after[ends]


def decode_ids(ids, path: str) -> str | None:
    """The text of ids: pieces spelled out, without the space that stands before every text."""
    if ids is None:
        return None
    spelled = vocabulary(path).spelled
    return b"".join([spelled[i] for i in ids])[1:].decode("utf-8", "replace")


def encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", alpha: float = ALPHA, seed: int = 0
) -> DataFrame:
    """One row per document: key, ids (array<int>) of a segmentation sampled under the row's key."""
    read = keyed_text(docs, key, text).withColumn("seed", F.xxhash64(F.col("key").cast("string"), F.lit(seed)))

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        seeds = batch.column("seed").to_numpy().view(np.uint64)
        texts = batch.column("text").to_pylist()
        parts = [_sampled(texts[a:b], seeds[a:b], model, alpha) for a, b in stretches(texts, AT_ONCE)]
        sizes = np.concatenate([np.diff(bounds) for _, bounds in parts])
        offsets = pa.array(
            np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), mask=np.array([t is None for t in texts] + [False])
        )
        ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([code for code, _ in parts])))
        return pa.RecordBatch.from_arrays([batch.column("key"), ids], names=["key", "ids"])

    return by_batch(read, encoded, with_fields(read, "key", more="ids array<int>")).withColumnRenamed("key", key)


def with_decoded(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """`encoded`, all columns, with the `text` its ids spell."""

    @F.pandas_udf("string")
    def spell(rows: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(x if x is None else x.tolist(), model) for x in rows], dtype=object)

    return encoded.withColumn("text", spell(ids))
