"""Document scores by masked pseudo-likelihood.

A network looks at two words on both sides of a word and gives the probability of every word of
the vocabulary in between; a document's score is the sum of the log probabilities of all its
words. The most frequent words are outputs of the network; each other word falls into one of
`BUCKETS` hash buckets, which are outputs as well, and has a share of its bucket by its count: words
are counted in hash slots, whose number follows the number of distinct words. A word that the
corpus does not have gets a share of what words seen once take, among as many words as there are.

What is learned comes from the whole corpus and grows with it: counts over all documents choose
the vocabulary and the shares, and every document trains the network once. Training is
data-parallel: documents are dealt into `ROUNDS` rounds by a hash of id and text; in a round every
task starts from the same weights and runs Adagrad over its part in numpy, and the weights,
averaged by words seen in a shuffle of weight chunks, start the next round. The driver holds one
copy of the weights and of the slots, `MOST_SLOTS` at most.

Probabilities are taken in two steps, class and word within class, so a word costs 2 * 64 outputs
instead of 4,096. Scores do not depend on how rows are spread; fitting does, a little: batches
are what a task sees in a row.

Defined results: null and empty texts have 0 words, log_prob 0 and a null mean; without any words
to learn from all words score alike; repeated rows are scored each; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import by_batch, distinct, keyed_text, stretches, with_fields, written
from tidemark.plans.keyset import KeySet

CLASSES = 64
VOCABULARY = CLASSES * CLASSES
BUCKETS = 256
WIDTH = 16
SIDES = (-2, -1, 1, 2)
ROUNDS = 4
# Words of a training step: few at first, then a share of what the task has seen.
LEAST_BATCH, MOST_BATCH, BATCH_SHARE = 256, 16_384, 8
RATE = 0.1
# Hash slots of words beyond the vocabulary.
MOST_SLOTS = 1 << 20
WORDS_PER_SLOT = 4
# A word's id and the log of its share travel as one number: id * SCALE - log share.
SCALE = 1024.0
# Words scored at a time, characters encoded at a time, distinct words counted before they leave a
# task, weights per row.
AT_ONCE = 1 << 14
ENCODED = 1 << 21
COUNTED = 300_000
CHUNK = 1 << 16
NAMES = ("context", "bias", "class_out", "class_bias", "word_out", "word_bias")


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class Rest:
    """Words beyond the vocabulary: log shares of their buckets. A word's hash names its slot by
    its lower bits, and the bucket by the lowest of these; `seen` is a bitmap of all words."""

    slots: np.ndarray
    unseen: np.ndarray
    seen: np.ndarray

    def shares(self, hashes: np.ndarray) -> np.ndarray:
        one, low = np.uint64(1), np.uint64(63)
        masks = np.zeros(len(hashes), np.uint64)
        for at in (0, 6, 12):
            masks |= one << (hashes >> np.uint64(at) & low)
        words = self.seen[hashes >> np.uint64(64 - (len(self.seen).bit_length() - 1))]
        slots, buckets = (hashes & np.uint64(n - 1) for n in (len(self.slots), BUCKETS))
        return np.where(words & masks == masks, self.slots[slots], self.unseen[buckets])


@dataclass
class Network:
    """The vocabulary (word -> id), the other words and the weights; id VOCABULARY stands beyond a
    text's ends."""

    ids: dict[str, int]
    weights: dict[str, np.ndarray]
    rest: Rest

    def _codes(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        codes = ids * SCALE
        others = np.nonzero(ids < 0)[0]
        beyond, digest = [words[i] for i in others.tolist()], xxhash.xxh64_intdigest
        try:
            hashes = np.fromiter(map(digest, beyond, repeat(42)), np.uint64, len(beyond))
        except UnicodeEncodeError:  # halves of surrogate pairs
            hashes = np.fromiter((digest(w.encode("utf-8", "surrogatepass"), 42) for w in beyond), np.uint64, len(beyond))
        bucket = VOCABULARY - BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
        codes[others] = bucket * SCALE - self.rest.shares(hashes)
        return codes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with two ends around each, the log shares, and how many words each has."""
        parts, sizes = [np.empty(0)], np.zeros(len(texts), np.int64)
        for first, last in stretches(texts, ENCODED):
            words = [words_of(t) for t in texts[first:last]]
            sizes[first:last] = [len(w) for w in words]
            own, places = distinct(list(chain.from_iterable(words)))
            parts.append(self._codes(own)[places])
        codes = np.concatenate(parts)
        at = np.arange(len(codes)) + 2 * np.repeat(np.arange(1, len(texts) + 1), sizes)
        ids = np.full(len(codes) + 2 * len(texts) + 2, VOCABULARY, np.int64)
        ids[at] = np.floor(codes / SCALE)
        shares = np.zeros(len(ids))
        shares[at] = ids[at] * SCALE - codes
        return ids, shares, sizes

    def hidden(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(WIDTH, places): what the neighbours of each place say."""
        context = self.weights["context"]  # `take` is several times as fast as an index
        total = context[0].take(ids.take(at + SIDES[0]), axis=0)
        for side, step in enumerate(SIDES[1:], 1):
            total += context[side].take(ids.take(at + step), axis=0)
        total += self.weights["bias"]
        return np.tanh(np.ascontiguousarray(total.T))

    def log_probabilities(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the word at each place, given its neighbours."""
        result = np.empty(len(at))
        for first in range(0, len(at), AT_ONCE):
            places = at[first : first + AT_ONCE]
            sought = ids.take(places)
            order = np.argsort(sought // CLASSES, kind="stable")
            sought = sought[order]
            hidden = self.hidden(ids, places[order])
            owner, inside = sought // CLASSES, sought % CLASSES
            logs = _log_shares(self.weights["class_out"].T @ hidden + self.weights["class_bias"][:, None], owner).astype(np.float64)
            bounds = np.searchsorted(owner, np.arange(CLASSES + 1))
            for c in np.flatnonzero(np.diff(bounds)).tolist():
                rows = slice(bounds[c], bounds[c + 1])
                outputs = self.weights["word_out"][c * CLASSES : (c + 1) * CLASSES]
                biases = self.weights["word_bias"][c * CLASSES : (c + 1) * CLASSES, None]
                logs[rows] += _log_shares(outputs @ hidden[:, rows] + biases, inside[rows])
            result[first + order] = logs
        return result

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Words and summed log probability of each text."""
        rows, shares, sizes = self.rows(texts)
        return sizes, self.sums(rows, sizes) + shares

    def rows(self, texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Each text's ids as little-endian 16-bit numbers, the sum of its log shares, its words."""
        ids, shares, sizes = self.encode(texts)
        firsts = 2 + np.cumsum(sizes + 2) - (sizes + 2)
        packed, added = ids.astype("<u2").tobytes(), np.concatenate(([0.0], np.cumsum(shares)))
        rows = [packed[2 * a : 2 * b] for a, b in zip(firsts.tolist(), (firsts + sizes).tolist())]
        return rows, added[firsts + sizes] - added[firsts], sizes

    def sums(self, rows: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Summed log probabilities of ids, without the words' shares of their buckets."""
        ids = _with_ends(rows)
        logs = self.log_probabilities(ids, _places(ids))
        sums = np.zeros(len(rows))
        filled = sizes > 0
        if filled.any():
            sums[filled] = np.add.reduceat(logs, (np.cumsum(sizes) - sizes)[filled])
        return sums


_ENDS = np.full(2, VOCABULARY, "<u2").tobytes()


def _with_ends(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(_ENDS + _ENDS.join(rows) + _ENDS, "<u2")  # 16 bits: places are taken at random


def _places(ids: np.ndarray) -> np.ndarray:
    return np.nonzero(ids != VOCABULARY)[0].astype(np.int32 if len(ids) < 1 << 31 else np.int64)


def _log_shares(x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The log softmax of each column of `x` at one place; `x` is used up."""
    x -= x.max(axis=0)
    found = x[wanted, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return found - np.log(x.sum(axis=0))


def _error(x: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """The gradient of the mean log loss of `n` places by the columns of `x`, in place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= 1 / (x.sum(axis=0) * np.float32(n))
    x[wanted, np.arange(x.shape[1])] -= np.float32(1 / n)
    return x


def _start(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Weights before training: small contexts, and biases that give the words' shares."""
    rng = np.random.default_rng(7)
    shares = (counts + 1.0) / (counts + 1.0).sum()
    by_class = shares.reshape(CLASSES, CLASSES)
    weights = {
        "context": rng.normal(0, 0.1, (len(SIDES), VOCABULARY + 1, WIDTH)),
        "bias": np.zeros(WIDTH),
        "class_out": rng.normal(0, 0.1, (WIDTH, CLASSES)),
        "class_bias": np.log(by_class.sum(axis=1)),
        "word_out": rng.normal(0, 0.1, (VOCABULARY, WIDTH)),
        "word_bias": np.log(by_class / by_class.sum(axis=1, keepdims=True)).ravel(),
    }
    return {k: w.astype(np.float32) for k, w in weights.items()}


class _Trainer:
    """Adagrad over one task's words, in place."""

    def __init__(self, network: Network):
        self.network = Network(network.ids, {k: w.copy() for k, w in network.weights.items()}, network.rest)
        self.squares = {k: np.full(w.shape, 1e-3, np.float32) for k, w in self.network.weights.items()}
        self.words = 0

    def _step(self, name: str, gradient: np.ndarray, index=slice(None)) -> None:
        squares = self.squares[name]
        squares[index] += gradient * gradient
        self.network.weights[name][index] -= RATE * gradient / np.sqrt(squares[index])

    def learn(self, rows: list[bytes]) -> None:
        ids = _with_ends(rows)
        at = _places(ids)
        np.random.default_rng(len(at)).shuffle(at)
        first = 0
        while first < len(at):
            size = min(MOST_BATCH, max(LEAST_BATCH, self.words // BATCH_SHARE))
            self._batch(ids, at[first : first + size])
            self.words += min(size, len(at) - first)
            first += size

    def _batch(self, ids: np.ndarray, at: np.ndarray) -> None:
        w, n = self.network.weights, len(at)
        words = ids.take(at)
        order = np.argsort(words // CLASSES, kind="stable")
        at, words = at[order], words[order]
        owner, inside = words // CLASSES, words % CLASSES
        hidden = self.network.hidden(ids, at)
        error = _error(w["class_out"].T @ hidden + w["class_bias"][:, None], owner, n)
        back = w["class_out"] @ error
        class_out, class_bias = hidden @ error.T, error.sum(axis=1)
        # Words whose class no place has keep no gradient.
        word_out, word_bias = np.zeros_like(w["word_out"]), np.zeros_like(w["word_bias"])
        bounds = np.searchsorted(owner, np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(bounds)).tolist():
            rows, own = slice(bounds[c], bounds[c + 1]), slice(c * CLASSES, (c + 1) * CLASSES)
            within = _error(w["word_out"][own] @ hidden[:, rows] + w["word_bias"][own, None], inside[rows], n)
            # The error is of all `n` places, of which these are a part.
            back[:, rows] += w["word_out"][own].T @ within
            np.matmul(within, hidden[:, rows].T, out=word_out[own])
            np.sum(within, axis=1, out=word_bias[own])
        self._step("word_out", word_out)
        self._step("word_bias", word_bias)
        self._step("class_out", class_out)
        self._step("class_bias", class_bias)
        back *= 1 - hidden * hidden
        self._step("bias", back.sum(axis=1))
        for side, step in enumerate(SIDES):
            beside = ids.take(at + step).astype(np.int64)
            # Words that are not beside any place have no gradient, and their weights stay.
            summed = [np.bincount(beside, row, VOCABULARY + 1) for row in back]
            self._step("context", np.stack(summed, axis=1).astype(np.float32), side)


def _vocabulary(read: DataFrame) -> tuple[dict[str, int], np.ndarray, Rest]:
    """Ids of the most frequent words over all documents, the counts behind every id, and what is
    known of all other words."""

    def counted(batches):
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return rows

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
                if len(counts) > COUNTED:
                    yield out()
        if counts:
            yield out()

    words = written(
        read.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    size = VOCABULARY - BUCKETS
    top = words.orderBy(F.desc("n"), "word").limit(size).collect()
    counts = np.zeros(VOCABULARY)
    counts[: len(top)] = [r["n"] for r in top]
    # The words that come after the last of these in the order that chose them.
    last = top[-1] if len(top) == size else None
    others = words.filter(F.lit(False) if last is None else (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"])))
    rest, counts[size:] = _rest(words, others)
    return {r["word"]: i for i, r in enumerate(top)}, counts, rest


def _rest(words: DataFrame, others: DataFrame) -> tuple[Rest, np.ndarray]:
    """Shares of the words beyond the vocabulary, and the counts of their buckets."""
    distinct = words.count()
    n_slots = min(MOST_SLOTS, max(BUCKETS, 1 << max(0, distinct // WORDS_PER_SLOT - 1).bit_length()))
    hashed = F.xxhash64("word")
    slot = hashed.bitwiseAND(F.lit(n_slots - 1).cast("long")).cast("int").alias("slot")
    found = others.groupBy(slot).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("once")).toArrow()
    n, kinds, once = np.zeros(n_slots), np.zeros(n_slots), np.zeros(n_slots)
    at = found["slot"].to_numpy()
    for column, name in ((n, "n"), (kinds, "kinds"), (once, "once")):
        column[at] = found[name].to_numpy()
    in_bucket = lambda column: column.reshape(-1, BUCKETS).sum(axis=0)  # noqa: E731  the lowest bits name the bucket
    totals, singles, all_kinds = in_bucket(n), in_bucket(once), in_bucket(kinds)
    # The chance of a new word is that of a word seen once (Good and Turing), smoothed by one.
    new = (singles + 1) / (totals + 2)
    unseen = np.log(new / (all_kinds + 1))
    bucket = np.arange(n_slots) % BUCKETS
    with np.errstate(divide="ignore", invalid="ignore"):
        known = np.log1p(-new)[bucket] + np.log(n) - np.log(np.maximum(kinds, 1)) - np.log(totals)[bucket]
    slots = np.where(n > 0, known, unseen[bucket])
    seen = KeySet.of(words, hashed, distinct)
    rows = seen.collected()
    bits = np.zeros(seen.words, np.uint64)
    bits[rows["slot"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return Rest(slots.astype(np.float32), unseen.astype(np.float32), bits), totals


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in NAMES])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    sizes = np.cumsum([0] + [like[k].size for k in NAMES])
    return {k: flat[a:b].reshape(like[k].shape).astype(np.float32) for k, a, b in zip(NAMES, sizes, sizes[1:])}


def _summed(parts: DataFrame, *keys: str, kind: type) -> DataFrame:
    """Weight chunks, of type `kind`, added up for each key; a task holds one sum for each of its keys."""

    def add(batches):
        sums: dict[tuple, list] = {}
        for batch in batches:
            places = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            for place, data, words in zip(places, batch.column("data").to_pylist(), batch.column("words").to_pylist()):
                held = sums.setdefault(place, [0.0, 0.0])
                # What a task has learned counts by its words; sums have been weighted before.
                held[0] = held[0] + np.frombuffer(data, kind) * (words if kind is np.float32 else 1.0)
                held[1] += words
        for place, (total, words) in sums.items():
            row = {k: pa.array([v], pa.int32()) for k, v in zip(keys, place)}
            yield pa.RecordBatch.from_pydict({**row, "data": pa.array([total.astype(np.float64).tobytes()], pa.binary()), "words": pa.array([words])})

    fields = ", ".join(f"{k} int" for k in keys)
    return parts.repartition(*keys).mapInArrow(add, f"{fields}, data binary, words double")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> Network:
    """The network that all documents have trained."""
    return _fit(docs, key, text, rounds)[0]


def fit_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The scores of the documents that the network is trained on; texts are read as words once."""
    network, train = _fit(docs, key, text, rounds)
    return _scored(train, network, key)


def _fit(docs: DataFrame, key: str, text: str, rounds: int) -> tuple[Network, DataFrame]:
    read = keyed_text(docs, key, text)
    ids, counts, rest = _vocabulary(read)
    network = Network(ids, _start(counts), rest)
    turn_of = F.pmod(F.xxhash64(F.col("key").cast("string"), "text"), F.lit(rounds)).cast("int")
    train = written(_encoded(read.select("key", "text", turn_of.alias("turn")), network, "turn"), "word-ids")
    for turn in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(network)

        def learned(batches):
            trainer = _Trainer(shared.value)
            for batch in batches:
                trainer.learn(batch.column("ids").to_pylist())
            if trainer.words:
                flat = _flat(trainer.network.weights).astype(np.float32)
                salt = TaskContext.get().partitionId() % 16
                for chunk, at in enumerate(range(0, len(flat), CHUNK)):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "chunk": pa.array([chunk], pa.int32()),
                            "salt": pa.array([salt], pa.int32()),
                            "data": pa.array([flat[at : at + CHUNK].tobytes()], pa.binary()),
                            "words": pa.array([float(trainer.words)]),
                        }
                    )

        # Tasks follow the input's splits, and so do the weights that they send.
        parts = train.filter(F.col("turn") == turn).select("ids").mapInArrow(learned, "chunk int, salt int, data binary, words double")
        chunks = _summed(_summed(parts, "chunk", "salt", kind=np.float32), "chunk", kind=np.float64).collect()
        shared.unpersist()
        if not chunks:
            continue
        chunks.sort(key=lambda r: r["chunk"])
        flat = np.concatenate([np.frombuffer(r["data"], np.float64) / r["words"] for r in chunks])
        network = Network(ids, _shaped(flat, network.weights), rest)
    return network, train


def _encoded(read: DataFrame, network: Network, *kept: str) -> DataFrame:
    """key, `kept`, n_words, share (the sum of log shares), ids."""
    shared = read.sparkSession.sparkContext.broadcast(network)

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, shares, sizes = shared.value.rows(batch.column("text").to_pylist())
        columns = [batch.column(c) for c in ("key", *kept)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(sizes), pa.array(shares), pa.array(rows, pa.binary())], names=["key", *kept, "n_words", "share", "ids"]
        )

    return by_batch(read, encoded, with_fields(read, "key", *kept, more="n_words long, share double, ids binary"))


def score(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, log_prob, mean_log_prob."""
    return _scored(_encoded(keyed_text(docs, key, text), network), network, key)


def _scored(rows: DataFrame, network: Network, key: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = shared.value.sums(batch.column("ids").to_pylist(), batch.column("n_words").to_numpy())
        logs = sums + batch.column("share").to_numpy()
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n_words"), pa.array(logs)], names=["key", "n_words", "log_prob"])

    read = rows.select("key", "n_words", "share", "ids")
    logs = by_batch(read, scored, with_fields(read, "key", more="n_words long, log_prob double"))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob")
    return logs.select(F.col("key").alias(key), "n_words", "log_prob", mean)
