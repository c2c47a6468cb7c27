"""Language identification by interpolated Kneser-Ney character models.

One model per language, of `ORDER` characters. All languages share sorted hash arrays: per order
the n-gram hashes with one log probability for each language, and the context hashes with one
back-off weight for each. A text is lower-cased, everything but letters becomes single spaces,
and its cross-entropy per character is taken under every model over the whole text; the lowest
wins. Windows that repeat within a batch are looked up once.

Fitting takes a bounded sample: `SAMPLE_DOCS` documents per language are expected, chosen by a
hash of their id, three quarters for counting and one for calibration. A language of fewer than
`RARE` documents is counted whole, and judged by the other languages' spread. Counting and
prediction are Spark jobs; the driver sees the counts of the sample and the calibration texts.

Calibration: the score is the chance that the choice is right, a logistic function of the margin
between the two best models, fitted on documents that were not counted. A text is rejected as no
known language if its cross-entropy lies further above the usual one of the chosen language than
calibration documents of its length do.

Defined results: `und` with score 0 for null texts and texts without a letter (these are rejected)
and, where nothing could be learned, for all texts (these are not); ties go to the first language
in order of name; repeated rows are predicted each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import by_batch, keyed_text, stretches, with_fields

ORDER = 4
SAMPLE_DOCS = 1500
RARE = 20
UNKNOWN = "und"
# Characters looked at together.
AT_ONCE = 1_000_000
# Standard deviations above the usual cross-entropy from which on a text is rejected, at least.
LEAST_DEVIATIONS = 8.0
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _prepared(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, ORDER - 1 spaces before each; where each begins; which have letters."""
    lower = [(t or "").lower() for t in texts]
    pad = "\n" * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(lower)).encode("utf-32-le", "replace"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(t) + len(pad) for t in lower])[:-1])).astype(np.int64)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    after = starts + len(pad)
    first = after[after < len(codes)]
    keep[first] = letter[first]  # no space after the padding, which is kept whole
    keep[(starts[:, None] + np.arange(len(pad))).ravel()] = True
    kept = np.where(letter, codes, 32)[keep]
    places = np.concatenate(([0], np.cumsum(keep)))
    begins = places[starts]
    has = np.add.reduceat(letter, starts) > 0 if len(letter) else np.zeros(len(texts), bool)
    return kept.astype(np.uint64), begins, has


def _keys(codes: np.ndarray, at: np.ndarray | slice, n: int) -> np.ndarray:
    """Hashes of the n characters that end at the given places."""
    key = np.zeros(len(codes[at]), np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for back in range(n):
            index = at - back if isinstance(at, np.ndarray) else slice(at.start - back, at.stop - back)
            key += (codes[index] + np.uint64(1)) * power
            power *= _FACTOR
    return key


def _counts(docs: DataFrame) -> DataFrame:
    """label, n, gram, context, suffix, count over (label, text) rows, of every order."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column("text").to_pylist()
        labels = batch.column("label").to_pylist()
        parts = [p for a, b in stretches(values, AT_ONCE) for p in counted(values[a:b], labels[a:b])]
        return pa.RecordBatch.from_pandas(pd.concat(parts), schema, preserve_index=False)

    def counted(values: list[str], labels: list[str]) -> list[pd.DataFrame]:
        texts = pd.Series(values, dtype=object)
        parts = []
        for label, group in texts.groupby(np.array(labels, dtype=object)):
            codes, begins, _ = _prepared(group.tolist())
            inside = np.ones(len(codes), bool)
            inside[(begins[:, None] + np.arange(ORDER - 1)).ravel()] = False
            at = np.nonzero(inside)[0]
            for n in range(1, ORDER + 1):
                gram, one, size = np.unique(_keys(codes, at, n), return_index=True, return_counts=True)
                place = at[one]
                parts.append(
                    pd.DataFrame(
                        {
                            "label": label,
                            "n": np.int32(n),
                            "gram": gram.view(np.int64),
                            "context": _keys(codes, place - 1, n - 1).view(np.int64),
                            "suffix": _keys(codes, place, n - 1).view(np.int64),
                            "count": size.astype(np.int64),
                        }
                    )
                )
        return parts

    numbers = [pa.field(name, pa.int64()) for name in ("gram", "context", "suffix", "count")]
    schema = pa.schema([pa.field("label", pa.string()), pa.field("n", pa.int32()), *numbers])
    rows = by_batch(docs, count, "label string, n int, gram long, context long, suffix long, count long")
    return rows.groupBy("label", "n", "gram", "context", "suffix").agg(F.sum("count").alias("count"))


def _discount(counts: np.ndarray) -> float:
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    return float(once / (once + 2 * twice)) if once and twice else 0.5


@dataclass
class _Orders:
    """Sorted hashes and, for each language, log probabilities and log back-off weights."""

    grams: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_back: list[np.ndarray]


def _estimate(counts: pd.DataFrame, languages: list[str], alphabet: int) -> _Orders:
    """Interpolated Kneser-Ney for every language: raw counts at the highest order, the number of
    distinct characters before an n-gram at the lower ones."""
    model = _Orders([], [], [], [])
    for n in range(1, ORDER + 1):
        own, above = counts[counts["n"] == n], counts[counts["n"] == n + 1]
        grams = np.unique(own["gram"].to_numpy().view(np.uint64))
        contexts = np.unique(own["context"].to_numpy().view(np.uint64))
        log_p = np.full((len(grams), len(languages)), np.nan, np.float32)
        log_back = np.zeros((len(contexts), len(languages)), np.float32)
        for column, language in enumerate(languages):
            rows = own[own["label"] == language]
            seen = rows["count"].to_numpy(np.float64)
            if n < ORDER:
                before = above.loc[above["label"] == language, "suffix"].value_counts()
                seen = np.maximum(1, before.reindex(rows["gram"]).fillna(0).to_numpy(np.float64))
            discount = _discount(seen)
            where = np.searchsorted(contexts, rows["context"].to_numpy().view(np.uint64))
            totals = np.bincount(where, weights=seen, minlength=len(contexts))
            kinds = np.bincount(where, minlength=len(contexts))
            back = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
            if n == 1:
                lower = np.full(len(rows), 1.0 / alphabet)
            else:
                shorter = np.searchsorted(model.grams[-1], rows["suffix"].to_numpy().view(np.uint64))
                lower = np.exp(model.log_p[-1][shorter, column].astype(np.float64))
            p = (seen - discount) / totals[where] + back[where] * lower
            log_p[np.searchsorted(grams, rows["gram"].to_numpy().view(np.uint64)), column] = np.log(p)
            log_back[:, column] = np.log(back)
        model.grams.append(grams)
        model.log_p.append(log_p)
        model.contexts.append(contexts)
        model.log_back.append(log_back)
    return model


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class LanguageModels:
    languages: list[str]
    orders: _Orders
    alphabet: int
    usual: np.ndarray | None = None  # cross-entropy of each language's own texts
    spread: np.ndarray | None = None  # (languages, 2): its variance as a + b / characters
    deviations: float = LEAST_DEVIATIONS
    logistic: tuple[float, float] = (0.0, 1.0)

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(texts, languages) nats per character; characters of each text; which have letters."""
        parts = [self._cross_entropies(texts[a:b]) for a, b in stretches(texts, AT_ONCE)]
        if not parts:
            return np.zeros((0, len(self.languages))), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, begins, has = _prepared(texts)
        inside = np.ones(len(codes), bool)
        inside[(begins[:, None] + np.arange(ORDER - 1)).ravel()] = False
        at = np.nonzero(inside)[0]
        sizes = np.diff(np.append(begins, len(codes))) - (ORDER - 1)
        totals = np.zeros((len(texts), len(self.languages)))
        filled = sizes > 0
        if len(at):
            window, _ = pd.factorize(_keys(codes, at, ORDER))
            _, one = np.unique(window, return_index=True)
            scores = self._log_probabilities(codes, at[one])
            firsts = (np.cumsum(sizes) - sizes)[filled]
            for column in range(len(self.languages)):
                own = np.ascontiguousarray(scores[:, column])[window]
                totals[filled, column] = np.add.reduceat(own, firsts, dtype=np.float64)
        return -totals / np.maximum(sizes, 1)[:, None], sizes, has

    def _log_probabilities(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        result = np.full((len(at), len(self.languages)), -np.log(self.alphabet), np.float32)
        for n in range(1, ORDER + 1):
            row, known = _found(self.orders.contexts[n - 1], _keys(codes, at - 1, n - 1))
            result[known] += self.orders.log_back[n - 1][row[known]]
            row, known = _found(self.orders.grams[n - 1], _keys(codes, at, n))
            own = self.orders.log_p[n - 1][row[known]]
            result[known] = np.where(np.isnan(own), result[known], own)
        return result

    def calibrate(self, texts: list[str], labels: list[str]) -> None:
        """Usual cross-entropies, their spread by length, and the logistic score."""
        entropies, sizes, has = self.cross_entropies(texts)
        column = {c: i for i, c in enumerate(self.languages)}
        wanted = np.array([column.get(c, -1) for c in labels])
        use = has & (wanted >= 0)
        entropies, sizes, wanted = entropies[use], sizes[use], wanted[use]
        count = len(self.languages)
        self.usual, self.spread = np.zeros(count), np.zeros((count, 2))
        deviations, few = [0.0], []
        for c in range(count):
            own = (wanted == c) & (entropies.argmin(axis=1) == c)
            values, lengths = entropies[own, c], sizes[own]
            if len(values) < 5:
                self.usual[c] = np.median(entropies) if len(entropies) else np.log(self.alphabet)
                few.append(c)
                continue
            self.usual[c] = np.median(values)
            off = np.abs(values - self.usual[c])
            long = lengths >= np.median(lengths)
            # 1.4826 times the median deviation estimates a standard deviation.
            a = (1.4826 * np.median(off[long])) ** 2 + 1e-4
            b = (1.4826 * np.median(off * np.sqrt(lengths))) ** 2 + 1e-2
            self.spread[c] = (a, b)
            z = (values - self.usual[c]) / np.sqrt(a + b / lengths)
            deviations.append(float(np.quantile(z, 0.999)))
        others = [c for c in range(count) if c not in few]
        self.spread[few] = self.spread[others].mean(axis=0) if others else (1.0, 1.0)
        self.deviations = max(LEAST_DEVIATIONS, 1.5 * max(deviations))
        if len(wanted) and count > 1:
            ordered = np.sort(entropies, axis=1)
            self.logistic = _logistic(
                (ordered[:, 1] - ordered[:, 0]) * np.sqrt(sizes), entropies.argmin(axis=1) == wanted
            )

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        if not self.languages:
            return pd.DataFrame(
                {"lang_pred": UNKNOWN, "score": 0.0, "cross_entropy": np.nan, "rejected": False}, index=range(len(texts))
            )
        entropies, sizes, has = self.cross_entropies(texts)
        best = entropies.argmin(axis=1)
        lowest = entropies[np.arange(len(best)), best]
        score = np.ones(len(best))
        if len(self.languages) > 1:
            margin = (np.partition(entropies, 1, axis=1)[:, 1] - lowest) * np.sqrt(np.maximum(sizes, 1))
            low, slope = self.logistic
            score = 1 / (1 + np.exp(-np.clip(low + slope * margin, -30, 30)))
        limit = self.deviations * np.sqrt(self.spread[best, 0] + self.spread[best, 1] / np.maximum(sizes, 1))
        names = np.array(self.languages, dtype=object)[best]
        return pd.DataFrame(
            {
                "lang_pred": np.where(has, names, UNKNOWN),
                "score": np.where(has, score, 0.0),
                "cross_entropy": np.where(has, lowest, np.nan),
                "rejected": ~has | (lowest - self.usual[best] > limit),
            }
        )


def _logistic(margin: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's rounds, with a small ridge for separable data."""
    x = np.column_stack([np.ones(len(margin)), margin])
    w, ridge = np.zeros(2), 1e-2
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), x.T @ (right - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), max(0.0, float(w[1]))


def fit(
    docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE_DOCS
) -> LanguageModels:
    """Models from the rows of `docs` that `learn` allows, with a non-null label and text."""
    rows = docs.filter(learn).select(
        F.pmod(F.xxhash64(docs[key].cast("string")), F.lit(1 << 30)).alias("place"),
        docs[text].cast("string").alias("text"),
        docs[label].cast("string").alias("label"),
    )
    rows = rows.filter("text is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModels([], _Orders([], [], [], []), 1)
    # The share of each language's documents that is used, by their place.
    share = F.lit(0)
    for language, n in sizes.items():
        share = F.when(F.col("label") == language, int(min(1.0, sample / n) * (1 << 30))).otherwise(share)
    chosen = rows.withColumn("share", share).filter("place < share")
    rare = F.col("label").isin([language for language, n in sizes.items() if n < RARE])
    counted = chosen.filter((F.col("place") % 4 < 3) | rare).select("label", "text")
    counts = _counts(counted).toArrow().to_pandas()
    counts = counts.sort_values(["n", "label", "gram"]).reset_index(drop=True)
    languages = sorted(counts["label"].unique())
    if not languages:
        return LanguageModels([], _Orders([], [], [], []), 1)
    alphabet = int((counts["n"] == 1).sum()) + 1
    models = LanguageModels(languages, _estimate(counts, languages, alphabet), alphabet)
    held = chosen.filter((F.col("place") % 4 == 3) & ~rare).orderBy("place").select("text", "label")
    models.calibrate(*_columns(held))
    return models


def _columns(rows: DataFrame) -> tuple[list[str], list[str]]:
    table = rows.toArrow()
    return table.column("text").to_pylist(), table.column("label").to_pylist()


def predict(docs: DataFrame, models: LanguageModels, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, lang_pred, score, cross_entropy, rejected."""
    read = keyed_text(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def predicted(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = shared.value.predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array(rows["lang_pred"], pa.string()),
                pa.array(rows["score"], pa.float64()),
                pa.array(rows["cross_entropy"], pa.float64()),
                pa.array(rows["rejected"], pa.bool_()),
            ],
            names=["key", "lang_pred", "score", "cross_entropy", "rejected"],
        )

    more = "lang_pred string, score double, cross_entropy double, rejected boolean"
    return by_batch(read, predicted, with_fields(read, "key", more=more)).withColumnRenamed("key", key)


def without_rejected(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """`docs`, all columns, without the rows whose text the models reject."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text)

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        rejected = shared.value.predict(batch.column(at).to_pylist())["rejected"].to_numpy(bool)
        return batch.filter(pa.array(~rejected))

    return by_batch(docs, kept, docs.schema)
