"""Ids of a word-level BPE vocabulary for whole batches of texts.

White space separates words in this vocabulary's rules, so a text's ids are those of its words. A
batch is cut into words in numpy, equal words are encoded once, and all new words are merged
in step: in each round every word merges its best pair. Words with characters for which the
tokenizer's normaliser does more than lower-casing, with parts of special strings, or of great
length go to the `tokenizers` library, whose ids are the standard in all cases.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import cache

import numpy as np
import pandas as pd

from tidemark.llm.shared import stretches

# Characters handled here end before this one; the longest word merged here; characters at a time.
LATIN = 0x250
LONGEST = 40
AT_ONCE = 1_500_000
# Of these, so many that arrays over them stay near the processor.
CACHED = 120_000
# Distinct words remembered before all are forgotten.
KNOWN = 300_000
_END = np.full(3, 10, np.int64)
_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int32(2**31 - 1)
_BITS = 19
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the characters before LATIN."""
    kind, lower = np.full(LATIN + 1, _ODD, np.uint8), np.arange(LATIN + 1)
    for code in range(0x21, LATIN):
        c = chr(code)
        category = unicodedata.category(c)
        small = c.lower()
        if len(small) > 1 or ord(small) >= LATIN or category[0] in "CZ" or unicodedata.normalize("NFC", c) != c:
            continue
        kind[code] = {"L": _LETTER, "N": _NUMBER}.get(category[0], _OTHER)
        lower[code] = ord(small)
    for c in " \t\n\r":
        kind[ord(c)] = _SPACE
    return kind, lower


class WordBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if len(vocabulary) >= 1 << 16:
            raise ValueError("pairs of ids must fit into 32 bits")
        left, right = (np.array([vocabulary[m[side]] for m in merges], np.uint32) for side in (0, 1))
        self._joined = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        self._pairs, self._ranks, self._probes = _pair_table(left << np.uint32(16) | right)
        self._kind, self._lower = _classes()
        self._mixed = _mix(np.arange(LATIN, dtype=np.uint32))
        self._powers = self._inverses = np.ones(1, np.uint64)
        self._forget()
        # The vocabulary writes bytes as printable characters.
        printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
        shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        self._inner = np.array([vocabulary.get(shown[b], -1) for b in range(256)], np.int32)
        self._last = np.array([vocabulary.get(shown[b] + suffix, -1) for b in range(256)], np.int32)

    def _forget(self) -> None:
        self._known = self._recent = pd.Index(np.empty(0, np.uint64))
        self._flat = np.empty(0, np.int32)
        self._counts = self._offsets = np.empty(0, np.int64)
        self._checks = np.empty(0, np.uint64)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        return [ids for first, last in stretches(texts, AT_ONCE) for ids in self._encode(texts[first:last])]

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        joined = "\n".join(t or "" for t in texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.int32).copy()
        lengths = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        firsts = np.append(np.cumsum(lengths + 1) - lengths - 1, len(codes))
        keys, checks, starts, ends, odd = self._cut(codes, firsts)
        usual = np.nonzero(~odd)[0]
        inverse, distinct = pd.factorize(keys[usual])
        place = self._known.get_indexer(distinct)
        missing = np.nonzero(place < 0)[0]
        recent = self._recent.get_indexer(distinct[missing])
        place[missing] = np.where(recent < 0, -1, len(self._known) + recent)
        new = missing[recent < 0]
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[inverse[::-1]] = usual[::-1]
            one = first[new]
            place[new] = len(self._counts) + np.arange(len(new))
            self._learn(distinct[new], checks[one], *self._merged(codes, starts[one], ends[one]))
        word = place[inverse]
        each, offsets = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        each[usual], offsets[usual] = self._counts[word], self._offsets[word]
        known = self._flat
        # Words that only share a hash with a known one, and those for the library, go by their text.
        exact = np.concatenate((np.nonzero(odd)[0], usual[self._checks[word] != checks[usual]]))
        if len(exact):
            spelled = [joined[s:e] for s, e in zip(starts[exact].tolist(), ends[exact].tolist())]
            texts_of = {w: i for i, w in enumerate(dict.fromkeys(spelled))}
            found = [np.array(f.ids, np.int32) for f in self._library.encode_batch(list(texts_of), add_special_tokens=False)]
            sizes = np.array([len(f) for f in found], np.int64)
            row = np.array([texts_of[w] for w in spelled])
            each[exact], offsets[exact] = sizes[row], (len(known) + np.cumsum(sizes) - sizes)[row]
            known = np.concatenate([known, *found])
        before = np.concatenate(([0], np.cumsum(each)))
        flat = known[np.repeat(offsets - before[:-1], each) + np.arange(before[-1])].astype("<u4")
        if len(self._counts) > KNOWN:
            self._forget()
        bounds = before[np.searchsorted(starts, firsts)]
        return [flat[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def _learn(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self._checks = np.concatenate((self._checks, checks))
        self._offsets = np.concatenate((self._offsets, len(self._flat) + np.cumsum(counts) - counts))
        self._counts = np.concatenate((self._counts, counts))
        self._flat = np.concatenate((self._flat, ids))
        self._recent = pd.Index(np.concatenate((self._recent.to_numpy(), keys)))
        if len(self._recent) > 0.2 * len(self._known):
            self._known = pd.Index(np.concatenate((self._known.to_numpy(), self._recent.to_numpy())))
            self._recent = pd.Index(np.empty(0, np.uint64))

    def _cut(self, codes: np.ndarray, firsts: np.ndarray) -> list[np.ndarray]:
        """Two hashes, start, end and kind of every word; `codes` become lower case. Some texts at a
        time, so that all arrays over characters stay near the processor."""
        parts, at = [], 0
        while at < len(firsts) - 1:
            upto = max(at + 1, int(np.searchsorted(firsts, firsts[at] + CACHED, "right")) - 1)
            low, high = firsts[at], firsts[upto]
            own = np.concatenate((codes[low:high], _END))
            starts, ends, odd, small = self._words(own)
            codes[low:high] = small[: high - low]
            parts.append((*self._keys(small, starts, ends), starts + low, ends + low, odd))
            at = upto
        return [np.concatenate(x) for x in zip(*parts)]

    def _words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of all words, which are for the library, and the characters in lower case."""
        kind, small = self._kind.take(codes, mode="clip"), self._lower.take(codes, mode="clip")
        if (foreign := codes >= LATIN).any():
            small[foreign] = codes[foreign]
        new = np.empty(len(codes), bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        new |= kind == _NUMBER
        # 's 't 'm 'd 're 've 'll at the start of a run are words of their own.
        mark = np.nonzero((small[:-3] == ord("'")) & new[:-3] & (kind[1:-2] == _LETTER))[0]
        one, two = small[mark + 1], small[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        new[mark[short | long] + 1] = False
        for size, own in ((2, mark[short]), (3, mark[long])):
            new[own + size] = True
        # Whole stretches between spaces for the library, where one character asks for it.
        space = kind == _SPACE
        wild = (kind == _ODD) | ((codes == ord("<")) & np.append(codes[1:] == ord("|"), False))
        odd = np.zeros(len(codes), bool)
        longs = self._long(space)
        if wild.any() or len(longs):
            stretch = np.cumsum(space)
            hit = np.zeros(int(stretch[-1]) + 1, bool)
            hit[stretch[wild]] = True
            hit[longs] = True
            odd = hit[stretch] & ~space
            new = np.where(odd, np.concatenate(([True], space[:-1])), new)
            small = np.where(odd, codes, small)
        starts = np.nonzero(new & ~space)[0]
        stops = np.nonzero(new | space)[0]
        ends = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
        return starts, ends, odd[starts], small

    @staticmethod
    def _long(space: np.ndarray) -> np.ndarray:
        """Numbers of the stretches between spaces that are longer than LONGEST."""
        at = np.nonzero(space)[0]
        gaps = np.diff(np.concatenate(([-1], at))) - 1
        return np.nonzero(gaps > LONGEST)[0]

    def _keys(self, codes, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Two unrelated hashes of each word, from sums over all characters. Words between other
        characters than letters are short (see `_long`), so that these sums are well mixed."""
        if len(codes) > len(self._powers):
            with np.errstate(over="ignore"):
                self._powers, self._inverses = (
                    np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(codes) - 1, f)))) for f in (_FACTOR, _INVERSE)
                )
        mixed = self._mixed.take(codes, mode="clip")
        if (foreign := codes >= LATIN).any():
            mixed[foreign] = _mix(codes[foreign])
        lengths = (ends - starts).astype(np.uint64)
        with np.errstate(over="ignore"):
            # The second: characters mixed anew, with the powers the other way round.
            turned = (mixed ^ (mixed << np.uint64(17))) * np.uint64(0x94D049BB133111EB)
            turned ^= turned >> np.uint64(29)
            turned *= self._inverses[: len(codes)]
            mixed *= self._powers[: len(codes)]
            sums, others = (np.concatenate(([np.uint64(0)], np.cumsum(m))) for m in (mixed, turned))
            keys = (sums[ends] - sums[starts]) * self._inverses[starts]
            checks = (others[ends] - others[starts]) * self._powers[starts]
            return keys * _FACTOR + lengths, checks * _INVERSE + lengths

    def _merged(self, codes, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        order = np.argsort(ends - starts, kind="stable")
        for at in range(0, len(order), 1 << 14):
            rows = order[at : at + (1 << 14)]
            ids, own = self._merge(codes, starts[rows], ends[rows])
            parts.append(ids)
            owners.append(rows[own])
        if not parts:
            return np.empty(0, np.int32), counts
        owner = np.concatenate(owners)
        counts += np.bincount(owner, minlength=len(starts))
        return np.concatenate(parts)[np.argsort(owner, kind="stable")], counts

    def _merge(self, codes, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Merged words: their ids row by row, and the row of each id."""
        sizes = ends - starts
        width = int(sizes.max())
        columns = np.arange(width)
        chars = codes[np.minimum(starts[:, None] + columns, len(codes) - 1)]
        chars[columns[None, :] >= sizes[:, None]] = 0
        wide = chars >= 0x80
        if wide.any():  # two bytes each
            spelled = np.zeros((len(chars), 2 * width), np.int32)
            lengths = sizes + wide.sum(axis=1)
            to = columns[None, :] + np.cumsum(wide, axis=1) - wide
            rows = np.arange(len(chars))[:, None]
            spelled[rows, to] = np.where(wide, 0xC0 | chars >> 6, chars)
            again = np.nonzero(wide)
            spelled[again[0], to[again] + 1] = 0x80 | chars[again] & 0x3F
            width = int(lengths.max())
            spelled, columns, sizes = spelled[:, :width], np.arange(width), lengths
        else:
            spelled = chars
        symbols = np.where(columns[None, :] == sizes[:, None] - 1, self._last[spelled], self._inner[spelled])
        symbols[columns[None, :] >= sizes[:, None]] = -1
        # Places of a row follow each other by links, which skip what has been merged away; the
        # last column is an end without a symbol.
        width += 1
        symbols = np.concatenate((symbols, np.full((len(symbols), 1), -1, symbols.dtype)), axis=1).ravel()
        place = np.arange(len(symbols))
        after = np.where(place % width == width - 1, place, place + 1)
        before = place - 1
        ranks = np.full(len(symbols), _NONE, np.int32)
        pairs = np.nonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0) & (place[1:] % width > 0))[0]
        ranks[pairs] = self._rank(symbols[pairs], symbols[pairs + 1])
        table = ranks.reshape(-1, width)
        live = np.arange(len(table))
        while True:
            best = (table if len(live) == len(table) else table[live]).argmin(axis=1) + live * width
            rank = ranks[best]
            going = rank != _NONE
            if not going.any():
                break
            live, best, rank = live[going], best[going], rank[going]
            gone = after[best]
            behind = after[gone]
            symbols[best] = self._joined[rank]
            symbols[gone] = -1
            ranks[gone] = _NONE
            after[best] = behind
            inner = behind != gone
            before[behind[inner]] = best[inner]
            ranks[best] = self._rank(symbols[best], symbols[behind])
            later = best[best % width > 0]
            ahead = before[later]
            ranks[ahead] = self._rank(symbols[ahead], symbols[later])
        kept = np.nonzero(symbols >= 0)[0]
        return symbols[kept], kept // width

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b); _NONE where there is no merge, or no b."""
        keys = a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32) & np.uint32(0xFFFF)
        at = _slot(keys)
        found = np.where(self._pairs[at] == keys, self._ranks[at], _NONE)
        for step in range(1, self._probes):
            missed = np.nonzero((found == _NONE) & (self._ranks[at] != _NONE))[0]
            if not len(missed):
                break
            other = at[missed] + step & (1 << _BITS) - 1
            found[missed] = np.where(self._pairs[other] == keys[missed], self._ranks[other], _NONE)
        found[b < 0] = _NONE
        return found


def _mix(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (codes.astype(np.uint64) + np.uint64(0x5BD1E995)) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(31))


def _slot(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys * np.uint32(0x9E3779B1) >> np.uint32(32 - _BITS)).astype(np.int64)


def _pair_table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open addressing: pairs and their ranks, and the longest search."""
    pairs, ranks, probes = np.zeros(1 << _BITS, np.uint32), np.full(1 << _BITS, _NONE, np.int32), 1
    for rank, (key, at) in enumerate(zip(keys.tolist(), _slot(keys).tolist())):
        step = 0
        while ranks[(at + step) % (1 << _BITS)] != _NONE:
            step += 1
        pairs[(at + step) % (1 << _BITS)], ranks[(at + step) % (1 << _BITS)] = key, rank
        probes = max(probes, step + 1)
    return pairs, ranks, probes


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
