"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one for toxic and one for ordinary texts, are fitted on labelled texts: absolute discounting of
each class's counts over histories of ORDER - 1 characters, the discounted mass going to one shared lower-order model.  The shared
backoff counts are Kneser-Ney type counts (how often an n-gram occurs in the different words), gathered from every word of the whole corpus,
labelled or not; so an expression that is rare in a class is smoothed by what all texts say about it.  No n-gram of the labelled sample is left out.

The sample is bounded in texts and in characters of its different words, and so is all that comes to the driver or goes to the tasks: numbers
for its n-grams and histories, by 64-bit keys.  The corpus' words stay in Spark: each distinct word once, as its endings, cut where the sample
knows no longer history, dealt by their first two characters and counted in one sorted pass like a trie, with a stack of ORDER numbers.

The toxic and the ordinary log-likelihood, each divided by the number of words, are compared for the whole text, for each window of WINDOW words
(a word repeated within a window counts once) and for the STRONGEST most telling different words.  The mean difference, the largest one of a window
and that of the strongest words give the score, through a logistic curve fitted on labelled texts that the models have not seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.llm.common import bound_batches, hand_out, in_worker, map_text, quoted
from tablefit.session import cut_lineage

ORDER = 8
DISCOUNT = 0.75
WINDOW = 8
STRONGEST = 4
#: Probability of a character below the shortest history.
FLOOR = 1 / 2000
#: The models are fitted on at most so many labelled texts of either class, those first by a hash of their ids.
MAX_TOXIC = 10_000
MAX_ORDINARY = 20_000
#: ... and on no more texts than give this many characters in different words: else on half as many, and so on.
MAX_WORD_CHARS = 2_000_000
#: Words whose n-grams are counted at a time.
GROUP_WORDS = 50_000
#: Rows that a task passes on at once.
BATCH = 100_000
#: One in so many of the labelled texts is kept for the logistic curve.
CALIBRATION = 4
#: Words that one worker remembers.
CACHE_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")
#: For the bytes of a text in UTF-8: of ASCII, all but letters become spaces.
_SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str | None) -> list[str]:
    """The matches of ``_WORD`` in the lower-cased text; that is matched itself only where the parts between ASCII characters are more than letters."""
    if not text:
        return []
    low = text.lower()
    parts = low.encode("utf-8", "surrogatepass").translate(_SPACED).decode("utf-8", "surrogatepass").split()
    return parts if low.isascii() or "".join(parts).isalpha() else _WORD.findall(low)


def grams_of(word: str) -> Iterator[str]:
    """Each character of a word (its end included) with up to ORDER - 1 characters before it (its start included)."""
    s = f"^{word}$"
    for i in range(1, len(s)):
        yield s[max(0, i - ORDER + 1) : i + 1]


def tails_of(gram: str) -> Iterator[str]:
    """The gram and the shorter n-grams that it backs off to."""
    for i in range(len(gram)):
        yield gram[i:]


class SharedBackoff:
    """The lower-order model of both classes, from the number of different words that hold each n-gram."""

    def __init__(self, types: dict[str, int]) -> None:
        self.logs: dict[str, float] = {}
        self.backoff: dict[str, float] = {}
        total, kinds = Counter(), Counter()
        for g, n in types.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        for h, n in total.items():
            self.backoff[h] = DISCOUNT * kinds[h] / n
        for g in sorted(types, key=len):
            h = g[:-1]
            self.logs[g] = max(types[g] - DISCOUNT, 0) / total[h] + self.backoff[h] * self.probability(g[1:])

    def probability(self, gram: str) -> float:
        """Of the last character after the others."""
        weight = 1.0
        while gram:
            if (p := self.logs.get(gram)) is not None:
                return weight * p
            weight *= self.backoff.get(gram[:-1], 1.0)
            gram = gram[1:]
        return weight * FLOOR


def class_model(counts: dict[str, tuple[int, int]], shared: SharedBackoff) -> tuple[dict[str, tuple[float, float]], dict[str, tuple[float, float]]]:
    """(toxic, ordinary) log-probability of each counted gram, and log-weight of the shared model after each counted history."""
    sums = defaultdict(lambda: [0, 0, 0, 0])  # counts and kinds of each class by history
    for g, (t, o) in counts.items():
        s = sums[g[:-1]]
        s[0] += t
        s[1] += o
        s[2] += t > 0
        s[3] += o > 0
    weight = {h: tuple(DISCOUNT * s[2 + c] / s[c] if s[c] else 1.0 for c in (0, 1)) for h, s in sums.items()}
    logs = {}
    for g, n in counts.items():
        s, w, low = sums[g[:-1]], weight[g[:-1]], shared.probability(g)
        logs[g] = tuple(math.log((max(n[c] - DISCOUNT, 0) / s[c] if s[c] else 0) + w[c] * low) for c in (0, 1))
    return logs, {h: (math.log(a), math.log(b)) for h, (a, b) in weight.items()}


class Differences:
    """Toxic minus ordinary log-likelihood of words.  After a history that neither class has, both classes are the shared model and do not differ."""

    def __init__(self, grams: dict[str, float], histories: dict[str, float]) -> None:
        self.grams, self.histories = grams, histories
        self.known: dict[str, float] = {}

    @staticmethod
    def tables(counts: dict[str, tuple[int, int]], types: dict[str, int]) -> tuple[dict[str, float], dict[str, float]]:
        """Differences after a counted gram, and those of the shared model's weight after a counted history."""
        logs, weights = class_model(counts, SharedBackoff(types))
        return {g: a - b for g, (a, b) in logs.items()}, {h: a - b for h, (a, b) in weights.items()}

    def word(self, word: str) -> float:
        s = f"^{word}$"
        out = 0.0
        grams, histories = self.grams, self.histories
        for i in range(1, len(s)):
            start = max(0, i - ORDER + 1)
            if (x := grams.get(s[start : i + 1])) is None:
                x = histories.get(s[start:i])
                if x is None:
                    if start:
                        continue
                    break  # nor has either class a longer beginning
            out += x
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        self.known[word] = out
        return out

    def features(self, text: str | None) -> tuple[float, float, float]:
        return self.of_words(words_of(text))

    def of_words(self, words: list[str]) -> tuple[float, float, float]:
        """Differences of length-normalised log-likelihoods: the largest of a window, the whole text's, the strongest words'; zeros without words."""
        if not words:
            return 0.0, 0.0, 0.0
        names: dict[str, int] = {}
        ids = np.fromiter([names.setdefault(w, len(names)) for w in words], dtype=np.int64, count=len(words))
        get, find = self.known.get, self.word
        by_word = np.array([x if (x := get(w)) is not None else find(w) for w in names])
        each = by_word[ids]
        once = each.copy()
        for k in range(1, min(WINDOW, len(words))):
            once[k:][ids[k:] == ids[:-k]] = 0.0
        sums = np.concatenate(([0.0], np.cumsum(once)))
        k = min(WINDOW, len(words))
        strongest = np.sort(by_word)[-STRONGEST:].sum() / STRONGEST
        return float((sums[k:] - sums[:-k]).max() / WINDOW), float(each.mean()), float(strongest)


class HashedDifferences(Differences):
    """The same from sorted keys of grams and histories and their differences, in arrays, and for many texts at once."""

    def __init__(self, grams: tuple[np.ndarray, np.ndarray], histories: tuple[np.ndarray, np.ndarray]) -> None:
        super().__init__(grams, histories)
        self.known_grams, self.known_histories = Keys(grams[0]), Keys(histories[0])
        self.places: dict[str, int] = {}
        self.values = np.empty(0)

    def learn(self, words: set[str]) -> None:
        """Remembers the words' differences, by place."""
        new = [w for w in words if w not in self.places]
        if len(self.places) + len(new) > CACHE_WORDS:
            self.places.clear()
            self.values = np.empty(0)
            new = list(words)
        parts = [self.values]
        for a in range(0, len(new), GROUP_WORDS):
            own = new[a : a + GROUP_WORDS]
            owner, gram, history = word_grams(own)
            out = np.zeros(len(gram))
            at = self.known_grams.find(gram)
            out[at >= 0] = self.grams[1][at[at >= 0]]
            missing = np.flatnonzero(at < 0)
            at = self.known_histories.find(history[missing])
            out[missing[at >= 0]] = self.histories[1][at[at >= 0]]
            parts.append(np.bincount(owner, weights=out, minlength=len(own)))
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.values = np.concatenate(parts)

    def word(self, word: str) -> float:
        self.learn({word})
        return float(self.values[self.places[word]])

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        """``features`` of each text, a row for each, some GROUP_WORDS words at a time."""
        out, held, n = [], [], 0
        for t in texts:
            held.append(words_of(t))
            n += len(held[-1])
            if n >= GROUP_WORDS:
                out.append(self.of_lists(held))
                held, n = [], 0
        return np.concatenate([*out, self.of_lists(held)])

    def of_lists(self, texts: list[list[str]]) -> np.ndarray:
        """``of_words`` of each list, a row for each."""
        out = np.zeros((len(texts), 3))
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        filled = np.flatnonzero(size)
        if not len(filled):
            return out
        size = size[filled]
        words = list(chain.from_iterable(texts))
        self.learn(set(words))
        ids = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        each = self.values[ids]
        first = np.cumsum(size) - size
        out[filled, 0] = _peaks(ids, each, first, size) / WINDOW
        out[filled, 1] = np.add.reduceat(each, first) / size
        out[filled, 2] = _strongest(ids, each, first, size) / STRONGEST
        return out


def _peaks(ids: np.ndarray, each: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The largest sum of a window of each text, a word repeated within a window counted once; the texts lie one behind the other."""
    # so much space between them that no window reaches the next one
    slot = np.arange(len(ids)) + np.repeat(np.arange(len(size)) * (WINDOW - 1), size)
    spaced, once = np.full(len(ids) + len(size) * (WINDOW - 1), -1), np.zeros(len(ids) + len(size) * (WINDOW - 1))
    spaced[slot], once[slot] = ids, each
    for k in range(1, WINDOW):
        once[k:][spaced[k:] == spaced[:-k]] = 0.0
    sums = once.copy()
    for k in range(1, WINDOW):
        sums[:-k] += once[k:]
    windows = sums[slot]
    # not those that end beyond their text, unless it has no other
    windows[np.arange(len(ids)) >= np.repeat(first + np.maximum(size - WINDOW + 1, 1), size)] = -np.inf
    return np.maximum.reduceat(windows, first)


def _strongest(ids: np.ndarray, each: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sum of the STRONGEST largest values of different words of each text."""
    left, found = each.copy(), []
    for _ in range(STRONGEST):
        top = np.maximum.reduceat(left, first)
        at = np.flatnonzero(left == np.repeat(top, size))
        text = np.searchsorted(first, at, side="right")
        chosen = ids[at[np.concatenate(([True], text[1:] != text[:-1]))]]
        left[ids == np.repeat(chosen, size)] = -np.inf
        found.append(np.where(np.isinf(top), 0.0, top))
    return sum(reversed(found))


class Keys:
    """Sorted 64-bit keys that are spread evenly: one is sought from the first one with the same leading bits."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.shift = keys, np.uint64(64 - max(len(keys).bit_length(), 1))
        starts = np.searchsorted(keys, np.arange(2 ** max(len(keys).bit_length(), 1), dtype=np.uint64) << self.shift)
        self.starts = np.minimum(starts, max(len(keys) - 1, 0)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each; -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = self.starts[wanted >> self.shift]
        found = self.keys[at]
        low = np.flatnonzero(found < wanted)
        while len(low := low[at[low] < len(self.keys) - 1]):
            at[low] += 1
            found[low] = self.keys[at[low]]
            low = low[found[low] < wanted[low]]
        return np.where(found == wanted, at, -1)


EMPTY = np.uint64(0x2545F4914F6CDD1D)


def _longer(keys: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Keys of strings with one more character."""
    h = (keys ^ symbols) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)


_START = _symbols("^")[0]


def _laid_out(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all words with their start and end, and of each position its word, whether it begins that, and where that ends."""
    symbols = _symbols("".join(f"^{w}$" for w in words))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    until = np.cumsum(size)
    starts = np.zeros(len(symbols), dtype=bool)
    starts[until - size] = True
    return symbols, np.repeat(np.arange(len(words)), size), starts, np.repeat(until, size)


def _substrings(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By length up to ORDER: (key, position) of each substring of each word."""
    symbols, _, _, ends = _laid_out(words)
    at, key = np.arange(len(symbols)), np.full(len(symbols), EMPTY)
    for size in range(1, ORDER + 1):
        keep = at + size <= ends[at]
        at, key = at[keep], key[keep]
        key = _longer(key, symbols[at + size - 1])
        yield key, at


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each n-gram of ``grams_of`` of each word: word, key, key of its history."""
    symbols, owner, starts, ends = _laid_out(words)
    first = np.flatnonzero(starts)
    size = ends[first] - first
    key, parts = np.full(len(symbols), EMPTY), []
    for n in range(1, ORDER + 1):
        if len(symbols) < n:
            break
        history, key = key[: len(symbols) - n + 1], _longer(key[: len(symbols) - n + 1], symbols[n - 1 :])
        if n < ORDER:  # the beginnings of the words alone are shorter
            at = first[size >= n] if n > 1 else first[:0]
        else:
            at = np.flatnonzero(np.arange(n, len(symbols) + 1) <= ends[: len(key)])
        parts.append((owner[at], key[at], history[at]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of the batches, at most some GROUP_WORDS together."""
    rows: list[tuple] = []
    for batch in batches:
        rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        if len(rows) >= GROUP_WORDS:
            yield rows
            rows = []
    if rows:
        yield rows


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    """Weights (bias last) of a ridge-penalised logistic curve, by Newton steps; constant for labels of one kind."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge * weights.sum() / 100] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weights * (p - labels)) + penalty @ w
        hess = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def held_out(id_col: Column) -> Column:
    """Whether crc32(id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def _word_counts(train: DataFrame, text_col: str) -> DataFrame:
    """(word, toxic, ordinary) of rows (text, toxic); counted within each batch first."""
    bound_batches(train.sparkSession)

    def run(batches):
        for batch in batches:
            words: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in words_of(text):
                    words[w][0 if toxic else 1] += 1
            yield pa.RecordBatch.from_pydict({"word": list(words), "toxic": [x[0] for x in words.values()], "ordinary": [x[1] for x in words.values()]},
                                             schema=pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())]))

    part = train.select(quoted(text_col), "toxic").mapInArrow(run, "word string, toxic long, ordinary long")
    return part.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


class SampleGrams:
    """All strings of up to ORDER characters in the sample's words, by length: sorted keys, and the places of each one's history and ending among the
    strings one shorter (the empty string alone, of length 0)."""

    def __init__(self, words: list[str]) -> None:
        parts: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(ORDER)]
        for a in range(0, len(words), GROUP_WORDS):
            own = words[a : a + GROUP_WORDS]
            place = np.zeros(sum(map(len, own)) + 2 * len(own) + 1, dtype=np.int32)
            for part, (key, at) in zip(parts, _substrings(own), strict=True):
                kinds, first, of = np.unique(key, return_index=True, return_inverse=True)
                part.append((kinds, place[at[first]], place[at[first] + 1]))
                place[at] = of
        self.levels: list[tuple[np.ndarray, ...]] = []
        places = [np.zeros(1, dtype=np.int32) for _ in parts[0]]
        for i in range(ORDER):
            part, parts[i] = parts[i], []  # a length's parts are let go before the next one's are joined
            kinds, first = np.unique(np.concatenate([x[0] for x in part]), return_index=True)
            self.levels.append((kinds, *(np.concatenate([own[x[j]] for own, x in zip(places, part, strict=True)])[first] for j in (1, 2))))
            places = [np.searchsorted(kinds, x[0]).astype(np.int32) for x in part]

    @property
    def keys(self) -> np.ndarray:
        """Of the strings of all lengths, sorted."""
        return np.unique(np.concatenate([level[0] for level in self.levels]))

    def probabilities(self, counts: dict[str, tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Keys, sorted, and the lower-order model's probability of each string's last character after the others."""
        shorter, below = np.array([EMPTY]), np.array([FLOOR])
        out = []
        for kinds, history, ending in self.levels:
            total, others = (_looked_up(shorter, counts["history"][0], counts["history"][i])[history] for i in (1, 2))
            others = np.where(total > 0, DISCOUNT * others / np.maximum(total, 1), 1.0)
            p = np.maximum(_looked_up(kinds, *counts["gram"]) - DISCOUNT, 0) / np.maximum(total, 1) + others * below[ending]
            shorter, below = kinds, p
            out.append(p)
        keys, p = np.concatenate([level[0] for level in self.levels]), np.concatenate(out)
        order = np.argsort(keys)
        return keys[order], p[order]


def _looked_up(wanted: np.ndarray, keys: np.ndarray, values: np.ndarray, other: float = 0.0) -> np.ndarray:
    """Values by sorted keys."""
    if not len(keys):
        return np.full(len(wanted), other)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


def corpus_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every different word of the corpus once; each task passes a word on once, as far as it remembers."""

    bound_batches(docs.sparkSession)

    def run(batches):
        sent: set[str] = set()
        out: list[str] = []
        for batch in batches:
            for t in batch.column(0).to_pylist():
                new = set(words_of(t)).difference(sent)
                if len(sent) > CACHE_WORDS:
                    sent.clear()
                sent.update(new)
                out += new
                if len(out) >= GROUP_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["word"])
                    out = []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["word"])

    return docs.select(quoted(text_col).cast("string").alias("text")).mapInArrow(run, "word string").distinct()


def _endings(words: DataFrame, sample) -> DataFrame:
    """(ending, n) of the words, from each of their characters on: as many characters as the sample knows histories for, and ORDER at most."""
    bound_batches(words.sparkSession)

    def run(batches):
        keys = in_worker(sample, Keys)
        for rows in _groups(batches):
            names = [r[0] for r in rows]
            symbols, _, _, ends = _laid_out(names)
            most = np.minimum(ends - np.arange(len(symbols)), ORDER)
            key = np.full(len(symbols), EMPTY)
            for n in range(1, min(ORDER, len(symbols)) + 1):
                part = key[: len(symbols) - n + 1]
                part[:] = np.where(most[: len(part)] >= n, _longer(part, symbols[n - 1 :]), part)
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            # the different ones, cut where the sample knows no longer history
            key, size, alive = np.full(len(first), EMPTY), np.zeros(len(first), dtype=np.int64), np.arange(len(first))
            for n in range(1, ORDER + 1):
                alive = alive[most[first[alive]] >= n]
                if n > 1:
                    alive = alive[keys.find(key[alive]) >= 0]
                key[alive] = _longer(key[alive], symbols[first[alive] + n - 1])
                size[alive] = n
            _, at, of = np.unique(key, return_index=True, return_inverse=True)
            times = np.bincount(of, weights=times).astype(np.int64)
            text, starts = "".join(f"^{w}$" for w in names), first[at]
            found = [text[a:b] for a, b in zip(starts.tolist(), (starts + size[at]).tolist(), strict=True)]
            for a in range(0, len(found), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(found[a : a + BATCH], pa.string()), pa.array(times[a : a + BATCH])], names=["ending", "n"])

    return words.mapInArrow(run, "ending string, n long")


_MASK = (1 << 64) - 1


def _longer_key(key: int, char: str) -> int:
    """``_longer`` of one string."""
    h = (key ^ (ord(char) + 1)) * 0x9E3779B97F4A7C15 & _MASK
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & _MASK
    return h ^ (h >> 29)


def _trie_counts(batches: Iterator[pa.RecordBatch], keys: Keys) -> Iterator[pa.RecordBatch]:
    """Over sorted endings, all with one first pair of characters in one task: (kind, key, n, others) of each of their beginnings; kind 0 (2: a single
    character): how often it occurs, kind 1: how often it goes on, and with how many characters.  Only single characters and strings with one of the keys."""
    last = ""
    for rows in _groups(batches):
        # the ending before these, no longer counted, tells which beginnings are not new
        endings, n = [last, *(r[0] for r in rows)], np.array([0, *(r[1] for r in rows)], dtype=np.int64)
        last = endings[-1]
        symbols = _symbols("".join(endings))
        size = np.fromiter(map(len, endings), dtype=np.int64, count=len(endings))
        begin = np.cumsum(size) - size
        key = np.full(len(endings), EMPTY)
        out: list[tuple[np.ndarray, ...]] = []
        for length in range(1, size.max() + 1):
            at = np.flatnonzero(size >= length)
            history, char = key[at], symbols[begin[at] + length - 1]
            key[at] = longer = _longer(history, char)
            own = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (longer[1:] != longer[:-1]))))
            times, new, history = np.add.reduceat(n[at], own), at[own] > 0, history[own]
            single = length == 1
            told = (times > 0) & (char[own] != _START if single else keys.find(longer[own]) >= 0)  # the start alone is no n-gram
            out.append((np.full(told.sum(), 2 if single else 0), longer[own][told], times[told], np.zeros(told.sum(), dtype=np.int64)))
            if not single:
                same = np.flatnonzero(np.concatenate(([True], history[1:] != history[:-1])))
                times, others, history = np.add.reduceat(times, same), np.add.reduceat(new.astype(np.int64), same), history[same]
                told = (times > 0) & (keys.find(history) >= 0)
                out.append((np.full(told.sum(), 1), history[told], times[told], others[told]))
        kind, found, times, others = map(np.concatenate, zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(_signed(found)), pa.array(times), pa.array(others)], names=["kind", "key", "n", "others"])


def corpus_counts(words: DataFrame, grams: SampleGrams) -> dict[str, tuple[np.ndarray, ...]]:
    """"gram": keys of the sample's strings and how often each occurs in the words; "history": keys, how often a character follows, and how many different ones."""
    spark = words.sparkSession
    sample = hand_out(spark, grams.keys)  # 8 bytes for each string of the bounded sample
    endings = _endings(words, sample)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = endings.repartition(n, F.substring("ending", 1, 2)).sortWithinPartitions("ending")

    def run(batches):
        # an ending's last character may make a string that the sample has not, which no one asks for; single characters all count
        return _trie_counts(batches, in_worker(sample, Keys))

    # a single character is counted in as many tasks as there are characters after it, all else in one
    found = dealt.mapInArrow(run, "kind int, key long, n long, others long").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("others").alias("others")).toArrow()
    sample.destroy()
    kind = found.column(0).to_numpy()
    out = {}
    for name, rows, columns in (("gram", kind != 1, (1, 2)), ("history", kind == 1, (1, 2, 3))):
        key, *values = (found.column(i).to_numpy()[rows] for i in columns)
        if name == "gram":
            single = (kind[rows] == 2).sum(), values[0][kind[rows] == 2].sum()  # all of them follow the empty history
        else:
            values = [np.append(x, one) for x, one in zip(values, single[::-1], strict=True)]
        key = key.astype(np.int64).view(np.uint64) if name == "gram" else np.append(key.astype(np.int64).view(np.uint64), EMPTY)
        order = np.argsort(key)
        out[name] = (key[order], *(x[order] for x in values))
    return out


def sampled_words(train: DataFrame) -> tuple[list[str], np.ndarray]:
    """The words of rows (text, toxic, place), and how often each occurs in toxic and in ordinary texts; of so many rows, by their places, that the words'
    characters keep to MAX_WORD_CHARS."""
    counted = cut_lineage(_word_counts(train, "text"))
    rows = train.agg(F.max("place")).first()[0]
    while (counted.agg(F.sum(F.length("word"))).first()[0] or 0) > MAX_WORD_CHARS and rows:
        rows //= 2
        counted = cut_lineage(_word_counts(train.where(F.col("place") <= rows), "text"))
    found = counted.orderBy("word").toArrow()
    return found.column(0).to_pylist(), np.column_stack([found.column(i).to_numpy() for i in (1, 2)]).astype(np.int64).reshape(-1, 2)


def fitted_tables(train: DataFrame, texts: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Tables of ``HashedDifferences`` from rows (text, toxic, place), which are among the texts."""
    words, each = sampled_words(train)
    if not words:
        return (np.empty(0, dtype=np.uint64), np.empty(0)), (np.empty(0, dtype=np.uint64), np.empty(0))
    grams = SampleGrams(words)
    keys, low = grams.probabilities(corpus_counts(corpus_words(texts), grams))
    del grams
    parts = []
    for a in range(0, len(words), GROUP_WORDS):
        owner, gram, history = word_grams(words[a : a + GROUP_WORDS])
        own = each[a : a + GROUP_WORDS]
        kinds, first, of = np.unique(gram, return_index=True, return_inverse=True)
        parts.append((kinds, history[first], *(np.bincount(of, weights=own[owner, c], minlength=len(kinds)) for c in (0, 1))))
    gram, history, *sums = map(np.concatenate, zip(*parts, strict=True))
    kinds, first, of = np.unique(gram, return_index=True, return_inverse=True)
    counts = np.column_stack([np.bincount(of, weights=x, minlength=len(kinds)) for x in sums])
    histories, at = np.unique(history[first], return_inverse=True)
    sums, seen = (np.column_stack([np.bincount(at, weights=x[:, c], minlength=len(histories)) for c in (0, 1)]) for x in (counts, counts > 0))
    weight = np.where(sums > 0, DISCOUNT * seen / np.maximum(sums, 1), 1.0)
    own = np.where(sums[at] > 0, np.maximum(counts - DISCOUNT, 0) / np.maximum(sums[at], 1), 0.0)
    logs = np.log(own + weight[at] * _looked_up(kinds, keys, low)[:, None])
    weight = np.log(weight)
    return (kinds, logs[:, 0] - logs[:, 1]), (histories, weight[:, 0] - weight[:, 1])


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> DataFrame:
    """(id column, held_out, score) of each row of ``docs``; a score from 0 to 1, higher: toxic likelier.

    Labels of held-out ids (crc32 of the id as text, mod 4, is 2) are never read.  Of several labels of an id the largest counts; null
    labels and ids are ignored.  Null and empty texts score what a text without evidence does; repeated rows stay repeated; without labels
    of both kinds, every score is the share of toxic labels (0 without any).  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    known = (
        labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    take = {0: max_ordinary, 1: max_toxic}
    order = [F.xxhash64("id"), "id"]
    sample = [known.where(F.col("toxic") == c).orderBy(*order).limit(n) for c, n in take.items()]
    # at most max_toxic + max_ordinary ids
    rows = [(r["id"], r["toxic"], i) for part in sample for i, r in enumerate(part.collect())]
    train = texts.join(F.broadcast(spark.createDataFrame(rows, f"id {known.schema['id'].dataType.simpleString()}, toxic int, place int")), "id") \
        .withColumn("calibrate", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(CALIBRATION)) == 0)
    if len(shares) < 2:
        only = float(shares.get(1, 0) > 0)
        return texts.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), F.lit(only).alias("score"))

    shared = hand_out(spark, fitted_tables(train.where("not calibrate"), texts))
    added = T.StructType([T.StructField(n, T.DoubleType()) for n in ("peak", "mean", "strongest")])

    def make():
        model = in_worker(shared, lambda tables: HashedDifferences(*tables))

        def fn(batch):
            return [pa.array(x) for x in model.of_texts(batch).T]

        return fn

    seen = map_text(train.where("calibrate"), "text", added, make, ["toxic"]).collect()  # part of the sample
    curve = [0.0, 0.0, 0.0, math.log(shares[1] / shares[0])]
    if len({r["toxic"] for r in seen}) == 2:
        y = np.array([r["toxic"] for r in seen], dtype=float)
        # labels of each kind weigh as much as among all labelled texts
        each = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
        curve = logistic(np.array([[r["peak"], r["mean"], r["strongest"]] for r in seen]), y, each * len(y) / each.sum()).tolist()
    scored = map_text(texts, "text", added, make, ["id"])
    z = curve[0] * F.col("peak") + curve[1] * F.col("mean") + curve[2] * F.col("strongest") + F.lit(curve[3])
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), (1 / (1 + F.exp(-z))).alias("score"))
