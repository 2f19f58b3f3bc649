"""Suffix arrays of byte blocks by two-stage sorting, with adjacent common prefixes."""

from __future__ import annotations

import numpy as np

WORD = 8


class Block:
    """Texts laid out one after another, each ended by a zero; bytes are raised by one (255 does not occur in UTF-8).

    A suffix ends with its text.  ``text_of`` and ``offset`` give a position's text and its place in it.
    """

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        raw = np.frombuffer(b"\0".join(texts) + b"\0" * (WORD + 1), dtype=np.uint8)
        self.symbols = raw + np.uint8(1)
        self.ends = np.cumsum(sizes + 1) - 1
        self.symbols[self.ends] = 0
        self.symbols[int(self.ends[-1]) + 1 :] = 0
        self.size = int(self.ends[-1]) + 1
        self.starts = self.ends - sizes
        at = self.symbols.astype(np.uint64)
        word = at[: self.size].copy()
        for k in range(1, WORD):
            word = (word << np.uint64(8)) | at[k : k + self.size]
        #: the eight symbols from each position on, as one number; what follows an end is masked when read
        self.words = word

    def left(self, positions: np.ndarray) -> np.ndarray:
        """Bytes from each position to the end of its text."""
        return self.ends[np.searchsorted(self.ends, positions)] - positions

    def word_at(self, positions: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
        """The eight symbols ``depth`` after each position, zeros beyond the end of the text."""
        rest = np.clip(left - depth, 0, WORD)
        word = self.words[np.minimum(positions + depth, self.size - 1)]
        cut = (8 * (WORD - rest)).astype(np.uint64)
        return np.where(rest > 0, (word >> np.minimum(cut, np.uint64(63))) << np.minimum(cut, np.uint64(63)), np.uint64(0))


def ascending(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor: the first symbol that differs from its own is larger."""
    n = len(symbols)
    run_ends = np.concatenate((np.flatnonzero(symbols[1:] != symbols[:-1]) + 1, [n]))
    runs = np.diff(np.concatenate(([0], run_ends)))
    following = np.concatenate((symbols[run_ends[:-1]], [0]))
    return np.repeat(following, runs) > symbols


def sort_directly(block: Block, positions: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes or more, eight at a time; only what is still equal is sorted on."""
    if not len(positions):
        return positions
    left = block.left(positions)
    first = block.word_at(positions, left, 0)
    order = np.argsort(first, kind="stable")
    order_pos, left, first = positions[order], left[order], first[order]
    group = np.cumsum(np.concatenate(([0], first[1:] != first[:-1])))
    for at in range(WORD, depth, WORD):
        same = np.zeros(len(group) + 1, dtype=bool)
        same[1:-1] = group[1:] == group[:-1]
        tied = np.flatnonzero((same[1:] | same[:-1]) & (left > at - WORD))
        if not len(tied):
            break
        key = block.word_at(order_pos[tied], left[tied], at)
        moved = tied[np.lexsort((key, group[tied]))]
        order_pos[tied], left[tied] = order_pos[moved], left[moved]
        key = block.word_at(order_pos[tied], left[tied], at)
        fresh = np.zeros(len(group), dtype=np.int64)
        fresh[tied[1:]] = (key[1:] != key[:-1]) & (group[tied[1:]] == group[tied[:-1]])
        # ties that end here and longer ones: the shorter come first, as zero is below every symbol
        group = group + np.cumsum(fresh)
    return order_pos


def suffix_array(block: Block, depth: int) -> np.ndarray:
    """All positions but the ends, in the order of their suffixes' first ``depth`` bytes.

    Stage one sorts the suffixes that are smaller than their successors.  Stage two induces the others, bucket by bucket
    of the first symbol: a suffix larger than its successor takes its place in the order in which the successors
    appear; those of the same symbol as their successor follow in layers.
    """
    symbols = block.symbols[: block.size]
    small = ascending(symbols) & (symbols > 0)
    direct = sort_directly(block, np.flatnonzero(small), depth)
    cuts = np.searchsorted(symbols[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(successors: np.ndarray, above: int) -> None:
        before = successors[successors > 0] - 1
        symbol = symbols[before]
        before, symbol = before[symbol > above], symbol[symbol > above]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        values, starts = np.unique(symbol, return_index=True)
        for v, part in zip(values.tolist(), np.split(before, starts[1:]), strict=True) if len(values) else ():
            waiting[v].append(part)

    induce(block.ends, 0)
    out = []
    for c in range(1, 256):
        layers = [np.concatenate(waiting[c])] if waiting[c] else []
        while layers and len(layers[-1]):
            before = layers[-1] - 1
            before = before[before >= 0]
            layers.append(before[symbols[before] == c])
        waiting[c] = []
        bucket = np.concatenate([*layers, direct[cuts[c] : cuts[c + 1]]]) if layers else direct[cuts[c] : cuts[c + 1]]
        if len(bucket):
            induce(bucket, c)
            out.append(bucket)
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


def common_prefixes(block: Block, ordered: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each two neighbours in ``ordered``, up to ``limit``."""
    a, b = ordered[:-1], ordered[1:]
    left = np.minimum(block.left(a), block.left(b)) if len(a) else np.empty(0, dtype=np.int64)
    out = np.zeros(len(a), dtype=np.int64)
    on = np.arange(len(a))
    for at in range(0, limit, WORD):
        x = block.word_at(a[on], left[on], at) ^ block.word_at(b[on], left[on], at)
        same = x == 0
        # leading equal bytes of a differing word
        bits = np.zeros(len(x), dtype=np.int64)
        bits[~same] = (63 - np.floor(np.log2(x[~same].astype(np.longdouble))).astype(np.int64)) // 8
        out[on] = np.minimum(at + np.where(same, WORD, bits), left[on])
        on = on[same & (left[on] > at + WORD)]
        if not len(on):
            break
    return np.minimum(out, limit)
