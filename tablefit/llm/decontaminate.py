"""Benchmark decontamination: a broadcast set of the benchmark's word windows, scanned over whole documents.

Words: A-Z lower-cased, runs of digits, letters a-z and anything beyond ASCII.  A window is ``width`` consecutive words
of an item; an item of fewer words, but not none, is one window.  A document word inside any occurrence of a window is hit.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.llm.common import UPPER, hand_out, in_worker, map_text, quoted
from tablefit.session import cut_lineage

WIDTH = 13
#: A block of items whose windows hold at most about this many words is broadcast at once; a larger benchmark is scanned in several blocks.
BLOCK_WORDS = 4_000_000
BASE = np.uint64(0x100000001B3)
FILTER_BITS = 20
#: Fixed values of the contamination rule: hit words are at least 1 / SHARE of all words.
SHARE = 20
_TABLE = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32 for i in range(256)
)
assert UPPER.encode().translate(_TABLE) == UPPER.lower().encode()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WindowIndex:
    """The windows of a block of items: word numbers, rolling sums by length, and the items of each window."""

    def __init__(self, items: list[tuple[str, str]], width: int) -> None:
        self.words: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
            n = min(width, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                windows[tuple(ids[i : i + n])].add(item)
        #: by length: sorted sums, the windows with that sum, and a small filter of the sums' first bits
        self.by_length: dict[int, tuple[np.ndarray, dict[int, list]]] = {}
        sums: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for ids, owners in windows.items():
            total = 0
            for x in ids:
                total = (total * int(BASE) + x) & 0xFFFFFFFFFFFFFFFF
            sums[len(ids)][total].append((ids, sorted(owners)))
        for n, found in sums.items():
            near = np.zeros(1 << FILTER_BITS, dtype=bool)
            near[np.fromiter(found, dtype=np.uint64, count=len(found)) % np.uint64((1 << FILTER_BITS) - 3)] = True
            self.by_length[n] = (near, dict(found))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(words, occurrences as word ranges, items with an occurring window)."""
        words = words_of(text)
        get = self.words.get
        ids = np.fromiter([get(w, 0) for w in words], dtype=np.uint64, count=len(words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        known = ids > 0
        run = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(known, out=run[1:])
        sums = ids
        for n in range(1, max(self.by_length, default=0) + 1):
            if n > len(ids):
                break
            if n > 1:
                sums = sums[:-1] * BASE + ids[n - 1 :]
            if n not in self.by_length:
                continue
            near, found = self.by_length[n]
            at = np.flatnonzero(run[n:] - run[: len(run) - n] == n)  # all words are in the benchmark
            if not len(at):
                if n == 1:
                    break
                continue
            at = at[near[sums[at] % np.uint64((1 << FILTER_BITS) - 3)]]
            for i in at.tolist():
                for window, owners in found.get(int(sums[i]), ()):
                    if tuple(ids[i : i + n].tolist()) == window:
                        spans.append((i, i + n))
                        items.update(owners)
        return len(words), spans, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_ranges", T.ArrayType(T.LongType())),  # start, end, start, end ... in words
    T.StructField("items", T.ArrayType(T.StringType())),
])


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", item_text_col: str = "text",
                       width: int = WIDTH, carry: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The carried columns (all by default), ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``hit_ranges`` and ``contaminated``.

    The benchmark goes to the tasks in blocks of items, by a hash of their texts; the number of blocks follows
    the number of words in its windows, so a broadcast never holds more than about ``block_words`` words.  With more than one
    block, what was found so far is written to the shared folder between the scans.  Null and empty texts have no words;
    items with a null id are ignored; repeated rows on either side change nothing but the number of result rows; carried columns
    with the name of a result give way to it; an empty table gives no rows, an empty benchmark no hits.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("n_words", "n_hit", "items", "hit_ranges", "contaminated")]
    items = benchmark.where(quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("string").alias("item"), F.coalesce(quoted(item_text_col).cast("string"), F.lit("")).alias("words")).distinct()
    # a window has fewer words than ``width`` + 1, an item fewer windows than characters
    size = items.agg(F.sum(F.size(F.split("words", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(size * width / block_words))
    spark = docs.sparkSession
    empty_ranges = F.array().cast("array<bigint>")
    state = docs.select(*[quoted(c).alias(f"__k{i}") for i, c in enumerate(kept)], quoted(text_col).cast("string").alias("__body"),
                        empty_ranges.alias("__ranges"), F.array().cast("array<string>").alias("__items"))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block) if blocks > 1 else items
        shared = hand_out(spark, [(r["item"], r["words"]) for r in part.toLocalIterator()])

        def make(shared=shared):
            index = in_worker(shared, lambda items: WindowIndex(items, width))

            def fn(texts):
                found = [index.scan(t) for t in texts]
                return [pa.array([n for n, _, _ in found], pa.int64()),
                        pa.array([[x for r in _merged(s) for x in r] for _, s, _ in found], pa.list_(pa.int64())),
                        pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string()))]

            return fn

        state = map_text(state, "__body", FOUND, make)
        state = state.select(
            *[f"__k{i}" for i in range(len(kept))], "__body", "n_words",
            F.concat("__ranges", "hit_ranges").alias("__ranges"), F.array_union("__items", "items").alias("__items"))
        if block + 1 < blocks:
            state = cut_lineage(state.drop("n_words"))
    ranges = _merge_ranges(F.col("__ranges")) if blocks > 1 else F.col("__ranges")
    done = state.withColumn("hit_ranges", ranges).withColumn("items", F.array_sort("__items"))
    half = F.transform(F.col("hit_ranges"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    done = done.withColumn("n_hit", F.aggregate(half, F.lit(0).cast("long"), lambda a, x: a + x))
    return done.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(kept)], "n_words", "n_hit", "items", "hit_ranges",
                       ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def _merge_ranges(flat):
    """Ranges found in different blocks, merged where they overlap."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(F.size(flat) / 2, F.lit(1)).cast("int") - 1),
                                     lambda i: F.struct(F.get(flat, 2 * i).alias("s"), F.get(flat, 2 * i + 1).alias("e"))))

    def step(out, p):
        last = F.element_at(out, -1)
        return F.when((F.size(out) > 0) & (p["s"] <= last), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.greatest(last, p["e"])))) \
            .otherwise(F.concat(out, F.array(p["s"], p["e"])))

    empty = F.array().cast("array<bigint>")
    return F.when(F.size(flat) > 0, F.aggregate(pairs, empty, step)).otherwise(empty)
