"""Exact removal of repeated byte strings, by suffix arrays over the places where texts can repeat.

A string of LENGTH bytes starts in a window; its anchor is the GRAM-byte string inside it with the smallest hash (the leftmost
among equals).  Equal windows have equal anchors at the same place, so all copies of a window meet under the hash of their
anchor.  Neighbouring windows of a text share an anchor; they are one stretch, with the bytes they cover as its content.

1. Every text is cut into stretches; a row names one by anchor hash, content hash, document, first window and number of windows.
2. Rows meet by anchor hash.  Of equal contents the first stretch stands for all; every other one is a repeat as a whole.
   Anchors with one content only are done.
3. The other contents, one of each, go to blocks by anchor hash; a block's suffixes are sorted in two stages, and runs of neighbours with a common
   prefix of LENGTH bytes or more are the copies of a window: all but the first in the corpus are repeats.
4. The contents of each anchor are added up before they move.  Where one anchor has more than a block may hold, its contents never meet: their windows
   are dealt singly, by digest and salt, then by digest.

A document is known by its id and 82 bits of hashes of its text, so that texts of one id (null is one, too) are kept apart.

Memory is bounded by the batch, the block, or a constant in every task; nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import bound_batches, quoted
from tablefit.llm.suffix_sort import Block, common_prefixes, suffix_array
from tablefit.session import cut_lineage

LENGTH = 100
GRAM = 32  # a power of two
WINDOW = LENGTH - GRAM + 1
#: Bytes that a task cuts into stretches at a time.
PIECE = 1 << 20
#: Bytes of contents that are suffix-sorted together, and those of one anchor above which its windows go on singly.
BLOCK = 1 << 20
BLOCK_MOST = 4 << 20
SALTS = 64
#: A stretch's document tag (18 bits of a second hash of the text), first window and number of windows, in one number.
TAG_BITS, START_BITS, COUNT_BITS = 18, 32, 7
LAST = (1 << 63) - 1  # stands for a null id
#: What a stretch is known by: the id, a hash of the text, and tag, first window and number of windows.
PLACE = ("id", "doc", "pack")

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_POS = np.uint64((1 << 20) - 1)


def gram_hashes(symbols: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on."""
    h = symbols.astype(np.uint64) + np.uint64(1)
    size = 1
    for m in _MULTIPLIERS:
        h = h[:-size] * m + h[size:]
        size *= 2
    assert size == GRAM
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def stretches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of several texts: (text number, first window, number of windows, anchor hash), a group of texts or a part of a long one at a time."""
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE - LENGTH):
            part = text[at : at + PIECE - 1]
            if size + len(part) >= PIECE:
                yield _cut(group)
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield _cut(group)


def _cut(group):
    raw = np.frombuffer(b"".join(g[2] for g in group), dtype=np.uint8)
    hashes = gram_hashes(raw)
    least = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= WINDOW:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (WINDOW - size)], least[WINDOW - size :])
    anchor = (least & _POS).astype(np.int64)
    ends = np.cumsum([len(g[2]) for g in group])
    begins = ends - [len(g[2]) for g in group]
    owner = np.repeat(np.arange(len(group)), ends - begins)[: len(anchor)]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
    at = np.flatnonzero(first)
    until = np.concatenate((at[1:], [len(anchor)]))
    of = owner[at]
    until = np.minimum(until, ends[of] - LENGTH + 1)  # windows end with their text
    at, until, of = (x[until > at] for x in (at, until, of))
    number = np.array([g[0] for g in group])[of]
    offset = np.array([g[1] for g in group])[of] - begins[of]
    return number, at + offset, until - at, hashes[anchor[at]]


def packed(tag, start, count):
    return (tag << (START_BITS + COUNT_BITS)) | (start << COUNT_BITS) | count


def unpacked(pack):
    return pack >> COUNT_BITS & ((1 << START_BITS) - 1), pack & ((1 << COUNT_BITS) - 1)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before in any key."""
    out = np.ones(len(keys[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def _column(x: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    return pa.array(x.astype(np.int64, copy=False) if x.dtype != np.uint64 else x.view(np.int64), mask=missing)


def _find_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, doc, tag, body) to (anchor, content, id, doc, pack).  Repeats within a batch are settled at once: their content is null, their anchor a
    mixed number that only spreads them."""
    for batch in batches:
        ids, docs, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        texts = batch.column(3).to_pylist()
        digest = xxhash.xxh64_intdigest
        found = []
        for number, start, count, anchor in stretches(texts):
            spans = zip(number.tolist(), start.tolist(), (start + count + LENGTH - 1).tolist(), strict=True)
            content = np.fromiter((digest(texts[i][a:b]) for i, a, b in spans), dtype=np.uint64, count=len(number))
            found.append((anchor, content, ids[number], docs[number], packed(tags[number].astype(np.int64), start, count)))
        if not found:
            continue
        anchor, content, owner, doc, pack = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((pack, doc, owner, content, anchor))
        order = order[_firsts(anchor[order], content[order], owner[order], doc[order], pack[order])]  # repeated rows are one document
        anchor, content, owner, doc, pack = (x[order] for x in (anchor, content, owner, doc, pack))
        again = ~_firsts(anchor, content)
        mixed = owner.astype(np.uint64) * _MULTIPLIERS[0] + doc.astype(np.uint64) * _MULTIPLIERS[2] + pack.astype(np.uint64) * _MULTIPLIERS[1]
        anchor = np.where(again, mixed, anchor)
        yield pa.RecordBatch.from_arrays([_column(anchor), _column(content, again), _column(owner), _column(doc), _column(pack)], names=["anchor", "content", *PLACE])


def _settle_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (anchor, content, id, doc, pack): repeats as (null, id, doc, pack), and for anchors with several contents the first
    stretch of each as (anchor, id, doc, pack).  Equal rows come from repeated rows of a document and count once."""
    state = None  # anchor, content, its first stretch while it is the only one
    before = None  # the last row
    for batch in batches:
        settled = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        anchor, *place = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
        content = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        repeats = [[x[settled] for x in place]]
        anchor, content, *place = (x[~settled] for x in (anchor, content, *place))
        fresh = _firsts(anchor, content, *place)
        if len(fresh):
            if before == (anchor[0], content[0], *(x[0] for x in place)):
                fresh[0] = False
            before = (anchor[-1], content[-1], *(x[-1] for x in place))
            anchor, content, *place = (x[fresh] for x in (anchor, content, *place))
        chosen = []
        if len(anchor):
            new_anchor, new_content = _firsts(anchor), _firsts(anchor, content)
            if state is not None and state[0] == anchor[0]:
                new_anchor[0] = False
                new_content[0] = state[1] != content[0]
            repeats.append([x[~new_content] for x in place])
            at = np.flatnonzero(new_content)
            run = np.cumsum(new_anchor)  # 0: goes on from the last batch
            kinds = np.bincount(run[at], minlength=run[-1] + 1)
            several = kinds > 1
            lone = state[2] if state is not None else None
            if not new_anchor[0]:
                several[0] = kinds[0] > 0
                if kinds[0] and lone is not None:
                    chosen.append(tuple(np.array([x]) for x in (state[0], *lone)))
                    lone = None
                elif not kinds[0]:
                    several[0] = False
            take = at[several[run[at]]]
            chosen.append((anchor[take], *(x[take] for x in place)))
            if new_anchor.any():  # another anchor is the last one now
                last = at[run[at] == run[-1]]
                lone = tuple(x[last[0]] for x in place) if len(last) == 1 else None
            state = (anchor[-1], content[-1], lone)
        a = [np.concatenate(x) for x in zip(*repeats, strict=True)]
        b = [np.concatenate(x) for x in zip(*chosen, strict=True)] if chosen else [np.empty(0, dtype=np.int64)] * (1 + len(PLACE))
        n = len(a[0]) + len(b[0])
        if n:
            anchors = _column(np.concatenate((np.zeros(len(a[0]), dtype=np.int64), b[0])), np.arange(n) < len(a[0]))
            yield pa.RecordBatch.from_arrays([anchors, *(_column(np.concatenate(x)) for x in zip(a, b[1:], strict=True))], names=["anchor", *PLACE])


def _fetch_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, doc, body, wanted: array of (anchor, pack, heavy)) to (anchor, null, null, id, doc, pack, body of the stretch), and for heavy anchors to
    (null, digest, digest, id, doc, pack, null) of each window; some thousand at a time."""
    for batch in batches:
        rows = []
        for owner, doc, body, wanted in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            for w in wanted:
                start, count = unpacked(w["pack"])
                if w["heavy"]:
                    tag = w["pack"] >> (START_BITS + COUNT_BITS)
                    for i in range(start, start + count):
                        d = xxhash.xxh3_128_digest(body[i : i + LENGTH])
                        rows.append((None, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), owner, doc, packed(tag, i, 1), None))
                else:
                    rows.append((w["anchor"], None, None, owner, doc, w["pack"], body[start : start + count + LENGTH - 1]))
                if len(rows) > 20_000:
                    yield _contents(rows)
                    rows = []
        if rows:
            yield _contents(rows)


def _contents(rows):
    names = ["anchor", "high", "low", *PLACE, "body"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if n == "body" else pa.int64()) for i, n in enumerate(names)], names=names)


def repeated_windows(bodies: list[bytes], ids: np.ndarray, docs: np.ndarray, packs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, doc, pack) of the windows of a block of stretches that occur earlier in it."""
    block = Block(bodies)
    start, count = unpacked(packs)
    ordered = suffix_array(block, LENGTH)
    text = np.searchsorted(block.ends, ordered)
    offset = ordered - block.starts[text]
    is_window = offset < count[text]
    ordered, text, offset = ordered[is_window], text[is_window], offset[is_window]
    if not len(ordered):
        return ids[:0], docs[:0], packs[:0]
    same = common_prefixes(block, ordered, LENGTH) >= LENGTH
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.lexsort((packs, docs, ids))] = np.arange(len(ids))
    place = (rank[text] << COUNT_BITS) | offset
    first = np.repeat(np.minimum.reduceat(place, heads), np.diff(np.concatenate((heads, [len(place)]))))
    # neighbouring repeats of a stretch become one
    order = np.sort(place[place != first])
    if not len(order):
        return ids[:0], docs[:0], packs[:0]
    runs = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1] + 1)))
    size = np.diff(np.concatenate((runs, [len(order)])))
    row = np.empty(len(ids), dtype=np.int64)
    row[rank] = np.arange(len(ids))
    head = order[runs]
    of, at = row[head >> COUNT_BITS], head & ((1 << COUNT_BITS) - 1)
    return ids[of], docs[of], packed(packs[of] >> (START_BITS + COUNT_BITS), start[of] + at, size)


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over contents sorted by (anchor, id, doc, pack), where equal ones count once: repeats as (null, null, id, doc, pack).  The windows of heavy anchors, which come first, go on as they are."""

    def settled(rows):
        found = repeated_windows([r[4] for r in rows], *(np.array([r[i] for r in rows]) for i in (1, 2, 3)))
        missing = np.ones(len(found[0]), dtype=bool)
        zero = np.zeros(len(missing), dtype=np.int64)
        return pa.RecordBatch.from_arrays([_column(zero, missing), _column(zero, missing), *map(_column, found)], names=["high", "low", *PLACE])

    done: list[tuple] = []  # whole groups
    group: list[tuple] = []  # the anchor in progress
    size = 0
    before = None  # the last row; the same place again is of a repeated row
    last_window = None
    for batch in batches:
        single = batch.column(0).is_null()
        if single.true_count:
            windows = batch.filter(single).select(["high", "low", *PLACE])
            place = [windows.column(n).to_numpy(zero_copy_only=False) for n in PLACE]
            fresh = _firsts(*place)
            fresh[0] = last_window != tuple(x[0] for x in place)
            last_window = tuple(x[-1] for x in place)
            yield windows.filter(pa.array(fresh))
            batch = batch.filter(pc.invert(single))
        for row in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6)), strict=True):
            if row[:4] == before:
                continue
            before = row[:4]
            if group and row[0] != group[0][0]:
                done += group
                group = []
                if size >= BLOCK:
                    yield settled(done)
                    done, size = [], 0
            group.append(row)
            size += len(row[4])
    if done or group:
        yield settled(done + group)


def _settle_windows(last: bool):
    """Over rows sorted by (high, low, id, doc, pack): all but the first of equal digests become repeats; the first goes on, or is dropped by the last pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            passed = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            high, low = (batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(2))
            first = np.zeros(len(high), dtype=bool)
            single = np.flatnonzero(~passed)
            if len(single):
                first[single] = _firsts(high[single], low[single])
                if before == (high[single[0]], low[single[0]]):
                    first[single[0]] = False
                before = (high[single[-1]], low[single[-1]])
            keep = ~first if last else np.ones(len(first), dtype=bool)
            out = pa.RecordBatch.from_arrays([_column(high, ~first), _column(low, ~first), *batch.columns[2:]], names=["high", "low", *PLACE])
            yield out.filter(pa.array(keep))

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, body, array of packs) to (id, n_bytes, n_removed, n_spans, kept bytes, digest)."""
    for batch in batches:
        out = []
        for owner, body, packs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            spans = []
            for start, count in sorted(map(unpacked, packs or ())):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], start + count + LENGTH - 1)
                else:
                    spans.append([start, start + count + LENGTH - 1])
            kept, at = [], 0
            for a, b in spans:
                kept.append(body[at:a])
                at = b
            kept.append(body[at:])
            rest = b"".join(kept)
            out.append((owner, len(body), len(body) - len(rest), len(spans), rest, hashlib.sha256(rest).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_most: int = BLOCK_MOST) -> DataFrame:
    """(id column, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256) of each row of ``docs``.

    Each byte covered by a string of LENGTH bytes that also starts earlier (in a document with a smaller id, or earlier in the same one) is
    removed; strings are judged on the input.  Null and empty texts have no bytes; texts of any length are read whole.  A null id comes after all
    others.  Rows with the same id and text are one document with one result for each row; rows with the same id (or none) and another text are
    documents of their own, in the order of a digest.  Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    given = docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(F.lit(1), text).alias("doc"),
        F.xxhash64(text).bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("tag"), text.cast("binary").alias("body"))
    keys = ["id", "doc", "tag"]

    def tag(pack: Column) -> Column:
        return F.shiftrightunsigned(pack, START_BITS + COUNT_BITS)

    place = "id long, doc long, pack long"
    rows = given.mapInArrow(_find_stretches, f"anchor long, content long, {place}")
    settled = rows.repartition(n, "anchor").sortWithinPartitions("anchor", "content", *PLACE).mapInArrow(_settle_contents, f"anchor long, {place}")
    settled = cut_lineage(settled)

    several = settled.where("anchor is not null")
    size = F.col("pack").bitwiseAND(F.lit((1 << COUNT_BITS) - 1)) + F.lit(LENGTH - 1)
    heavy = cut_lineage(several.groupBy("anchor").agg(F.sum(size).alias("size")).where(F.col("size") > block_most).select("anchor", F.lit(True).alias("heavy")))
    wanted = (
        several.join(heavy, "anchor", "left").select("id", "doc", tag(F.col("pack")).alias("tag"), F.struct("anchor", "pack", F.coalesce("heavy", F.lit(False)).alias("heavy")).alias("w"))
        .groupBy(*keys).agg(F.collect_list("w").alias("wanted"))  # stretches of one document
    )
    windows = f"high long, low long, {place}"
    contents = given.join(wanted, keys).select("id", "doc", "body", "wanted").mapInArrow(_fetch_contents, f"anchor long, {windows}, body binary")
    own = F.xxhash64(*PLACE)
    salted = F.xxhash64("high", F.pmod(F.xxhash64("id", "doc"), F.lit(SALTS)))
    found = contents.repartition(n, F.coalesce("anchor", salted)).sortWithinPartitions("anchor", *PLACE).mapInArrow(_sort_blocks, windows)
    by = ["high", "low", *PLACE]
    salted = F.coalesce(F.when(F.col("high").isNotNull(), salted), own)
    found = found.repartition(n, salted).sortWithinPartitions(*by).mapInArrow(_settle_windows(False), windows)
    found = found.repartition(n, F.coalesce("high", own)).sortWithinPartitions(*by).mapInArrow(_settle_windows(True), windows)

    repeats = settled.where("anchor is null").select(*PLACE).unionAll(found.select(*PLACE))
    by_doc = repeats.groupBy("id", "doc", tag(F.col("pack")).alias("tag")).agg(F.collect_list("pack").alias("packs"))
    done = given.join(by_doc, keys, "left").select("id", "body", "packs").mapInArrow(
        _remove, "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return done.select(F.when(F.col("id") != LAST, F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
