"""SimHash near-dedup by covering locality-sensitive hashing.

A map gives each of the 64 bits a non-zero vector of radius + 1 bits.  Table v (a non-zero vector) keeps the bits whose vector
has an odd product with v.  Any ``radius`` differing bits have vectors that some v is orthogonal to, so in table v none of
them is kept: every pair within the radius collides in some table (2^(radius+1) - 1 tables, about half of the bits in each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.llm.common import bound_batches, map_text, quoted
from tablefit.llm.components import connected_components
from tablefit.session import cut_lineage

BITS = 64
#: Distinct fingerprints that one task compares with each other at first; larger buckets are dealt out by a second family
#: of masks over the bits that the first one left out, which leaves at most about 2^17 different values in a bucket.
BUCKET = 2048
SEED = 42
_SPACES = b" \t\n\r\x0b\x0c"


def _vectors(bits: list[int], radius: int) -> dict[int, int]:
    n = 2 ** (radius + 1) - 1
    return {b: i % n + 1 for i, b in enumerate(bits)}


def covering_masks(radius: int, bits: list[int] | None = None) -> list[int]:
    """The bit mask of each table, over the given bits (all by default)."""
    vec = _vectors(list(range(BITS)) if bits is None else bits, radius)
    return [sum(1 << b for b, m in vec.items() if (m & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, width: int) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z lower-cased.

    Words are runs without ASCII white space; shingles of ``width`` words are joined by one space and counted as often as they
    occur; a text of fewer words is one shingle; without words the fingerprint is zero.  A bit is 1 if it is set in over half of the
    shingles' XXH64 values.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - width]))
    stops = ends[width - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    view = memoryview(joined)
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)), dtype=np.uint64, count=len(starts))
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(2 * votes > len(hashes))
    return sum(1 << int(b) for b in on)


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of each row; null texts are empty."""

    def make():
        return lambda texts: [pa.array([_signed(fingerprint(t, width)) for t in texts], pa.int64())]

    return map_text(docs, text_col, T.StructType([T.StructField("__fp", T.LongType())]), make, [id_col]).select(
        quoted(id_col).cast("long").alias("id"), F.col("__fp").alias("fp"))


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of a bucket that reach each other: one for each but the first of a group."""
    left, a, b = fps, [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    none = np.empty(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


LINK_SCHEMA = "a long, b long, v int, key long"


def _link_buckets(radius: int, limit: int | None):
    """Over rows (v, key, fp) sorted by key: links (a, b) within each bucket; of a bucket with more than ``limit`` rows, the rows
    instead, as (fp, null, v, key)."""

    def made(a, b=None, v=None, key=None):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.nulls(n, pa.int64()) if b is None else pa.array(b.view(np.int64)),
             pa.nulls(n, pa.int32()) if v is None else pa.array(v), pa.nulls(n, pa.int64()) if key is None else pa.array(key)],
            names=["a", "b", "v", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows so far of the bucket in progress
        large = None  # or its key, if its rows are passed on
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            v, key, fp = rows[0], rows[1], rows[2].view(np.uint64)
            if not len(key):
                continue
            held = None
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            sizes = np.diff(cuts)
            links = []
            for i in sorted({0, len(sizes) - 1, *np.flatnonzero(sizes > 1).tolist()}):
                s, e = cuts[i], cuts[i + 1]
                if large == key[s] or limit and e - s > limit:
                    large = key[s]
                    yield made(fp[s:e], None, v[s:e], key[s:e])
                elif i == len(sizes) - 1:
                    held = [x[s:e] for x in rows]
                else:
                    links.append(_forest(fp[s:e], radius))
            yield from (made(*x) for x in links if len(x[0]))
        if held is not None:
            yield made(*_forest(held[2].view(np.uint64), radius))

    return run


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different values of ``fp`` (distinct longs) that join all that reach each other by steps of ``radius`` bits or fewer.

    Each value goes to one bucket of each table.  A task reads its buckets in the order of their keys and holds one at a time.
    """
    bound_batches(distinct.sparkSession)
    masks = covering_masks(radius)
    dealt = (
        distinct.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("v", "mask"))
        .select("v", F.xxhash64("v", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp")
    )
    first = _by_bucket(dealt, radius, BUCKET)
    first = cut_lineage(first)
    inner = [covering_masks(radius, [b for b in range(BITS) if not m >> b & 1]) for m in masks]
    flat = F.array(*[F.lit(_signed(m)) for row in inner for m in row])
    again = (
        first.where("b is null").select(F.col("a").alias("fp"), "v", "key", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("w"))
        .select("v", F.xxhash64("key", "w", F.col("fp").bitwiseAND(F.get(flat, F.col("v") * len(masks) + F.col("w")))).alias("key"), "fp")
    )
    return first.where("b is not null").select("a", "b").unionAll(_by_bucket(again, radius, None).select("a", "b"))


def _by_bucket(dealt: DataFrame, radius: int, limit: int | None) -> DataFrame:
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_link_buckets(radius, limit), LINK_SCHEMA)


def _rooted(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, least, root): of each fingerprint the smallest id that has it, and the smallest fingerprint that it reaches."""
    classes = fps.groupBy("fp").agg(F.min("id").alias("least"))
    found = connected_components(fingerprint_links(classes.select("fp"), radius))
    return classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id column, fingerprint, component_id) for each row of ``docs``.

    Fingerprints at ``radius`` or fewer differing bits are linked; ``component_id`` is the smallest id among all rows
    reachable over links, the row itself included (null only if all those ids are null).  Null and empty texts have fingerprint zero, linked
    like any other; repeated rows stay repeated; other columns are ignored; an empty table gives no rows.
    """
    fps = cut_lineage(fingerprints(docs, width, id_col, text_col))
    rooted = cut_lineage(_rooted(fps, radius))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component only the row with the smallest id stays (null ids come last; of several rows with that
    id and fingerprint, the one first by a hash of its columns)."""
    fps = cut_lineage(fingerprints(docs, width, id_col, text_col))
    keepers = (
        _rooted(fps, radius).groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("k"))
        .select(F.col("k.least").alias("__id"), F.col("k.fp").alias("__keep"))
    )

    def make():
        return lambda texts: [pa.array([_signed(fingerprint(t, width)) for t in texts], pa.int64())]

    marked = map_text(docs, text_col, T.StructType([T.StructField("__fp", T.LongType())]), make)
    kept = marked.join(keepers, (F.col("__fp") == F.col("__keep")) & quoted(id_col).cast("long").eqNullSafe(F.col("__id")))
    one = Window.partitionBy("__keep", "__id").orderBy(F.xxhash64(*map(quoted, docs.columns)))
    return kept.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").select(*map(quoted, docs.columns))
