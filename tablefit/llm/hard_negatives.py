"""Hard negatives by exact integer inner products.

1. Anchors and candidates are dealt to tiles by a hash of their ids; every anchor tile meets every candidate tile in one task
   (the anchors are the stated query set; each tile is sent once for each tile of the other kind).
2. A pair of tiles is multiplied by Strassen's recursion on int64 matrices, zero rows and columns filling up odd sizes, additions of integers
   only, so that scores are exact.
3. Each pair of tiles gives a heap of the best positives of each anchor; heaps are merged by anchor.
4. The positives' scores make a window of each positive; a second run over the tiles gives a heap for each window, merged in the same way.

A task holds two tiles and the scores of SLICE anchors by SLICE candidates, whatever the size of the table, the labels or groups of equal vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import quoted
from tablefit.llm.ranked import NONE, Heap, first_of_rows, merged
from tablefit.session import cut_lineage

#: Rows of an anchor tile and of a candidate tile, about (they are dealt by hash), and rows of either whose scores are held at once.
ANCHOR_TILE = 16_384
CANDIDATE_TILE = 65_536
SLICE = 1024
#: Strassen's recursion goes down to this number of columns or fewer on any side.
LEAF = 16
#: Fixed values of the query contract.
ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 5
WINDOW_PERCENT = (80, 100)
SCALE = 256


def _padded(x: np.ndarray, rows: int, cols: int) -> np.ndarray:
    if x.shape == (rows, cols):
        return x
    out = np.zeros((rows, cols), dtype=np.int64)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices: seven products of halves instead of eight; odd sides get a zero row or column."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        out = np.zeros((m, n), dtype=np.int64)
        for j in range(k):  # sums of outer products
            out += a[:, j : j + 1] * b[j]
        return out
    hm, hk, hn = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = _padded(a, 2 * hm, 2 * hk), _padded(b, 2 * hk, 2 * hn)
    a11, a12, a21, a22 = a[:hm, :hk], a[:hm, hk:], a[hm:, :hk], a[hm:, hk:]
    b11, b12, b21, b22 = b[:hk, :hn], b[:hk, hn:], b[hk:, :hn], b[hk:, hn:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * hm, 2 * hn), dtype=np.int64)
    out[:hm, :hn] = p1 + p4 - p5 + p7
    out[:hm, hn:] = p3 + p5
    out[hm:, :hn] = p2 + p4
    out[hm:, hn:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Tile:
    """Rows of (id, label, ints) in the order of their ids, and their vectors as a matrix, shorter ones filled up with zeros."""

    def __init__(self, rows: pa.Table) -> None:
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        lists = rows.column("ints").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], rows.schema.field("ints").type)
        starts = lists.offsets.to_numpy()
        sizes = np.diff(starts)
        flat = lists.flatten().to_numpy()
        starts = starts[:-1] - starts[0] if len(sizes) else starts[:0]
        wide = int(sizes.max()) if len(sizes) else 0
        self.ids, self.order = ids[order], order
        self.labels = rows.column("label").to_numpy()[order]
        if len(sizes) and (sizes == wide).all():
            self.vectors = flat.reshape(len(sizes), wide)[order]
        else:
            self.vectors = np.zeros((len(sizes), wide), dtype=np.int64)
            for at, i in enumerate(order):
                self.vectors[at, : sizes[i]] = flat[starts[i] : starts[i] + sizes[i]]


def _table(**columns) -> pa.Table:
    return pa.table({n: pa.array(x, pa.int64()) for n, x in columns.items()})


def _scores(anchors: Tile, candidates: Tile):
    """(slice of the anchors, slice of the candidates, scores) until every anchor has met every candidate."""
    wide = max(anchors.vectors.shape[1], candidates.vectors.shape[1])
    for i in range(0, len(anchors.ids), SLICE):
        a = anchors.vectors[i : i + SLICE]
        a = _padded(a, len(a), wide)
        for j in range(0, len(candidates.ids), SLICE):
            c = candidates.vectors[j : j + SLICE]
            c = np.ascontiguousarray(_padded(c, len(c), wide).T)
            yield slice(i, i + len(a)), slice(j, j + c.shape[1]), strassen(a, c)


def tile_positives(anchors: Tile, candidates: Tile, most: int) -> Heap:
    """Of each anchor (by place), the best other candidates of its label."""
    heap = Heap(most)
    for a, c, scores in _scores(anchors, candidates):
        fits = (anchors.labels[a, None] == candidates.labels[None, c]) & (anchors.ids[a, None] != candidates.ids[None, c])
        scores = np.where(fits, scores, NONE)
        row, col = first_of_rows(scores, most)
        heap.add(row + a.start, scores[row, col], candidates.ids[c][col])
    return heap


def tile_negatives(anchors: Tile, windows: list[np.ndarray], candidates: Tile, most: int, low: int, high: int) -> Heap:
    """Of each window (anchor's place * their number + place of its score, of ``windows``: scores of each anchor by rank, NONE where there is none), the
    best candidates of another label inside it."""
    heap = Heap(most)
    for a, c, scores in _scores(anchors, candidates):
        other = anchors.labels[a, None] != candidates.labels[None, c]
        percent = scores * 100
        for k, window in enumerate(windows):
            own = window[a]
            some = own != NONE
            fits = other & some[:, None] & (percent >= np.where(some, own, 0)[:, None] * low) & (percent <= np.where(some, own, 0)[:, None] * high)
            held = np.flatnonzero(fits.any(axis=1))
            if len(held):
                inside = np.where(fits[held], scores[held], NONE)
                row, col = first_of_rows(inside, most)
                heap.add((held[row] + a.start) * len(windows) + k, inside[row, col], candidates.ids[c][col])
    return heap


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, ints): one row for each id that has a label and a vector of finite components, which become floor(SCALE * x)."""
    given = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("long").alias("label"),
                           quoted(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    ints = F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))
    return usable.select("id", "label", ints.alias("ints")).groupBy("id").agg(F.min(F.struct("label", "ints")).alias("own")).select("id", "own.label", "own.ints")


def _tiles(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _dealt(rows: DataFrame, own: str, of_own: int, other: str, of_other: int, seed: int) -> DataFrame:
    """Each row in its own tile, once for each tile of the other kind."""
    return rows.withColumn(own, F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(of_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(of_other - 1))))


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchor: Column | None = None,
                        positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW_PERCENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), for each anchor and each of its positives.

    ``anchor`` says of a row's ``id`` column whether it is an anchor (ids divisible by ANCHOR_STEP unless given).  Scores are inner products of the components
    floor(SCALE * x), higher first, ties by smaller id.  Positives are the first others of the anchor's label; negatives the first rows of another
    label whose score lies within ``window`` percent of the positive's.  Anchors without positives, and positives without negatives, give no rows.
    Rows with a null id, label, vector or component or a component that is not finite take no part.  Rows of one id are one row: that of the smallest
    label, then vector.  Vectors of different lengths are compared as if the shorter one went on with zeros.  Arithmetic is exact below 2^63 / 100 and
    modulo 2^64 beyond.  Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(usable_vectors(vectors, id_col, vector_col, label_col))
    anchors = rows.where(anchor if anchor is not None else F.col("id") % ANCHOR_STEP == 0)
    # candidates in as many tiles as there are tasks at once, or more
    of_anchors, of_candidates = _tiles(anchors.count(), ANCHOR_TILE), max(_tiles(rows.count(), CANDIDATE_TILE), spark.sparkContext.defaultParallelism)
    low, high = window

    def pairs(sought: DataFrame, make, schema: str) -> DataFrame:
        """``make(anchor rows, candidate rows)`` of every pair of tiles; ``sought``: anchors with their positives' scores by rank."""
        a = _dealt(sought, "anchor_tile", of_anchors, "candidate_tile", of_candidates, 2)
        c = _dealt(rows, "candidate_tile", of_candidates, "anchor_tile", of_anchors, 1).withColumn("scores", F.lit(None).cast("array<long>"))
        both = a.withColumn("sought", F.lit(True)).unionByName(c.withColumn("sought", F.lit(False)))

        def run(group: pa.Table) -> pa.Table:
            sides = [group.filter(pc.equal(group.column("sought"), side)) for side in (True, False)]
            return make(*sides)

        return both.groupBy("anchor_tile", "candidate_tile").applyInArrow(run, schema)

    def positives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        a = Tile(left)
        heap = tile_positives(a, Tile(right), positives)
        return _table(anchor_id=a.ids[heap.group], positive_id=heap.id, positive_score=heap.score)

    parts = pairs(anchors.withColumn("scores", F.lit(None).cast("array<long>")), positives_of, "anchor_id long, positive_id long, positive_score long")
    best = cut_lineage(merged(parts, ["anchor_id"], [F.desc("positive_score"), "positive_id"], positives, "place"))

    own = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("own"))  # at most ``positives``
    sought = anchors.join(own, F.col("id") == F.col("anchor_id")).select("id", "label", "ints", F.col("own.positive_score").alias("scores"))

    def negatives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        a = Tile(left)
        given = left.column("scores").to_pylist()
        windows = [np.array([given[i][k] if k < len(given[i]) else NONE for i in a.order], dtype=np.int64) for k in range(positives)]
        heap = tile_negatives(a, windows, Tile(right), negatives, low, high)
        return _table(anchor_id=a.ids[heap.group // positives], place=heap.group % positives + 1, negative_id=heap.id, negative_score=heap.score)

    parts = pairs(sought, negatives_of, "anchor_id long, place long, negative_id long, negative_score long")
    found = merged(parts, ["anchor_id", "place"], [F.desc("negative_score"), "negative_id"], negatives)
    return found.join(best, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
