"""Ranked lexical search for many items at once.

1. Items go in blocks of bounded size.  Terms that the same items hold are one node; nodes that stand together in several items are joined to new
   nodes, the most shared pair first, until no pair is shared: the items' sums are then paths in one graph, in which every shared set of
   terms is a node of its own.
2. One scan of the documents counts each document's terms and keeps those of the block: number of terms, and how often each searched one occurs.  The
   counts are written to the shared folder; the corpus' statistics are sums over them.
3. Over the written counts, the nodes' sums of some documents are worked out once each, along the graph, and added up for each item; the best documents
   of an item go to a heap, and the tasks' heaps are merged by item.

A task holds a block's graph and the sums of as many documents as CELLS allows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.llm.common import bound_batches, hand_out, in_worker, map_text, quoted
from tablefit.llm.ranked import Heap, first_of_rows, merged
from tablefit.session import scratch_path

#: Terms of the items of one block, about (items are dealt to blocks by hash), and int64 sums held by a task at once.
BLOCK_TERMS = 50_000
CELLS = 4_000_000
#: Fixed values of the query contract.
BEST = 10
LAST = (1 << 63) - 1  # stands for a null document id

#: Bytes that belong to a term, A-Z in lower case; all others become spaces.
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def share(sums: list[list[int]], nodes: int) -> list[tuple[int, int]]:
    """Joins neighbouring nodes of the sums (in place) to new ones, numbered from ``nodes`` on, while two sums share a pair; the pairs joined."""
    held = defaultdict(set)
    for i, s in enumerate(sums):
        for pair in pairwise(s):
            held[pair].add(i)
    heap = [(-len(of), pair) for pair, of in held.items() if len(of) > 1]
    heapq.heapify(heap)
    joined = []
    while heap:
        n, pair = heapq.heappop(heap)
        of = held[pair]
        if len(of) != -n:
            if len(of) > 1:
                heapq.heappush(heap, (-len(of), pair))
            continue
        z = nodes + len(joined)
        joined.append(pair)
        grown = set()
        for i in sorted(of):
            s = sums[i]
            at = s.index(pair[0])
            if at:
                held[s[at - 1], pair[0]].discard(i)
                held[s[at - 1], z].add(i)
                grown.add((s[at - 1], z))
            if at + 2 < len(s):
                held[pair[1], s[at + 2]].discard(i)
                held[z, s[at + 2]].add(i)
                grown.add((z, s[at + 2]))
            s[at : at + 2] = [z]
        del held[pair]
        for p in grown:
            if len(held[p]) > 1:
                heapq.heappush(heap, (-len(held[p]), p))
    return joined


class SharedSums:
    """The graph of a block of items: ``node_of`` each term, pairs of nodes by level, and the nodes of each item's sum."""

    def __init__(self, items: list[set[bytes]]) -> None:
        holders = defaultdict(list)
        for i, terms in enumerate(items):
            for t in terms:
                holders[t].append(i)
        self.terms = sorted(holders)
        atoms: dict[tuple[int, ...], int] = {}
        self.node_of = np.array([atoms.setdefault(tuple(holders[t]), len(atoms)) for t in self.terms], dtype=np.int64)
        shared = sorted(atoms, key=lambda of: (-len(of), of))
        self.sums: list[list[int]] = [[] for _ in items]
        for of in shared:
            for i in of:
                self.sums[i].append(atoms[of])
        joined = share(self.sums, len(atoms))
        self.n_nodes = len(atoms) + len(joined)
        level = [0] * self.n_nodes
        for k, (x, y) in enumerate(joined):
            level[len(atoms) + k] = 1 + max(level[x], level[y])
        self.levels = []
        for depth in range(1, max(level, default=0) + 1):
            made = [z for z in range(len(atoms), self.n_nodes) if level[z] == depth]
            self.levels.append(tuple(np.array(x) for x in (made, *zip(*(joined[z - len(atoms)] for z in made)))))

    def scores(self, doc: np.ndarray, term: np.ndarray, points: np.ndarray, n_docs: int) -> np.ndarray:
        """Items by documents: sums of the points of the items' terms, each node's sum worked out once."""
        sums = np.zeros((self.n_nodes, n_docs), dtype=np.int64)
        np.add.at(sums, (self.node_of[term], doc), points)
        for made, left, right in self.levels:
            sums[made] = sums[left] + sums[right]
        return np.stack([sums[s].sum(axis=0) for s in self.sums])


def _count_terms(given: DataFrame, shared) -> DataFrame:
    """(id, n, terms, times) of rows (id, text): all terms of a text, and which of the searched ones occur how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = in_worker(shared, lambda terms: {t: i for i, t in enumerate(terms)})
        for batch in batches:
            sizes, ends, terms, times = [], [0], [], []
            for text in batch.column(1).to_pylist():
                all_terms = terms_of(text)
                sizes.append(len(all_terms))
                found = Counter(filter(number.__contains__, all_terms))
                terms += [number[t] for t in found]
                times += found.values()
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "times"])

    return given.mapInArrow(run, "id long, n long, terms array<int>, times array<long>")


def _best_of_parts(counts: DataFrame, shared, best: int) -> DataFrame:
    """(item, id, score): the best documents of each item within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights, n_docs, n_terms = in_worker(shared, lambda x: x)
        heap = Heap(best)
        step = max(1, CELLS // max(graph.n_nodes, 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                place = np.empty(len(ids), dtype=np.int64)
                place[order] = np.arange(len(ids))
                lists = [batch.column(i) for i in (2, 3)]
                doc = place[np.repeat(np.arange(len(ids)), np.diff(lists[0].offsets.to_numpy()))]
                term, times = (x.flatten().to_numpy() for x in lists)
                # Python's integers: n * N may leave 64 bits
                more = np.array([8 * (10 + 90 * n * n_docs // n_terms) for n in batch.column(1).to_pylist()], dtype=np.int64)[order]
                points = weights[term] * (1_000_000_000 * times // (1000 * times + more[doc]))
                scores = graph.scores(doc, term, points, len(ids))
                item, col = first_of_rows(np.where(scores > 0, scores, np.iinfo(np.int64).min), best)
                heap.add(item, scores[item, col], ids[order][col])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (heap.group, heap.id, heap.score)], names=["item", "id", "score"])

    return counts.mapInArrow(run, "item long, id long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item column, ``rank``, id column, ``score``): of each item the ``best`` documents with the highest scores above 0, equal ones by ascending id.

    A document's score is the sum over the item's terms, once each, of weight * (10^9 * tf div (1000 * tf + 8 * m)), with weight = floor(1000 * ln((2N + 2) / (2df + 1)))
    and m = 10 + (90 * n * N div L), over all documents.  Terms are runs of digits, letters and all characters beyond ASCII, A-Z in lower case.
    Null and empty texts have no terms; an item without terms, or none of whose terms occurs, gives no rows.  Rows of one item id (null is one, too) are one item
    with the terms of all; every row of ``docs`` is a document, so repeated rows rank one after the other, and null ids come last among equals.  Texts of
    any length are read whole; an item's terms are held by one task.  Other columns are ignored, whatever their names; empty tables give no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    result = T.StructType([T.StructField(item_col, items.schema[item_col].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField(id_col, T.LongType()), T.StructField("score", T.LongType())])
    own = items.select(quoted(item_col).alias("item_id"), quoted(item_text_col).alias("text"))
    added = T.StructType([T.StructField("terms", T.ArrayType(T.BinaryType()))])
    listed = map_text(own, "text", added, lambda: lambda texts: [pa.array([sorted(set(terms_of(t))) for t in texts], pa.list_(pa.binary()))], ["item_id"])
    total = listed.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_terms)
    given = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(LAST)).alias("id"), quoted(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], result)
    for block in range(blocks):
        terms = defaultdict(set)
        for r in listed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():  # some block_terms
            terms[r["item_id"]].update(map(bytes, r["terms"]))
        names = [i for i, t in terms.items() if t]
        if names:
            best_docs = _search_block(given, [terms[i] for i in names], best)
            ids = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", result[0].dataType)]))
            found = found.unionAll(best_docs.join(F.broadcast(ids), "item").select(  # no more ids than terms in a block
                "item_id", "rank", F.when(F.col("id") != LAST, F.col("id")), "score"))
    return found


def _search_block(given: DataFrame, items: list[set[bytes]], best: int) -> DataFrame:
    """(item, rank, id, score) of some items, by their numbers."""
    spark = given.sparkSession
    graph = SharedSums(items)
    path = scratch_path(spark, "terms")
    _count_terms(given, hand_out(spark, graph.terms)).write.parquet(path)
    counts = spark.read.parquet(path)
    sizes = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    holders = {r["term"]: r["count"] for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # no more than in a block
    weights = np.array([math.floor(1000 * math.log((2 * sizes["docs"] + 2) / (2 * holders.get(t, 0) + 1))) for t in range(len(graph.terms))], dtype=np.int64)
    parts = _best_of_parts(counts, hand_out(spark, (graph, weights, sizes["docs"], sizes["terms"] or 1)), best)
    return merged(parts, ["item"], [F.desc("score"), "id"], best)
