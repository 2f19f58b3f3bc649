"""Forests of classification trees grown on many rows.

Spark's learner keeps, in every part of the rows, the counts of all nodes of a level, and sends them on at each level.  Deep trees have many thousands of
nodes, so most of the time of a deep forest goes into those sums, whatever the rows.  ``ForestClassifier`` grows the same trees in another order:

1. The rows are binned once, by Spark's rule for thresholds, into chunks of one byte a feature; of 0/1 slots only those that are 1 are kept.
2. As long as a node of a tree has more than ``ROWS_AT_NODE`` rows, its counts are summed over the cluster, as Spark does.
3. The drawn rows of smaller nodes are sent, by tree and group of nodes, to one task each, which grows all that is below them.

Every row, tree, feature and level is used; the choice of a split, its gain in every digit, the end of growth and the merging of equal leaves are
Spark's, so with ``bootstrap`` off and all features the forest is equal to Spark's node by node where Spark takes its thresholds from all rows (up to
10,000).  The random draws (sample for thresholds, rows of a tree, features of a node) come from generators of their own with the estimator's
seed: the forest is one that Spark's may have drawn.  On up to ``SPARK_ROWS`` rows, and for settings or columns not handled here, Spark's learner is used.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tablefit.operators
from tablefit.operators.models import persisted
from tablefit.session import scratch_path

# tasks get these functions with their code, whether or not the library is installed on the executors
cloudpickle.register_pickle_by_value(tablefit.operators)

#: Rows up to which Spark's learner is used.
SPARK_ROWS = 50_000
#: Rows of a tree, with their multiplicity, that one task grows on.
ROWS_AT_NODE = 1_500_000
#: Counts that are looked at together, for the processor's cache.
CELLS = 1 << 18

SUBSETS = {
    "all": lambda n: n, "sqrt": lambda n: int(np.ceil(np.sqrt(n))), "onethird": lambda n: int(np.ceil(n / 3.0)),
    "log2": lambda n: max(1, int(np.ceil(np.log(n) / np.log(2)))),
}
CHUNKS = "chunk long, n int, width int, rows binary"
HISTOGRAMS = "tree int, node long, counts binary"
SPLITS = "tree int, node long, n0 double, n1 double, gain double, feature int, at int, l0 double, l1 double"
DRAWN = "tree int, bucket int, n int, width int, rows binary"
NODES = "tree int, node long, n0 double, n1 double, gain double, feature int, at int"


class ForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` with the same parameters and models; one grown here knows the folder it is saved in (``saved_at``)."""

    def _fit(self, dataset: DataFrame):
        found = _plan(self, dataset)
        return super()._fit(dataset) if found is None else self._copyValues(_fitted(self, dataset, *found))


def forest_classifier(est: RandomForestClassifier) -> ForestClassifier:
    """A ``ForestClassifier`` with the parameters of the estimator."""
    return est._copyValues(ForestClassifier())


@dataclass(frozen=True)
class Plan:
    """What tasks need to know of a fit. Features are numbered with the continuous ones first: 0 .. len(continuous) - 1, then the 0/1 slots."""

    continuous: tuple[int, ...]
    binary: tuple[int, ...]
    thresholds: tuple[np.ndarray, ...]
    trees: int
    depth: int
    subset: int
    bootstrap: bool
    seed: int
    min_rows: float
    min_gain: float

    @property
    def size(self) -> int:
        return len(self.continuous) + len(self.binary)

    @property
    def bins(self) -> int:
        return max((len(t) + 1 for t in self.thresholds), default=1)

    @property
    def kind(self) -> type:
        return np.uint8 if max(self.bins, len(self.binary) + 1) <= 256 else np.uint16

    @property
    def features(self) -> np.ndarray:
        """Slots of the vector, by number."""
        return np.array(self.continuous + self.binary, dtype=np.int64)

    @property
    def cells(self) -> tuple[int, int]:
        """Counts of a node: of the continuous features, of the 0/1 slots."""
        return len(self.continuous) * 2 * self.bins, 2 * (len(self.binary) + 1)

    def draws(self, tree: int, chunk: int, n: int) -> np.ndarray:
        """How often each row of a chunk is in the tree's sample."""
        return np.random.default_rng([self.seed, tree, chunk]).poisson(1.0, n) if self.bootstrap else np.ones(n, dtype=np.int64)


def _plan(est: RandomForestClassifier, train: DataFrame) -> tuple[Plan, int] | None:
    """The fit's plan and number of rows, None where Spark's learner is to be used."""
    value = lambda name: est.getOrDefault(est.getParam(name))
    schema = train.schema
    if est.isDefined(est.weightCol) and value("weightCol"):
        return None
    if value("impurity").lower() != "gini" or value("subsamplingRate") != 1.0 or value("minWeightFractionPerNode") != 0.0 or not 1 <= value("maxDepth") <= 30:
        return None
    if not isinstance(schema[est.getFeaturesCol()].dataType, VectorUDT):
        return None
    about = schema[est.getFeaturesCol()].metadata.get("ml_attr", {})
    if about.get("attrs", {}).get("nominal") or not about.get("num_attrs"):
        return None
    size, label = about["num_attrs"], F.col(est.getLabelCol()).cast("double")
    found = train.agg(F.count(F.lit(1)).alias("n"), F.count_if(label == 0.0).alias("zeros"), F.count_if(label == 1.0).alias("ones")).head()
    if found["n"] <= SPARK_ROWS or found["zeros"] + found["ones"] < found["n"] or not found["ones"]:
        return None
    strategy = value("featureSubsetStrategy")
    strategy = ("sqrt" if value("numTrees") > 1 else "all") if strategy == "auto" else strategy
    if strategy not in SUBSETS:
        return None
    binary = tuple(sorted(a["idx"] for a in about.get("attrs", {}).get("binary", [])))
    continuous = tuple(i for i in range(size) if i not in set(binary))
    thresholds = _thresholds(train.select(est.getFeaturesCol()), continuous, size, found["n"], value("maxBins"), value("seed"))
    seed = value("seed") % (1 << 63)
    return Plan(continuous, binary, thresholds, value("numTrees"), value("maxDepth"), SUBSETS[strategy](size), value("bootstrap"), seed,
                float(value("minInstancesPerNode")), float(value("minInfoGain"))), found["n"]


# ------------------------------------------------------------------- binning

def _entries(vectors, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of what a column of vectors stores, dense ones in whole."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if vectors.null_count:
        raise ValueError("a features vector is null")
    kind, _, indices, values = vectors.flatten()
    lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    slot[np.repeat(kind.to_numpy(zero_copy_only=False) == 0, lengths)] = indices.flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    if not np.isfinite(value).all():
        raise ValueError("a features vector has NaN or infinity")
    if len(slot) and slot.max() >= size:
        raise ValueError(f"a features vector has more than {size} slots")
    return row, slot, value


def _thresholds(vectors: DataFrame, continuous: tuple[int, ...], size: int, n: int, max_bins: int, seed: int) -> tuple[np.ndarray, ...]:
    """Thresholds between bins of equal weight, by the rule of Spark's trees: from all rows, or a sample of 10,000 (the square of the bins if that is more)."""
    fraction = min(1.0, max(max_bins * max_bins, 10_000) / n)
    if not continuous:
        return ()
    # about 10,000 rows come to the driver
    _, slot, value = _entries((vectors.sample(fraction, seed) if fraction < 1 else vectors).toArrow().column(0), size)
    splits, expected = min(max_bins, n) - 1, fraction * n
    return tuple(_between(value[(slot == c) & (value != 0.0)], expected, splits) for c in continuous)


def _between(values: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """Thresholds of one feature from its values that are not zero; the others of the expected number of rows are."""
    if not len(values):
        return np.empty(0)
    at, count = np.unique(values, return_counts=True)
    count = count.astype(float)
    if expected - len(values) > np.finfo(float).eps * len(values) * 100:
        where = np.searchsorted(at, 0.0)
        at, count = np.insert(at, where, 0.0), np.insert(count, where, expected - len(values))
    middle = (at[:-1] + at[1:]) / 2.0
    if len(middle) <= splits:
        return middle
    stride, sums, out = expected / (splits + 1), np.cumsum(count), []
    target = stride
    for i in range(1, len(at)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _chunks(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Chunks of rows, feature by feature: label, bins of the continuous features, then the slots that are 1 (from 0, filled up with their number)."""
    number, wide = TaskContext.get().partitionId() << 32, np.full(plan.size, -1)
    wide[list(plan.continuous)] = np.arange(len(plan.continuous))
    narrow = np.full(plan.size, -1)
    narrow[list(plan.binary)] = np.arange(len(plan.binary))
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        row, slot, value = _entries(batch.column(0), plan.size)
        ones = (narrow[slot] >= 0) & (value != 0.0)
        if (value[ones] != 1.0).any():
            raise ValueError("a slot with a binary attribute has a value other than 0 and 1")
        numbers = np.zeros((len(plan.continuous), n))
        some = wide[slot] >= 0
        numbers[wide[slot[some]], row[some]] = value[some]
        each = np.bincount(row[ones], minlength=n)
        width = int(each.max())
        rows = np.full((1 + len(plan.continuous) + width, n), len(plan.binary), dtype=plan.kind)
        rows[0] = batch.column(1).to_numpy(zero_copy_only=False)
        for c, t in enumerate(plan.thresholds):
            rows[1 + c] = np.searchsorted(t, numbers[c])
        place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        rows[1 + len(plan.continuous) + place, row[ones]] = narrow[slot[ones]]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int64()), "n": pa.array([n], pa.int32()), "width": pa.array([width], pa.int32()),
                                          "rows": pa.array([rows.tobytes()], pa.binary())})
        number += 1


# -------------------------------------------------------------------- splits

def _unlike(a, b):
    """Gini impurity of counts of two classes."""
    n = a + b
    p, q = a / n, b / n
    return 1.0 - p * p - q * q


def _gains(left0, left1, right0, right1, impurity, plan: Plan) -> np.ndarray:
    """Spark's gain, in its order of operations; minus infinity for splits that it takes as invalid."""
    left, right = left0 + left1, right0 + right1
    n = left + right
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = impurity - left / n * _unlike(left0, left1) - right / n * _unlike(right0, right1)
        return np.where((left < plan.min_rows) | (right < plan.min_rows) | ~(gain >= plan.min_gain), -np.inf, gain)


def _counted(node: np.ndarray, nodes: int, label: np.ndarray, bins: np.ndarray, ones: np.ndarray, weight: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Weights by (node, feature, label, bin) and by (node, label, slot that is 1)."""
    (wide, narrow), slots = plan.cells, len(plan.binary) + 1
    at = node * 2 + label
    a = np.empty((nodes, len(plan.continuous), 2, plan.bins))
    for c in range(len(plan.continuous)):
        a[:, c] = np.bincount(at * plan.bins + bins[c], weights=weight, minlength=nodes * 2 * plan.bins).reshape(nodes, 2, plan.bins)
    b = np.zeros(nodes * narrow)
    at = at * slots
    for j in range(len(ones)):
        b += np.bincount(at + ones[j], weights=weight, minlength=nodes * narrow)
    return a, b.reshape(nodes, 2, slots)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _subset(tree: int, ids: np.ndarray, plan: Plan) -> np.ndarray | None:
    """Which features, by number, the nodes may split on: drawn anew for each node of a tree."""
    if plan.subset >= plan.size:
        return None
    golden = np.uint64(0x9E3779B97F4A7C15)
    start = _mixed(np.array([plan.seed], dtype=np.uint64) + golden * np.array([tree + 1], dtype=np.uint64))
    each = _mixed(start + golden * ids.astype(np.uint64))
    keys = _mixed(each[:, None] + golden * (plan.features.astype(np.uint64) + np.uint64(1)))
    return keys <= np.partition(keys, plan.subset - 1, axis=1)[:, plan.subset - 1 : plan.subset]


def _best(tree: int, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, a: np.ndarray, b: np.ndarray, plan: Plan) -> dict[str, np.ndarray]:
    """The best split of each node from its counts: gain (0 where there is none), feature by number, last bin or category that goes left, counts that go left."""
    n, wide, each = len(ids), len(plan.continuous), np.arange(len(ids))
    impurity = _unlike(zeros, ones)
    gain, at = np.full((n, plan.size), -np.inf), np.zeros((n, plan.size), dtype=np.int32)
    left0, left1 = np.zeros((n, plan.size)), np.zeros((n, plan.size))
    if wide and plan.bins > 1:
        sums = np.cumsum(a, axis=3)[..., :-1]
        l0, l1 = sums[:, :, 0], sums[:, :, 1]
        g = _gains(l0, l1, zeros[:, None, None] - l0, ones[:, None, None] - l1, impurity[:, None, None], plan)
        g[:, np.arange(plan.bins - 1) >= np.array([len(t) for t in plan.thresholds])[:, None]] = -np.inf
        best = g.argmax(axis=2)  # the first of equals
        take = lambda x: np.take_along_axis(x, best[..., None], axis=2)[..., 0]
        gain[:, :wide], at[:, :wide], left0[:, :wide], left1[:, :wide] = take(g), best, take(l0), take(l1)
    if plan.binary:
        one0, one1 = b[:, 0, :-1], b[:, 1, :-1]
        zero0, zero1 = zeros[:, None] - one0, ones[:, None] - one1
        turned = one1 < zero1  # the category with fewer of class 1 goes left
        l0, l1 = np.where(turned, one0, zero0), np.where(turned, one1, zero1)
        gain[:, wide:], at[:, wide:], left0[:, wide:], left1[:, wide:] = _gains(l0, l1, zeros[:, None] - l0, ones[:, None] - l1, impurity[:, None], plan), turned, l0, l1
    allowed = _subset(tree, ids, plan)
    if allowed is not None:
        gain[~allowed] = -np.inf
    order = np.argsort(plan.features)  # the first slot of equals
    best = order[gain[:, order].argmax(axis=1)]
    found = gain[each, best]
    return {"gain": np.where(found > 0, found, 0.0), "feature": best.astype(np.int32), "at": at[each, best], "l0": left0[each, best], "l1": left1[each, best]}


def _goes_right(feature: np.ndarray, at: np.ndarray, bins: np.ndarray, ones: np.ndarray, plan: Plan) -> np.ndarray:
    """For each row whether the split (of its own feature) sends it right."""
    wide, n = len(plan.continuous), len(feature)
    numeric = feature < wide
    has = np.zeros(n, dtype=bool)
    slot = np.maximum(feature - wide, 0).astype(plan.kind)
    for j in range(len(ones)):
        has |= ones[j] == slot
    out = has != (at == 1)
    if wide:
        out = np.where(numeric, bins[np.where(numeric, feature, 0), np.arange(n)] > at, out)
    return out


# -------------------------------------------------------------------- growth

@dataclass
class Top:
    """The upper part of a tree, grown on the whole cluster, as lists by position; a position's children are beside each other."""

    ids: list = field(default_factory=lambda: [1])
    counts: list = field(default_factory=lambda: [(0.0, 0.0)])
    gain: list = field(default_factory=lambda: [0.0])
    feature: list = field(default_factory=lambda: [-1])
    at: list = field(default_factory=lambda: [0])
    child: list = field(default_factory=lambda: [-1])
    open: dict = field(default_factory=lambda: {0: -1})  # position -> bucket, or -1 for nodes that all tasks count

    def split(self, position: int, found: dict, plan: Plan) -> None:
        self.counts[position] = n = (found["n0"], found["n1"])
        del self.open[position]
        if not found["gain"] > 0:
            return
        self.gain[position], self.feature[position], self.at[position], self.child[position] = found["gain"], found["feature"], found["at"], len(self.ids)
        left = (found["l0"], found["l1"])
        for id_, counts in ((2 * self.ids[position], left), (2 * self.ids[position] + 1, (n[0] - left[0], n[1] - left[1]))):
            if min(counts) > 0 and id_.bit_length() - 1 < plan.depth:
                self.open[len(self.ids)] = -1
            for values, value in ((self.ids, id_), (self.counts, counts), (self.gain, 0.0), (self.feature, -1), (self.at, 0), (self.child, -1)):
                values.append(value)

    def dealt(self) -> None:
        """The open nodes in buckets of up to ROWS_AT_NODE rows."""
        bucket = held = 0
        for position in self.open:
            n = sum(self.counts[position])
            if held and held + n > ROWS_AT_NODE:
                bucket, held = bucket + 1, 0
            self.open[position], held = bucket, held + n

    def route(self, bins: np.ndarray, ones: np.ndarray, n: int, plan: Plan) -> np.ndarray:
        """The position that each row comes to."""
        feature, at, child = (np.array(x) for x in (self.feature, self.at, self.child))
        position = np.zeros(n, dtype=np.int64)
        while True:
            inner = np.flatnonzero(child[position] >= 0)
            if not len(inner):
                return position
            p = position[inner]
            position[inner] = child[p] + _goes_right(feature[p], at[p], bins[:, inner], ones[:, inner], plan)


def _drawn(batches: Iterator[pa.RecordBatch], plan: Plan, tops: list[Top]):
    """(tree, its top, position, rows of the chunk, multiplicity) of the rows drawn for each tree that has open nodes, chunk by chunk."""
    wide = len(plan.continuous)
    for batch in batches:
        for record in batch.to_pylist():
            rows = np.frombuffer(record["rows"], dtype=plan.kind).reshape(-1, record["n"])
            for tree, top in enumerate(tops):
                if not top.open:
                    continue
                weight = plan.draws(tree, record["chunk"], record["n"])
                kept = np.flatnonzero(weight)
                some = rows[:, kept]
                position = top.route(some[1 : 1 + wide], some[1 + wide :], len(kept), plan)
                yield tree, top, position, some, weight[kept]


def _histograms(batches: Iterator[pa.RecordBatch], plan: Plan, tops: list[Top]) -> Iterator[pa.RecordBatch]:
    """The counts of all open nodes over the rows of a part."""
    wide, sums, order = len(plan.continuous), {}, [list(t.open) for t in tops]
    for tree, top, position, some, weight in _drawn(batches, plan, tops):
        number = np.full(len(top.ids), -1)
        number[order[tree]] = np.arange(len(order[tree]))
        node = number[position]
        kept = np.flatnonzero(node >= 0)
        some, weight, node = some[:, kept], weight[kept], node[kept]
        a, b = _counted(node, len(order[tree]), some[0], some[1 : 1 + wide], some[1 + wide :], weight, plan)
        both = np.bincount(node * 2 + some[0], weights=weight, minlength=2 * len(order[tree])).reshape(-1, 2)
        found = np.hstack([both, a.reshape(len(a), -1), b.reshape(len(b), -1)])
        sums[tree] = sums[tree] + found if tree in sums else found
    for tree, found in sums.items():
        yield pa.RecordBatch.from_pydict({"tree": pa.array([tree] * len(found), pa.int32()), "node": pa.array([tops[tree].ids[p] for p in order[tree]], pa.int64()),
                                          "counts": pa.array([x.tobytes() for x in found], pa.binary())})


def _split(table: pa.Table, plan: Plan) -> pa.Table:
    """The best split of one node from the counts of all parts."""
    counts = sum(np.frombuffer(x, dtype=float) for x in table.column("counts").to_pylist())
    tree, node, (wide, _) = table.column("tree")[0].as_py(), table.column("node")[0].as_py(), plan.cells
    zeros, ones, a, b = counts[:1], counts[1:2], counts[2 : 2 + wide].reshape(1, -1, 2, plan.bins), counts[2 + wide :].reshape(1, 2, -1)
    found = _best(tree, np.array([node]), zeros, ones, a, b, plan)
    return pa.table({"tree": pa.array([tree], pa.int32()), "node": [node], "n0": zeros, "n1": ones, **{c: found[c] for c in ("gain", "feature", "at", "l0", "l1")}})


def _sent(batches: Iterator[pa.RecordBatch], plan: Plan, tops: list[Top]) -> Iterator[pa.RecordBatch]:
    """The drawn rows of open nodes by bucket: position (four bytes each), multiplicity, label, bins, slots."""
    for tree, top, position, some, weight in _drawn(batches, plan, tops):
        bucket = np.full(len(top.ids), -1)
        bucket[list(top.open)] = list(top.open.values())
        to = bucket[position]
        for k in sorted(set(top.open.values())):
            kept = np.flatnonzero(to == k)
            if len(kept):
                text = position[kept].astype(np.int32).tobytes() + weight[kept].astype(np.uint8).tobytes() + some[:, kept].tobytes()
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([tree], pa.int32()), "bucket": pa.array([k], pa.int32()), "n": pa.array([len(kept)], pa.int32()),
                    "width": pa.array([len(some)], pa.int32()), "rows": pa.array([text], pa.binary())})


def _below(table: pa.Table, plan: Plan, tops: list[Top]) -> pa.Table:
    """All nodes of one bucket and what grows below them."""
    tree, wide = table.column("tree")[0].as_py(), len(plan.continuous)
    sizes, widths = table.column("n").to_numpy(), table.column("width").to_numpy()
    n, kind = int(sizes.sum()), np.dtype(plan.kind)
    position, weight = np.empty(n, dtype=np.int32), np.empty(n)
    rows = np.full((int(widths.max()), n), len(plan.binary), dtype=kind)
    start = 0
    for i, (k, width) in enumerate(zip(sizes.tolist(), widths.tolist(), strict=True)):
        text, part = table.column("rows")[i].as_buffer(), slice(start, start + k)
        position[part] = np.frombuffer(text, np.int32, k)
        weight[part] = np.frombuffer(text, np.uint8, k, 4 * k)
        rows[:width, part] = np.frombuffer(text, kind, width * k, 5 * k).reshape(width, k)
        start += k
    there = np.bincount(position) > 0
    ids = np.array(tops[tree].ids, dtype=np.int64)[np.flatnonzero(there)]
    node = (np.cumsum(there) - 1)[position]
    if len(ids) > 1:
        order = np.argsort(node, kind="stable")
        node, rows, weight = node[order], rows[:, order], weight[order]
    return _grown(tree, ids, node, rows[0], rows[1 : 1 + wide], rows[1 + wide :], weight, plan)


def _grown(tree: int, ids: np.ndarray, node: np.ndarray, label: np.ndarray, bins: np.ndarray, ones: np.ndarray, weight: np.ndarray, plan: Plan) -> pa.Table:
    """The trees below the nodes; rows come sorted by node, and are kept so, level by level."""
    out, block = [], max(1, CELLS // sum(plan.cells))

    def add(ids, both, gain=None, feature=None, at=None):
        none = np.full(len(ids), -1, dtype=np.int32)
        out.append(pa.table({"tree": pa.array(np.full(len(ids), tree, dtype=np.int32)), "node": ids, "n0": both[:, 0], "n1": both[:, 1],
                             "gain": np.zeros(len(ids)) if gain is None else gain, "feature": none if feature is None else feature,
                             "at": none if at is None else at.astype(np.int32)}))

    while len(ids):
        total = np.bincount(node * 2 + label, weights=weight, minlength=2 * len(ids)).reshape(-1, 2)
        ends, parts = np.searchsorted(node, np.arange(len(ids) + 1)), []
        for a in range(0, len(ids), block):
            b = min(a + block, len(ids))
            r = slice(ends[a], ends[b])
            counts = _counted(node[r] - a, b - a, label[r], bins[:, r], ones[:, r], weight[r], plan)
            parts.append(_best(tree, ids[a:b], total[a:b, 0], total[a:b, 1], *counts, plan))
        found = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        inner = found["gain"] > 0
        add(ids, total, found["gain"], np.where(inner, found["feature"], -1).astype(np.int32), found["at"])

        both = np.stack([np.stack([found["l0"], found["l1"]], axis=1)] * 2, axis=1)  # (node, side, label)
        both[:, 1] = total - both[:, 0]
        kids = np.stack([2 * ids, 2 * ids + 1], axis=1)
        level = np.frexp(kids.astype(float))[1] - 1
        grows = inner[:, None] & (both.min(axis=2) > 0) & (level < plan.depth)
        ended = inner[:, None] & ~grows
        add(kids[ended], both[ended])

        number = np.where(grows, np.cumsum(grows.ravel()).reshape(grows.shape) - 1, -1)
        right = _goes_right(found["feature"][node], found["at"][node], bins, ones, plan)
        to = number[node, right.astype(np.int64)]
        sides = [np.flatnonzero((to >= 0) & side) for side in (~right, right)]
        starts = np.concatenate([[0], np.cumsum(np.bincount(to[to >= 0], minlength=int(grows.sum())))])
        order = np.empty(starts[-1], dtype=np.int64)
        for rows in sides:  # sorted by child already
            child = to[rows]
            first = np.searchsorted(child, child) if len(child) < 64 else np.repeat(*_runs(child))
            order[starts[child] + np.arange(len(child)) - first] = rows
        node, label, weight = to[order], label[order], weight[order]
        bins, ones, ids = bins[:, order], ones[:, order], kids[grows]
    return pa.concat_tables(out)


def _runs(child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and how long they are."""
    starts = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]]))
    return starts, np.diff(np.append(starts, len(child)))


# --------------------------------------------------------------------- model

def _saved(table: pa.Table, plan: Plan, schema: pa.Schema) -> pa.Table:
    """The nodes of one tree as Spark saves them: numbered in preorder, leaves of one parent that predict the same merged."""
    table = table.sort_by("node")
    tree, ids, n0, n1, gain, number, at = (table.column(c).to_numpy() for c in ("tree", "node", "n0", "n1", "gain", "feature", "at"))
    n, leaf, predicts = len(ids), number < 0, (n1 > n0).astype(float)
    left = np.minimum(np.searchsorted(ids, 2 * ids), n - 1)
    right = np.minimum(np.searchsorted(ids, 2 * ids + 1), n - 1)
    level = np.frexp(ids.astype(float))[1] - 1
    size = np.ones(n, dtype=np.int64)
    for k in range(int(level.max()) - 1, -1, -1):
        x = np.flatnonzero((level == k) & ~leaf)
        a, b = left[x], right[x]
        leaf[x] = leaf[a] & leaf[b] & (predicts[a] == predicts[b])
        size[x] = np.where(leaf[x], 1, 1 + size[a] + size[b])
    kept, place = ids == 1, np.zeros(n, dtype=np.int64)
    for k in range(int(level.max())):
        x = np.flatnonzero((level == k) & kept & ~leaf)
        kept[left[x]] = kept[right[x]] = True
        place[left[x]] = place[x] + 1
        place[right[x]] = place[x] + 1 + size[left[x]]
    x = np.flatnonzero(kept)
    x = x[np.argsort(place[x])]
    split = []
    for f, cut in zip(np.where(leaf, -1, number)[x].tolist(), at[x].tolist(), strict=True):
        numeric = f < len(plan.continuous)
        split.append({"featureIndex": -1 if f < 0 else int(plan.features[f]), "numCategories": -1 if numeric else 2,
                      "leftCategoriesOrThreshold": [] if f < 0 else [float(plan.thresholds[f][cut] if numeric else cut)]})
    new = {
        "id": place[x], "prediction": predicts[x], "impurity": _unlike(n0, n1)[x], "impurityStats": list(map(list, zip(n0[x].tolist(), n1[x].tolist(), strict=True))),
        "rawCount": (n0 + n1)[x].astype(np.int64), "gain": np.where(leaf, -1.0, gain)[x], "leftChild": np.where(leaf, -1, place[left])[x],
        "rightChild": np.where(leaf, -1, place[right])[x], "split": split, "treeID": tree[x]}
    return pa.Table.from_arrays([pa.array(new[f.name], f.type) for f in schema], schema=schema)


def _fitted(est: ForestClassifier, train: DataFrame, plan: Plan, n: int) -> RandomForestClassificationModel:
    spark = train.sparkSession
    features, label = F.col(est.getFeaturesCol()).alias("features"), F.col(est.getLabelCol()).cast("double").alias("label")
    with persisted(train.select(features, label).mapInArrow(lambda b: _chunks(b, plan), CHUNKS)) as chunks:
        tops = [Top() for _ in range(plan.trees)]
        while n > ROWS_AT_NODE:
            large = [_only_large(top) for top in tops]
            if not any(t.open for t in large):
                break
            counts = chunks.mapInArrow(lambda b, t=large: _histograms(b, plan, t), HISTOGRAMS)
            found = counts.groupBy("tree", "node").applyInArrow(lambda t: _split(t, plan), SPLITS).collect()  # a row for each large node
            for row in found:
                top = tops[row["tree"]]
                top.split(top.ids.index(row["node"]), row.asDict(), plan)
        for top in tops:
            top.dealt()
        groups = sum(len(set(t.open.values())) for t in tops)
        sent = chunks.mapInArrow(lambda b: _sent(b, plan, tops), DRAWN).repartition(max(1, 3 * groups), "tree", "bucket")
        below = sent.groupBy("tree", "bucket").applyInArrow(lambda t: _below(t, plan, tops), NODES)
        path = _written(est, plan, below, tops, spark)
    model = RandomForestClassificationModel.load(path)
    model.saved_at = path
    return model


def _only_large(top: Top) -> Top:
    """The part of the open nodes that have more than ROWS_AT_NODE rows, or are not counted yet."""
    large = {p: -1 for p in top.open if not sum(top.counts[p]) or sum(top.counts[p]) > ROWS_AT_NODE}
    return Top(top.ids, top.counts, top.gain, top.feature, top.at, top.child, large)


def _written(est: ForestClassifier, plan: Plan, below: DataFrame, tops: list[Top], spark) -> str:
    """The forest in the form of a saved model; what surrounds the nodes is that of a fit of two rows."""
    two = spark.createDataFrame([(Vectors.sparse(plan.size, {}), y) for y in (0.0, 1.0)], [est.getFeaturesCol(), est.getLabelCol()])
    like, path = scratch_path(spark, "forest-frame"), scratch_path(spark, "forest")
    RandomForestClassifier._fit(est, two).save(like)
    rows = [(t, top.ids[p], *map(float, top.counts[p]), float(top.gain[p]), int(top.feature[p]), int(top.at[p]))
            for t, top in enumerate(tops) for p in range(len(top.ids)) if p not in top.open]
    nodes = below.unionByName(spark.createDataFrame(rows, NODES)) if rows else below
    flat = spark.read.parquet(os.path.join(like, "data")).select("treeID", "nodeData.*")
    schema = flat.limit(0).toArrow().schema
    whole = nodes.groupBy("tree").applyInArrow(lambda t: _saved(t, plan, schema), flat.schema)  # a group is one tree
    whole.select("treeID", F.struct(*flat.columns[1:]).alias("nodeData")).write.parquet(os.path.join(path, "data"))
    spark.read.parquet(os.path.join(like, "treesMetadata")).write.parquet(os.path.join(path, "treesMetadata"))
    spark.read.text(os.path.join(like, "metadata")).coalesce(1).write.text(os.path.join(path, "metadata"))
    return path
