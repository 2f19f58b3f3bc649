"""Trees of several depths, and forests of several sizes, from one fit.

A tree is grown level by level, and no split depends on how deep the tree may become: the tree of a smaller ``maxDepth`` is the deep one cut at
that level, its cut nodes leaves with the statistics that they had as inner nodes, and leaves of one parent that predict the same merged, as Spark merges
them.  So a grid over ``maxDepth`` needs one fit, of its greatest depth.  The same holds for the trees of a forest; with random subsets of features,
each cut tree is one that the smaller depth may have drawn.  Boosted trees learn from the trees before them, and are not cut.

The trees of a forest are drawn and grown independently of each other.  So the first n trees of a larger forest are a forest of n trees, one that a
fit with ``numTrees`` = n may have drawn, and a grid over ``numTrees`` needs one fit, of the most trees.  A single tree is left out of this: Spark's
``auto`` gives it other subsets of features than the trees of a forest.

Models are cut in the form Spark saves them in, each tree by itself, and loaded again.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablefit.operators
from tablefit.session import scratch_path

# tasks get these functions with their code, whether or not the library is installed on the executors
cloudpickle.register_pickle_by_value(tablefit.operators)

LEARNERS = (DecisionTreeClassifier, DecisionTreeRegressor, RandomForestClassifier, RandomForestRegressor)
FOREST_LEARNERS = (RandomForestClassifier, RandomForestRegressor)
TREES = (DecisionTreeClassificationModel, DecisionTreeRegressionModel)
FORESTS = (RandomForestClassificationModel, RandomForestRegressionModel)


def by_depth(est, maps: Sequence[dict], points: Sequence[int]) -> list[list[int]]:
    """The points that one fit serves, the deepest (of these the largest forest) first in each list; lists of one for estimators that are not cut."""
    if not isinstance(est, LEARNERS):
        return [[i] for i in points]
    groups: dict[tuple, list[int]] = {}
    for i in points:
        rest = sorted((p.name, repr(v)) for p, v in maps[i].items() if p.name not in ("maxDepth", "numTrees"))
        groups.setdefault((_shape(est, maps[i])[1] == 1, *rest), []).append(i)
    return [sorted(g, key=lambda i: _shape(est, maps[i]), reverse=True) for g in groups.values()]


def _shape(est, point: dict) -> tuple[int, int]:
    """(depth, trees) of a point."""
    return tuple(int(point.get(p, est.getOrDefault(p))) if p else 1 for p in (est.maxDepth, getattr(est, "numTrees", None)))


def fitted_by_depth(est, maps: Sequence[dict], points: Sequence[int], train: DataFrame) -> dict[int, Callable]:
    """The deepest and largest model of one list of ``by_depth``, fitted; for each point a function that gives its model."""
    spark, shapes = train.sparkSession, {i: _shape(est, maps[i]) if len(points) > 1 else None for i in points}
    most, fit = None, maps[points[0]]
    if len(points) > 1:
        most = tuple(map(max, zip(*shapes.values(), strict=True)))
        fit = fit | {est.maxDepth: most[0]} | ({est.numTrees: most[1]} if isinstance(est, FOREST_LEARNERS) else {})
    model = est.fit(train, fit)
    kind, saved = type(model), getattr(model, "saved_at", None)
    whole = partial(kind.load, saved) if saved else lambda: model  # what is saved is not kept on the driver
    if not saved and any(x != most for x in shapes.values()):
        saved = scratch_path(spark, "tree")
        model.save(saved)
    return {i: partial(cut_saved, spark, saved, kind, *shapes[i]) if shapes[i] != most else whole for i in points}


def cut(model, depth: int, trees: int | None = None):
    """The model, a tree or a forest of trees, as it would be with ``maxDepth`` = depth; of a forest the first so many trees, all by default."""
    spark = SparkSession.active()
    path = scratch_path(spark, "tree")
    model.save(path)
    return cut_saved(spark, path, type(model), depth, trees)


def cut_saved(spark, path: str, kind: type, depth: int, trees: int | None = None):
    if kind not in TREES + FORESTS:
        raise TypeError(f"{kind.__name__} is not cut by depth")
    to = scratch_path(spark, f"tree-{depth}")
    about = json.loads(spark.read.text(os.path.join(path, "metadata")).head()[0])
    about["paramMap"]["maxDepth"] = depth
    nodes = spark.read.parquet(os.path.join(path, "data"))
    if kind in FORESTS:
        each = spark.read.parquet(os.path.join(path, "treesMetadata"))
        if trees is not None:
            if not 1 <= trees <= about["numTrees"]:
                raise ValueError(f"{trees} trees of a forest of {about['numTrees']}")
            about["numTrees"] = about["paramMap"]["numTrees"] = trees
            nodes, each = (x.where(F.col(i) < trees) for x, i in ((nodes, "treeID"), (each, each.columns[0])))
    flat = nodes.select("treeID", "nodeData.*") if kind in FORESTS else nodes.withColumn("treeID", F.lit(0))
    columns = [c for c in flat.columns if c != "treeID"]
    short = flat.groupBy("treeID").applyInArrow(lambda t: _cut_nodes(t, depth), flat.schema)  # a group is one tree
    short = short.select("treeID", F.struct(*columns).alias("nodeData")) if kind in FORESTS else short.select(*columns)
    short.write.parquet(os.path.join(to, "data"))
    if kind in FORESTS:
        each.write.parquet(os.path.join(to, "treesMetadata"))
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(os.path.join(to, "metadata"))
    return kind.load(to)


def _cut_nodes(table: pa.Table, depth: int) -> pa.Table:
    """The nodes of one tree down to a depth, numbered anew; they come with ids in preorder, a parent's before its children's."""
    table = table.sort_by("id")
    left, right = (table.column(c).to_numpy() for c in ("leftChild", "rightChild"))
    prediction = table.column("prediction").to_numpy().copy()
    n = len(left)
    level = np.zeros(n, dtype=np.int64)
    for i in range(n):
        if left[i] >= 0:
            level[left[i]] = level[right[i]] = level[i] + 1
    leaf = (left < 0) | (level >= depth)
    for i in range(n - 1, -1, -1):
        if not leaf[i] and leaf[left[i]] and leaf[right[i]] and prediction[left[i]] == prediction[right[i]]:
            leaf[i], prediction[i] = True, prediction[left[i]]
    kept = np.zeros(n, dtype=bool)
    kept[0] = True
    for i in range(n):
        if kept[i] and not leaf[i]:
            kept[left[i]] = kept[right[i]] = True
    number = np.cumsum(kept) - 1
    now_leaf = leaf & (left >= 0)
    split = table.column("split").to_pylist()
    none = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
    new = {
        "id": number, "prediction": prediction, "gain": np.where(now_leaf, -1.0, table.column("gain").to_numpy()),
        "leftChild": np.where(leaf, -1, number[left]), "rightChild": np.where(leaf, -1, number[right]),
        "split": [none if cut else s for s, cut in zip(split, now_leaf, strict=True)],
    }
    out = pa.Table.from_arrays([pa.array(new[f.name], f.type) if f.name in new else table.column(f.name) for f in table.schema], schema=table.schema)
    return out.filter(pa.array(kept))
