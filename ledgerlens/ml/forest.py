"""Forests grown a tree in a task (M1, M2): for training tables whose binned rows fit in a worker.

Spark ML grows the trees of a fit together, level by level: every pass shuffles a histogram of every open
node from every partition and keeps all nodes on the driver.  Deep trees have many nodes of few rows, so
most of that is empty bins, and a forest too large for the driver takes many fits.  Here the rows are
binned once, a byte for each feature (``binned``), each task gets all of them and grows whole trees of
its own (``grow_trees``): nodes go straight from the workers to the shared folder.

The trees follow Spark ML's rules: thresholds between values at equal shares of the rows (``thresholds``,
here of all rows), a Poisson sample of the rows with replacement for each tree, a fresh set of features for each
node, the split of largest gain, the first of equal ones, and no split whose leaves predict the same.
What a tree draws depends on the seed and its number alone, not on the tasks.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.files import stage_handoff

#: Rows of one block.
BLOCK_ROWS = 4096
#: Nodes whose histograms a worker makes at once.
NODES_AT_ONCE = 4096
#: Nodes of one row of ``grow_trees``.
NODES_A_ROW = 65536
#: Groups of trees that a scoring task holds at most.
GROUPS_A_TASK = 4
#: Counts of rows lie below it, counts of rows with label 1 are multiples of it: one sum for both.
ONE = float(1 << 26)


# ---- thresholds and bins
def cuts(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between distinct sorted ``values``: all midpoints, or those next to equal shares of the rows."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    seen = np.cumsum(counts, dtype=np.float64)
    share, pairs = seen[-1] / (most + 1), seen[:-1] + seen[1:]
    out, at, target = [], 0, share
    while (at := max(at, int(np.searchsorted(pairs, 2 * target, side="right")))) < len(middle):
        out.append(middle[at])
        at, target = at + 1, target + share
    return np.array(out[:most])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(place, weights=np.concatenate([c for _, c in parts]))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def thresholds(data: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """The thresholds of every feature, from the distinct values of all rows."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for f, column in enumerate(_matrix(batch).T):
                own = held.setdefault(f, [])
                own.append(np.unique(column, return_counts=True))
                if len(own) > 16:
                    held[f] = [_merged(own)]
        for f, own in held.items():
            values, counts = _merged(own)
            yield pa.record_batch([pa.array([f], pa.int32()), pa.array([values.tobytes()]), pa.array([counts.tobytes()])],
                                  names=["feature", "vals", "counts"])

    def found(table: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(v), np.frombuffer(c)) for v, c in zip(table.column("vals").to_pylist(), table.column("counts").to_pylist())]
        return pa.table({"feature": table.column("feature")[:1], "cuts": pa.array([cuts(*_merged(parts), bins - 1).tolist()], pa.list_(pa.float64()))})

    values = data.select(vector_to_array(features).alias("x")).mapInArrow(distinct, "feature int, vals binary, counts binary")
    rows = values.groupBy("feature").applyInArrow(found, "feature int, cuts array<double>").collect()  # one row a feature
    return [np.array(r["cuts"]) for r in sorted(rows, key=lambda r: r["feature"])]


def binned(data: DataFrame, label: str, features: str, at: list[np.ndarray]) -> DataFrame:
    """Blocks (part, no, x, y) of the rows of ``data`` in their order: a byte for each bin and label."""
    rows = data.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(k, BLOCK_ROWS)
                x = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(at, _matrix(own).T)]).astype(np.uint8)
                y = own.column("y").to_numpy().astype(np.uint8)
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([no], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])],
                                      names=["part", "no", "x", "y"])
                no += 1

    return rows.mapInArrow(work, "part int, no int, x binary, y binary")


# ---- one tree
def impurity(count: np.ndarray, ones: np.ndarray, gini: bool) -> np.ndarray:
    if gini:
        zero, one = (count - ones) / count, ones / count
        return 1.0 - zero * zero - one * one
    return (ones - ones * ones / count) / count


def _best_splits(flat, n_rows, rows, packed, starts, count, ones, picked, bins, least, gini):
    """For every open node its best (feature, bin of the last left rows, gain, rows left, ones left); gain -inf without any."""
    n = len(count)
    best = (np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -np.inf), np.zeros(n), np.zeros(n))
    for a in range(0, n, NODES_AT_ONCE):
        b = min(a + NODES_AT_ONCE, n)
        own, at = rows[starts[a]:starts[b]], np.repeat(np.arange(b - a), np.diff(starts[a:b + 1]))
        weights, key = packed[own], at * bins
        total, right_1, line = count[a:b, None], ones[a:b, None], np.arange(b - a)
        whole = impurity(total, right_1, gini)
        for j in range(picked.shape[1]):
            f = picked[a:b, j]
            sums = np.bincount(key + flat[(f * n_rows)[at] + own], weights=weights, minlength=(b - a) * bins).reshape(b - a, bins)
            sums = sums[:, :-1].cumsum(axis=1)
            l1 = np.floor(sums / ONE)
            left = sums - l1 * ONE
            right, r1 = total - left, right_1 - l1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = whole - left / total * impurity(left, l1, gini) - right / total * impurity(right, r1, gini)
            gain[(left < least) | (right < least)] = -np.inf
            cut = gain.argmax(axis=1)
            gain = gain[line, cut]
            better = np.flatnonzero(gain > best[2][a:b])
            for to, value in zip(best, (f, cut, gain, left[line, cut], l1[line, cut])):
                to[a + better] = value[better]
    return best


def grow_tree(x: np.ndarray, y: np.ndarray, weight: np.ndarray, pick: Callable[[int], np.ndarray], at: list[np.ndarray],
              bins: int, depth: int, least: int, gini: bool) -> dict[str, np.ndarray]:
    """A tree on the binned rows ``x`` (features by rows) and 0/1 labels, each row ``weight`` times; ``pick(n)``
    gives the features that each of ``n`` nodes tries.  Its nodes in preorder, as Spark ML stores them."""
    n_rows, flat = x.shape[1], x.reshape(-1)
    rows = np.flatnonzero(weight)
    packed = weight * (1 + y * ONE)
    all_ = packed.sum()
    count, ones = np.array([all_ % ONE]), np.array([all_ // ONE])
    starts, levels = np.array([0, len(rows)]), []
    while True:
        n = len(count)
        level = {"count": count, "ones": ones, "feature": np.full(n, -1), "cut": np.zeros(n, np.int64), "gain": np.full(n, -1.0), "left": np.full(n, -1)}
        levels.append(level)
        opened = np.flatnonzero(impurity(count, ones, gini) != 0) if len(levels) <= depth and all_ else np.zeros(0, int)
        if not len(opened):
            break
        # the rows of the nodes that are still open, node by node
        if len(opened) < n:
            still = np.zeros(n, bool)
            still[opened] = True
            sizes = np.diff(starts)
            rows, sizes = rows[np.repeat(still, sizes)], sizes[opened]
            starts = np.concatenate(([0], np.cumsum(sizes)))
        feature, cut, gain, left, left_1 = _best_splits(flat, n_rows, rows, packed, starts, count[opened], ones[opened], pick(len(opened)), bins, least, gini)
        good = np.flatnonzero(gain > 0)
        if not len(good):
            break
        to = opened[good]
        level["feature"][to], level["cut"][to], level["gain"][to], level["left"][to] = feature[good], cut[good], gain[good], 2 * np.arange(len(to))
        sizes = np.diff(starts)
        if len(good) < len(opened):
            rows = rows[np.repeat(gain > 0, sizes)]
            sizes, feature, cut, left, left_1 = sizes[good], feature[good], cut[good], left[good], left_1[good]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        # each node's rows: those that go left, then the others, each in their order
        node = np.repeat(np.arange(len(to)), sizes)
        goes = flat[(feature * n_rows)[node] + rows] <= cut[node]
        before = np.concatenate(([0], np.cumsum(goes)))
        base = before[starts[:-1]]
        n_left = before[starts[1:]] - base
        lefts = before[:-1] - base[node]
        place = np.where(goes, starts[:-1][node] + lefts, np.arange(len(rows)) + n_left[node] - lefts)
        moved = np.empty_like(rows)
        moved[place] = rows
        rows = moved
        starts = np.concatenate(([0], np.cumsum(np.stack((n_left, sizes - n_left), axis=1).ravel())))
        count, ones = (np.stack((l, t[to] - l), axis=1).ravel() for l, t in ((left, count), (left_1, ones)))
    return _in_preorder(levels, at, gini)


def _in_preorder(levels: list[dict], at: list[np.ndarray], gini: bool) -> dict[str, np.ndarray]:
    below = None
    for level in reversed(levels):
        count, ones = level["count"], level["ones"]
        with np.errstate(invalid="ignore"):
            level["prediction"] = (2 * ones > count).astype(float) if gini else ones / count
        level["size"] = np.ones(len(count), np.int64)
        inner = np.flatnonzero(level["feature"] >= 0)
        if len(inner):
            a = level["left"][inner]
            leaf = below["feature"] < 0
            same = leaf[a] & leaf[a + 1] & (below["prediction"][a] == below["prediction"][a + 1])
            gone = inner[same]
            level["feature"][gone], level["gain"][gone] = -1, -1.0
            inner, a = inner[~same], a[~same]
            level["size"][inner] = 1 + below["size"][a] + below["size"][a + 1]
        below = level
    number, parts = np.zeros(1, np.int64), []
    for k, level in enumerate(levels):
        level["id"], level["l"], level["r"] = number, np.full(len(number), -1), np.full(len(number), -1)
        inner = np.flatnonzero((level["feature"] >= 0) & (number >= 0))
        parts.append(number >= 0)
        if k + 1 < len(levels):
            a, number = level["left"][inner], np.full(len(levels[k + 1]["count"]), -1)
            level["l"][inner] = number[a] = level["id"][inner] + 1
            level["r"][inner] = number[a + 1] = level["id"][inner] + 1 + levels[k + 1]["size"][a]
    whole = {c: np.concatenate([level[c][own] for level, own in zip(levels, parts)]) for c in ("id", "l", "r", "feature", "cut", "gain", "count", "ones", "prediction")}
    order = np.argsort(whole.pop("id"))
    tree = {c: v[order] for c, v in whole.items()}
    width = max((len(c) for c in at), default=0)
    table = np.array([np.append(c, np.full(width - len(c), np.nan)) for c in at]).reshape(len(at), width)
    inner = tree["feature"] >= 0
    tree["threshold"] = np.zeros(len(order))
    tree["threshold"][inner] = table[tree["feature"][inner], tree.pop("cut")[inner]]
    return tree


def importances(tree: dict[str, np.ndarray], n_features: int) -> np.ndarray:
    """Each feature's share of the tree's gains, weighted by their rows; zeros for a tree without a split."""
    inner = tree["feature"] >= 0
    sums = np.bincount(tree["feature"][inner], weights=(tree["gain"] * tree["count"])[inner], minlength=n_features)
    return sums / sums.sum() if sums.sum() else sums


def digest(tree: dict[str, np.ndarray]) -> str:
    out = hashlib.md5()
    for c in ("l", "r", "feature", "threshold", "prediction"):
        out.update(np.ascontiguousarray(tree[c]).tobytes())
    return out.hexdigest()


# ---- the forest
FACTS = "tree int, digest string, n_nodes bigint, importances array<double>"
NODES = {"id": "int", "l": "int", "r": "int", "feature": "int", "threshold": "double", "prediction": "double", "gain": "double",
         "count": "double", "ones": "double"}


def grow_trees(data: DataFrame, label: str, features: str, *, trees: int, tried: int, bins: int, depth: int, least: int, gini: bool,
               seed: int, nodes: bool = False) -> DataFrame:
    """``trees`` trees on ``data``: rows (tree, digest, n_nodes, importances), written; with ``nodes`` as many rows a
    tree as it has stretches of NODES_A_ROW nodes, which these rows hold."""
    spark = data.sparkSession
    at = thresholds(data, features, bins)
    blocks = stage_handoff(binned(data, label, features, at), "binned")
    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)  # neighbouring trees in a task
    width = len(at)
    schema = FACTS + "".join(f", {c} array<{kind}>" for c, kind in NODES.items()) if nodes else FACTS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys, task = [], [], None
        for batch in batches:
            for t, x, y in zip(batch.column("task"), batch.column("x"), batch.column("y")):
                task = t.as_py()
                xs.append(np.frombuffer(x.as_buffer(), np.uint8).reshape(width, -1).copy())
                ys.append(np.frombuffer(y.as_buffer(), np.uint8).copy())
        if task is None:
            return
        y = np.concatenate(ys)
        x, k = np.empty((width, len(y)), np.uint8), 0
        xs.reverse()
        while xs:  # each block is let go of once it is in its place
            part = xs.pop()
            x[:, k:k + part.shape[1]] = part
            k += part.shape[1]
        for tree in range(-(-task * trees // tasks), -(-(task + 1) * trees // tasks)):
            rng = np.random.Generator(np.random.PCG64([seed & (2 ** 64 - 1), tree]))
            pick = lambda n: np.sort(np.argpartition(rng.random((n, width)), min(tried, width) - 1, axis=1)[:, :tried], axis=1)
            weight = rng.poisson(1.0, len(y))
            grown = grow_tree(x, y, weight, pick, at, bins, depth, least, gini)
            n = len(grown["l"])
            facts = [pa.array([tree], pa.int32()), pa.array([digest(grown)]), pa.array([n], pa.int64()), pa.array([importances(grown, width).tolist()], pa.list_(pa.float64()))]
            if not nodes:
                yield pa.record_batch(facts, names=["tree", "digest", "n_nodes", "importances"])
                continue
            grown["id"] = np.arange(n)
            for k in range(0, n, NODES_A_ROW):
                end = min(n, k + NODES_A_ROW)
                lists = [pa.ListArray.from_arrays(pa.array([0, end - k], pa.int32()), pa.array(grown[c][k:end], pa.int32() if kind == "int" else pa.float64()))
                         for c, kind in NODES.items()]
                yield pa.record_batch([*facts, *lists], names=["tree", "digest", "n_nodes", "importances", *NODES])

    copies = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).select("task", "part", "no", "x", "y")
    dealt = copies.repartitionById(tasks, F.col("task")).sortWithinPartitions("part", "no").select("task", "x", "y")
    return stage_handoff(dealt.mapInArrow(work, schema), "trees")


def write_models(trees: DataFrame, groups: list[int], learner, n_features: int, path: str) -> None:
    """Store the nodes of ``grow_trees`` as Spark ML regression forests, one for each of ``groups`` at ``path``/0, ..."""
    spark = trees.sparkSession
    size = groups[0]  # all but the last are of one size
    zipped = trees.select("tree", F.inline(F.arrays_zip(*NODES)))
    leaf, p = F.col("feature") < 0, F.col("ones") / F.col("count")
    data = zipped.select(
        F.floor(F.col("tree") / size).cast("int").alias("group"), (F.col("tree") % size).cast("int").alias("treeID"),
        F.struct(
            "id", "prediction", ((F.col("ones") - F.col("ones") * p) / F.col("count")).alias("impurity"),
            F.array("count", "ones", "ones").alias("impurityStats"), F.col("count").cast("bigint").alias("rawCount"), "gain",
            F.col("l").alias("leftChild"), F.col("r").alias("rightChild"),
            F.struct(F.col("feature").alias("featureIndex"),
                     F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    data.write.mode("overwrite").partitionBy("group").parquet(f"{path}/all/data")

    def about(kind: str, params: dict, defaults: dict, uid: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": params, "defaultParamMap": defaults, **more})

    params = {p.name: v for p, v in learner.extractParamMap().items() if learner.isSet(p)}
    defaults = {p.name: v for p, v in learner.extractParamMap().items() if not learner.isSet(p)}
    own = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate"}  # of forests alone
    tree_of = [{k: v for k, v in d.items() if k not in own} for d in (params, defaults)]
    heads = [(k, about("RandomForestRegressionModel", params | {"numTrees": n}, defaults, f"{learner.uid}_{k}", numFeatures=n_features, numTrees=n))
             for k, n in enumerate(groups)]
    each = [(k, t, about("DecisionTreeRegressionModel", *tree_of, f"dtr_{learner.uid}_{k}_{t}"), 1.0) for k, n in enumerate(groups) for t in range(n)]
    spark.createDataFrame(heads, "group int, value string").repartitionByRange(1, "group").write.mode("overwrite").partitionBy("group").text(f"{path}/all/metadata")
    spark.createDataFrame(each, "group int, _1 int, _2 string, _3 double").repartitionByRange(1, "group").write.mode("overwrite").partitionBy("group").parquet(
        f"{path}/all/treesMetadata")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = hadoop(path).getFileSystem(conf)
    for k in range(len(groups)):
        fs.mkdirs(hadoop(f"{path}/{k}"))
        for name in ("data", "metadata", "treesMetadata"):
            if not fs.rename(hadoop(f"{path}/all/{name}/group={k}"), hadoop(f"{path}/{k}/{name}")):
                raise OSError(f"{path}/all/{name}/group={k} was not moved")
    fs.delete(hadoop(f"{path}/all"), True)


def group_sums(spark: SparkSession, rows: DataFrame, path: str, n_groups: int) -> DataFrame:
    """(_row, task, sums): for each of ``rows`` (_row, x) the predictions added up over the trees of each of the models at
    ``path``/0, ...; the groups of a task follow on those of the task before.  A task holds its trees and reads all rows."""
    tasks = max(-(-n_groups // GROUPS_A_TASK), min(n_groups, 2 * spark.sparkContext.defaultParallelism))
    node = F.col("nodeData")
    models = spark.read.parquet(*[f"{path}/{k}/data" for k in range(n_groups)]).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)/data/[^/]*$", 1).cast("int").alias("group"), "treeID", node["id"].alias("id"),
        node["leftChild"].alias("l"), node["rightChild"].alias("r"), node["split"]["featureIndex"].alias("feature"),
        F.when(node["leftChild"] >= 0, node["split"]["leftCategoriesOrThreshold"][0]).otherwise(node["prediction"]).alias("value"))
    models = models.select(F.floor(F.col("group") * tasks / n_groups).cast("int").alias("task"), "group", "treeID", "id", "l", "r", "feature", "value",
                           F.lit(None).cast("bigint").alias("_row"), F.lit(None).cast("array<double>").alias("x"))
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("group", "int"), ("treeID", "int"), ("id", "int"), ("l", "int"), ("r", "int"), ("feature", "int"), ("value", "double"))]
    copies = rows.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), *nothing, "_row", "x")
    dealt = models.union(copies).repartitionById(tasks, F.col("task")).sortWithinPartitions(F.asc_nulls_last("group"), "treeID", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, forest, task = [], None, None
        for batch in batches:
            n = batch.num_rows - batch.column("group").null_count  # nodes come first
            if n:
                held.append([batch.column(c).slice(0, n).to_numpy(zero_copy_only=False) for c in ("group", "treeID", "id", "l", "r", "feature", "value")])
            if n == batch.num_rows:
                continue
            if forest is None:
                forest, task = _Walk(*(np.concatenate(c) for c in zip(*held))), batch.column("task")[0].as_py()
                held = []
            own = batch.slice(n)
            sums = forest.sums(_matrix(own))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
            yield pa.record_batch([own.column("_row"), pa.array(np.full(len(sums), task), pa.int32()), lists], names=["_row", "task", "sums"])

    return dealt.mapInArrow(work, "_row bigint, task int, sums array<double>")


class _Walk:
    """Trees of some groups, node after node; a leaf's ``value`` is its prediction, another node's its threshold."""

    def __init__(self, group, tree, number, left, right, feature, value):
        self.roots = np.flatnonzero(number == 0)
        base = np.repeat(self.roots, np.diff(np.append(self.roots, len(number))))
        self.left, self.right = (np.where(c >= 0, base + c, 0).astype(np.int32) for c in (left, right))
        self.feature, self.value = feature.astype(np.int32), value
        self.groups = np.unique(group[self.roots], return_inverse=True)[1]

    def sums(self, x: np.ndarray) -> np.ndarray:
        n, width = x.shape
        flat, out = np.ascontiguousarray(x).reshape(-1), np.zeros((n, self.groups.max() + 1))
        for root, g in zip(self.roots, self.groups):
            at, open_ = np.full(n, root), np.arange(n)
            while len(open_):
                now = at[open_]
                f = self.feature[now]
                inner = f >= 0
                if not inner.all():
                    open_, now, f = open_[inner], now[inner], f[inner]
                at[open_] = np.where(flat[open_ * width + f] <= self.value[now], self.left[now], self.right[now])
            out[:, g] += self.value[at]
        return out
