"""Model operators on Spark ML.

The feature table is assembled into a vector column once; every estimator
is a distributed Spark ML job.  Scores are carried with ``id`` (Spark has no
row position to re-attach them by).
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor  # noqa: F401 (the groups of a StoredForest)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.ml import perceptron
from ledgerlens.ml.forest import group_sums, grow_trees, write_models
from ledgerlens.ml.logistic_path import fit_many, fold_accuracy, pack
from ledgerlens.operators.moments import pair_moments
from ledgerlens.session import materialize
from ledgerlens.sources.files import copy_folder, write_parquet

LABEL = "inactive"
FEATURES = "features"

# The forest settings chosen for the final fit.
BEST_FOREST = {"max_depth": 22, "max_features": 5, "min_samples_leaf": 1,
               "min_samples_split": 4, "n_estimators": 403}

# Search ranges per model family (inclusive bounds).  Spark ML grows trees to
# depth 30 at most, so the forest's range ends there; a least number of rows to split a node has
# no counterpart and is not searched.
SEARCH_SPACES = {
    "logistic_none": {},
    "logistic": {"C": ("float", 0.1, 1000.0)},
    "logistic_l1": {"C": ("float", 0.1, 1000.0)},
    "logistic_net": {"C": ("float", 0.1, 1000.0), "l1_ratio": ("float", 0.0, 1.0)},
    "svm": {"C": ("float", 0.1, 1000.0)},
    "forest": {"max_depth": ("int", 10, 30), "max_features": ("int", 1, 7),
               "min_samples_leaf": ("int", 1, 7), "n_estimators": ("int", 25, 500)},
    "gbt": {"subsample": ("float", 0.75, 1.0), "colsample": ("float", 0.75, 1.0), "max_depth": ("int", 2, 16),
            "min_child_weight": ("int", 2, 15), "learning_rate": ("float", 0.01, 0.5),
            "n_estimators": ("int", 25, 500)},
    "mlp": {"learning_rate_init": ("float", 0.01, 0.5), "max_iter": ("int", 200, 2000),
            "hidden_layer_sizes": ("int", 100, 1000)},
}

_MAX_TREE_DEPTH = 30


def _depth(depth: int) -> int:
    if not 0 <= int(depth) <= _MAX_TREE_DEPTH:
        raise ValueError(f"tree depth {depth} is outside Spark ML's 0..{_MAX_TREE_DEPTH}")
    return int(depth)


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = ("id", LABEL)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def assemble(df: DataFrame, feature_cols: list[str], keep: tuple[str, ...] = ("id", LABEL)) -> DataFrame:
    """P20: ``(id, label, features)`` with the features in a vector."""
    assembler = VectorAssembler(inputCols=feature_cols, outputCol=FEATURES, handleInvalid="error")
    kept = [c for c in keep if c in df.columns]
    return assembler.transform(df.select(*kept, *feature_cols)).select(*kept, FEATURES)


#: Partitions of every training table.  Spark ML draws its samples partition by partition, so this
#: number is a parameter of the model and never follows the cluster or the data; raise it with the
#: training rows (about a million a partition).
TRAINING_PARTITIONS = 8


def training_table(df: DataFrame, partitions: int = TRAINING_PARTITIONS) -> DataFrame:
    """``df`` dealt by a hash of ``id`` into a fixed number of partitions, in the order of ``id``: the
    same rows in the same places on any cluster, hence the same model."""
    return df.repartition(partitions, "id").sortWithinPartitions("id")


def with_folds(df: DataFrame, folds: int, seed: int) -> DataFrame:
    """Add the validation fold of every row, a hash of its ``id``."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(folds)).cast("int"))


# Execution settings for deep trees: keep each row's node id per tree
# between levels (instead of re-walking every tree from the root on every
# pass), checkpointed to the reliable folder every 10 levels, and let one
# pass split a larger group of nodes.  They do not change the model.
TREE_EXECUTION = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}

#: Boosted trees up to this depth are walked from the root: node ids would be kept and written for one tree each.
CACHED_DEPTH = 10


def forest_params(grid: dict) -> dict:
    """Translate the forest grid to Spark ML parameters.

    ``min_samples_split`` has no Spark counterpart (splits are also bounded
    by ``minInstancesPerNode`` on each child), so it is not enforced."""
    return {
        **TREE_EXECUTION,
        "numTrees": int(grid["n_estimators"]),
        "maxDepth": _depth(grid["max_depth"]),
        "featureSubsetStrategy": str(int(grid["max_features"])),
        "minInstancesPerNode": int(grid["min_samples_leaf"]),
    }


def forest_classifier(grid: dict = BEST_FOREST, seed: int = 42) -> RandomForestClassifier:
    """M1."""
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed,
                                  **forest_params(grid))


def forest_regressor(grid: dict = BEST_FOREST, seed: int = 42) -> RandomForestRegressor:
    """M2: regression forest on the 0/1 label; its prediction (mean leaf
    value) is the ranking score."""
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL, seed=seed,
                                 **forest_params(grid))


#: Rows times trees of one fit.  Spark ML keeps every node of the trees that a fit grows on the driver,
#: about 0.4 nodes for each row and tree, so a larger forest is grown some trees at a time.
FIT_TREE_ROWS = 1_000_000
#: From one such fit's seed to the next; the samples of a fit take one seed for each partition.
SEED_STEP = 1_000_003


def tree_groups(n_rows: int, n_trees: int) -> list[int]:
    """How many trees are grown together, one fit after another."""
    size = max(1, min(n_trees, FIT_TREE_ROWS // max(1, n_rows)))
    return [min(size, n_trees - k) for k in range(0, n_trees, size)]


def grown(learner: RandomForestClassifier | RandomForestRegressor, data: DataFrame) -> Iterator[Model]:
    """The learner's forest on ``data``, as one model for each of ``tree_groups``; all its trees are grown.

    The first takes the learner's own seed, so a forest of one group is the learner's fit.  A caller that
    lets go of each model before the next holds the nodes of one group at a time, whatever the rows."""
    seed = learner.getSeed()
    for k, trees in enumerate(tree_groups(data.count(), learner.getNumTrees())):
        yield learner.copy({learner.numTrees: trees, learner.seed: seed + k * SEED_STEP}).fit(data)


#: A training table whose binned rows, a byte for each feature, take more than this is left to Spark ML:
#: every task that grows whole trees holds all of them.
TASK_BYTES = 200_000_000
#: The most rows of such a table: a sum of counts stays a whole number.
TASK_ROWS = 20_000_000


def grown_in_tasks(learner: RandomForestClassifier | RandomForestRegressor, data: DataFrame, nodes: bool = False) -> DataFrame | None:
    """The trees of ``forest.grow_trees`` for a forest of several ``tree_groups``; None for a single group, and where a
    worker can't hold the rows or the labels are not 0 and 1: such forests are ``grown`` by Spark ML."""
    label = F.col(learner.getLabelCol()).cast("double")
    n_rows, odd = data.agg(F.count(F.lit(1)), F.count_if(label.isNull() | ~label.isin(0.0, 1.0))).first()
    if odd or len(tree_groups(n_rows, learner.getNumTrees())) == 1:
        return None
    width, tried = len(data.select(learner.getFeaturesCol()).first()[0]), learner.getFeatureSubsetStrategy()
    least = max(learner.getMinInstancesPerNode(), 1)
    plain = (learner.getSubsamplingRate(), learner.getMinInfoGain(), learner.getMinWeightFractionPerNode()) == (1.0, 0.0, 0.0)
    if n_rows * width > TASK_BYTES or n_rows > TASK_ROWS or not (tried.isdigit() and int(tried)) or learner.getMaxBins() > 256 or not plain:
        return None
    return grow_trees(data, learner.getLabelCol(), learner.getFeaturesCol(), trees=learner.getNumTrees(), tried=int(tried),
                      bins=min(learner.getMaxBins(), n_rows), depth=learner.getMaxDepth(), least=least,
                      gini=isinstance(learner, RandomForestClassifier), seed=learner.getSeed(), nodes=nodes)


def forest_facts(learner: RandomForestClassifier | RandomForestRegressor, data: DataFrame) -> tuple[list[str], Importances]:
    """The learner's forest on ``data``, all its trees grown: a digest of every tree, and the importances."""
    trees, importances = grown_in_tasks(learner, data), Importances()
    if trees is not None:
        rows = trees.orderBy("tree").collect()  # one row a tree: a digest and the importances
        importances.add_trees([(r["n_nodes"], r["importances"]) for r in rows])
        return [r["digest"] for r in rows], importances
    digests = []
    for model in grown(learner, data):
        digests += tree_digests(model)
        importances.add(model)
        del model
    return digests, importances


def tree_digests(model: Model) -> list[str]:
    """A digest of every tree's splits and leaves."""
    # the first line names the object
    return [hashlib.md5(t.toDebugString.split("\n", 1)[1].encode()).hexdigest() for t in model.trees]


class Importances:
    """Feature importances of a forest added up from its groups: the mean over the trees that split, as in one fit."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, list[float]]] = []

    def add(self, model: Model) -> None:
        split = sum(t.numNodes > 1 for t in model.trees)
        self.parts.append((split, [float(v) for v in model.featureImportances.toArray()]))

    def add_trees(self, trees: list[tuple[int, list[float]]]) -> None:
        """A group given as the nodes and the importances of each of its trees."""
        own = [values for n, values in trees if n > 1]
        sums = np.sum(own, axis=0) if own else np.zeros(len(trees[0][1]))
        self.parts.append((len(own), (sums / sums.sum() if own else sums).tolist()))

    def total(self) -> list[float]:
        if len(self.parts) == 1:
            return self.parts[0][1]
        sums = [sum(w * own[i] for w, own in self.parts) for i in range(len(self.parts[0][1]))]
        every = sum(sums)
        return [v / every for v in sums] if every else sums


class StoredForest:
    """A regression forest of several groups of trees, each a Spark ML model below ``path``; the driver
    never holds the whole forest."""

    def __init__(self, spark: SparkSession, path: str, trees: list[int], importances: Importances):
        self.spark, self.path, self.trees, self.importances = spark, path, trees, importances

    @classmethod
    def grow(cls, learner: RandomForestRegressor, data: DataFrame, path: str) -> StoredForest:
        trees, importances = [], Importances()
        in_tasks = grown_in_tasks(learner, data, nodes=True)
        if in_tasks is not None:
            facts = in_tasks.select("tree", "n_nodes", "importances").distinct().orderBy("tree").collect()  # one row a tree
            trees = tree_groups(data.count(), len(facts))
            for k, n in enumerate(trees):
                importances.add_trees([(r["n_nodes"], r["importances"]) for r in facts[k * trees[0]:k * trees[0] + n]])
            write_models(in_tasks, trees, learner, len(facts[0]["importances"]), path)
            return cls(data.sparkSession, path, trees, importances)
        for model in grown(learner, data):
            model.write().overwrite().save(f"{path}/{len(trees)}")
            trees.append(model.getNumTrees)
            importances.add(model)
            del model
        return cls(data.sparkSession, path, trees, importances)

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances.total())

    @property
    def getNumTrees(self) -> int:
        return sum(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, the mean leaf value over all trees.  A task adds up the trees of some groups
        for every row (``forest.group_sums``), and the groups' sums are added in the order of the groups."""
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
        sums = group_sums(self.spark, rows.select("_row", vector_to_array(FEATURES).alias("x")), self.path, len(self.trees))
        own = F.transform(F.array_sort(F.collect_list(F.struct("task", "sums"))), lambda t: t["sums"])
        added = F.aggregate(F.flatten(own), F.lit(0.0), lambda a, x: a + x)
        scored = sums.groupBy("_row").agg((added / self.getNumTrees).alias("prediction"))
        return rows.join(scored, "_row").drop("_row")

    def save(self, path: str) -> None:
        copy_folder(self.spark, self.path, path)
        parts = [(k, n, split, own) for k, (n, (split, own)) in enumerate(zip(self.trees, self.importances.parts))]
        write_parquet(self.spark.createDataFrame(
            parts, "place int, trees int, split_trees int, importances array<double>").coalesce(1), f"{path}/groups")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StoredForest:
        """Read what ``save`` has written; the collected table has one row for each group."""
        groups, importances = spark.read.parquet(f"{path}/groups").orderBy("place").collect(), Importances()
        importances.parts = [(r["split_trees"], list(r["importances"])) for r in groups]
        return cls(spark, path, [r["trees"] for r in groups], importances)


def logistic(penalty: str = "l2", C: float = 1.0, l1_ratio: float = 0.5,
             n_rows: int | None = None, max_iter: int = 100) -> LogisticRegression:
    """M6: ``penalty`` none / l2 / l1 / elasticnet.  An inverse strength
    ``C`` over ``n_rows`` examples maps to ``regParam = 1 / (C * n_rows)``."""
    reg = 0.0 if penalty == "none" else 1.0 / (C * (n_rows or 1))
    alpha = {"none": 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}[penalty]
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, regParam=reg,
                              elasticNetParam=alpha, maxIter=max_iter)


def linear_svm(C: float = 1.0, n_rows: int | None = None, max_iter: int = 100) -> LinearSVC:
    """M7: linear support vector machine (hinge loss, L2)."""
    return LinearSVC(featuresCol=FEATURES, labelCol=LABEL, regParam=1.0 / (C * (n_rows or 1)),
                     maxIter=max_iter)


def boosted_trees(max_depth: int = 5, learning_rate: float = 0.1, n_estimators: int = 100,
                  subsample: float = 1.0, min_child_weight: int = 1, colsample: float = 1.0,
                  seed: int = 42) -> GBTClassifier:
    """M8: gradient-boosted trees; ``colsample`` is the share of features tried at a split."""
    return GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxDepth=_depth(max_depth), featureSubsetStrategy=str(float(colsample)),
                         stepSize=learning_rate, maxIter=n_estimators, subsamplingRate=subsample,
                         minInstancesPerNode=min_child_weight, seed=seed,
                         **TREE_EXECUTION | {"cacheNodeIds": _depth(max_depth) > CACHED_DEPTH})


def neural_net(n_features: int, hidden: int = 100, max_iter: int = 200,
               learning_rate: float = 0.03, seed: int = 42) -> MultilayerPerceptronClassifier:
    """M9: one hidden layer."""
    return MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=LABEL,
                                          layers=[n_features, hidden, 2], maxIter=max_iter,
                                          stepSize=learning_rate, solver="gd", seed=seed)


def accuracy(predictions: DataFrame) -> float:
    """M5."""
    ev = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction",
                                           metricName="accuracy")
    return ev.evaluate(predictions)


def sample_points(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Points drawn uniformly from a search space (the search re-aimed as a
    seeded random search)."""
    rng = random.Random(seed)
    pts = []
    for _ in range(n):
        p = {}
        for name, (kind, lo, hi) in space.items():
            p[name] = rng.randint(lo, hi) if kind == "int" else rng.uniform(lo, hi)
        pts.append(p)
    return pts


@dataclass
class SearchResult:
    """``evidence``: for every fit what shows that it was trained (point, fold, converged, descending,
    steps and, where the learner knows it, the violation of its optimality conditions)."""

    best_score: float
    best_params: dict
    scores: list[tuple[dict, float]]
    evidence: list[dict] = field(default_factory=list)


#: Families whose fits share their passes over the rows (``logistic_path``), with the share of the
#: penalty that is absolute; None: a parameter of the point.
LOGISTIC = {"logistic_none": 0.0, "logistic": 0.0, "logistic_l1": 1.0, "logistic_net": None}


def cv_search(data: DataFrame, family: str, n_points: int = 20, folds: int = 3,
              seed: int = 42, parallelism: int = 4,
              points: list[dict] | None = None) -> SearchResult:
    """M4: k-fold cross-validated accuracy of sampled points of a model
    family's space (or of the given ``points``); best mean accuracy and its
    parameters.  The logistic families and the perceptrons fit all points and folds at
    once, in shared passes over cached blocks of rows; the others share one
    ``CrossValidator`` as parameter maps, up to ``parallelism`` of them at a time.
    Rows are dealt and folded by hashes of ``id``, so the scores do not depend on
    the cluster."""
    points = points or sample_points(SEARCH_SPACES[family], n_points, seed)
    data = with_folds(training_table(data), folds, seed).persist()
    try:
        n_rows = data.count()
        n_features = len(data.select(FEATURES).first()[0])
        if family in LOGISTIC:
            means, evidence = _logistic_search(data, family, points, folds, n_rows, n_features)
        elif family == "mlp":
            means, evidence = _perceptron_search(data, points, folds, seed, n_features)
        else:
            means, evidence = _validated(data, family, points, folds, seed, parallelism, n_rows, n_features)
    finally:
        data.unpersist()
    scores = [(p, float(m)) for p, m in zip(points, means)]
    best = max(scores, key=lambda t: t[1])
    return SearchResult(best[1], best[0], scores, evidence)


def penalties(family: str, p: dict, n_rows: int) -> tuple[float, float]:
    """(l1, l2) strengths of a point: an inverse strength ``C`` over ``n_rows`` examples is 1 / (C * n_rows)."""
    if family == "logistic_none":
        return 0.0, 0.0
    reg, share = 1.0 / (p["C"] * n_rows), LOGISTIC[family]
    share = p["l1_ratio"] if share is None else share
    return reg * share, reg * (1 - share)


def _logistic_search(data, family, points, folds, n_rows, n_features):
    blocks = pack(data, LABEL, FEATURES, "fold").persist()
    try:
        fits = fit_many(blocks, n_features, [penalties(family, p, n_rows) for p in points], list(range(folds)))
        right = fold_accuracy(blocks, fits, n_features).reshape(len(points), folds)
    finally:
        blocks.unpersist()
    evidence = [{"point": f.point, "fold": f.fold, "converged": f.converged, "steps": len(f.objectives), "violation": f.violation,
                 "descending": all(b <= a + 1e-9 for a, b in zip(f.objectives, f.objectives[1:]))} for f in fits]
    return right.mean(axis=1).tolist(), evidence


def _perceptron_search(data, points, folds, seed, n_features):
    learners = [_build("mlp", p, 0, n_features, seed) for p in points]
    two = data.limit(2).persist()
    try:  # no step: the first weights that the learner draws
        starts = [np.array(m.copy({m.maxIter: 0}).fit(two).weights.toArray()) for m in learners]
    finally:
        two.unpersist()
    blocks = perceptron.pack(data, LABEL, FEATURES, "fold", folds).persist()
    try:
        fits = perceptron.fit_many(blocks, n_features, starts, list(range(folds)), hidden=[m.getLayers()[1] for m in learners],
                                   steps=[m.getStepSize() for m in learners], max_iter=[m.getMaxIter() for m in learners],
                                   tolerance=learners[0].getTol())
        right = perceptron.fold_accuracy(blocks, fits, n_features).reshape(len(points), folds)
    finally:
        blocks.unpersist()
    evidence = [{"point": f.point, "fold": f.fold, "converged": len(f.losses) > 1, "descending": f.losses[-1] < f.losses[0],
                 "steps": len(f.losses), "violation": None} for f in fits]
    return right.mean(axis=1).tolist(), evidence


def _validated(data, family, points, folds, seed, parallelism, n_rows, n_features):
    estimators = [_build(family, p, n_rows, n_features, seed) for p in points]
    base = estimators[0]
    maps = [{base.getParam(prm.name): val for prm, val in est.extractParamMap().items() if est.isSet(prm)} for est in estimators]
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")
    cv = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol="fold",
                        seed=seed, parallelism=max(1, min(parallelism, len(maps))), collectSubModels=True)
    model = cv.fit(data)
    evidence = [{"point": k, "fold": f} | training_evidence(m, points[k]) for f, own in enumerate(model.subModels) for k, m in enumerate(own)]
    return model.avgMetrics, evidence


def training_evidence(model, point: dict) -> dict:
    """What a fitted model tells of its training: a loss that has come down, or all of its trees."""
    if hasattr(model, "getNumTrees"):
        grown = model.getNumTrees if isinstance(model.getNumTrees, int) else model.getNumTrees()
        return {"converged": grown == point.get("n_estimators", grown), "descending": model.totalNumNodes > grown, "steps": grown, "violation": None}
    history = list(model.summary().objectiveHistory)
    return {"converged": len(history) > 1, "descending": history[-1] < history[0], "steps": len(history), "violation": None}


def _build(family: str, p: dict, n_rows: int, n_features: int, seed: int) -> Estimator:
    if family == "svm":
        return linear_svm(p["C"], n_rows=n_rows)
    if family == "forest":
        return forest_classifier(p, seed)
    if family == "gbt":
        return boosted_trees(p["max_depth"], p["learning_rate"], p["n_estimators"],
                             p["subsample"], p["min_child_weight"], p.get("colsample", 1.0), seed)
    if family == "mlp":
        return neural_net(n_features, p["hidden_layer_sizes"], p["max_iter"],
                          p["learning_rate_init"], seed)
    raise ValueError(family)


def search_table(spark: SparkSession, result: SearchResult, family: str) -> DataFrame:
    rows = [(family, i, str(sorted(p.items())), s) for i, (p, s) in enumerate(result.scores)]
    return spark.createDataFrame(rows, "family string, point int, params string, accuracy double")


def evidence_table(spark: SparkSession, result: SearchResult, family: str) -> DataFrame:
    """The convergence report of a search: one row for every point and fold."""
    rows = [(family, e["point"], e["fold"], e["converged"], e["descending"], e["steps"], e["violation"]) for e in result.evidence]
    return spark.createDataFrame(rows, "family string, point int, fold int, converged boolean, descending boolean, steps int, violation double")


def principal_components(data: DataFrame, k: int = 3) -> tuple[DataFrame, list[float]]:
    """PCA on the assembled features; projected rows and the explained
    variance ratio of each component."""
    model = PCA(k=k, inputCol=FEATURES, outputCol="pca").fit(data)
    return model.transform(data), [float(v) for v in model.explainedVariance]


def component_table(df: DataFrame, feature_cols: list[str], categorical: list[str], k: int = 3,
                    key: str = "id") -> DataFrame:
    """M11 as a table: ``key``, the categorical columns as they are, ``pc1`` .. ``pck`` and the explained
    variance ratio of each as ``ratio1`` .. (the same in every row)."""
    vectors = VectorAssembler(inputCols=feature_cols, outputCol=FEATURES, handleInvalid="error").transform(df)
    projected, ratios = principal_components(vectors.select(key, *categorical, FEATURES), k)
    pc = vector_to_array("pca")
    return projected.select(key, *categorical, *[pc[i].alias(f"pc{i + 1}") for i in range(k)],
                            *[F.lit(ratios[i]).alias(f"ratio{i + 1}") for i in range(k)])


def pca_identities(features: DataFrame, table: DataFrame, feature_cols: list[str], k: int) -> list[tuple[bool, bool]]:
    """For every component of ``component_table``: whether its variance over the features' total variance is
    the ratio it reports (the trace identity), and whether it is uncorrelated with the other components."""
    total = sum(r["m2_a"] for r in pair_moments(features, feature_cols).where("column_a = column_b").collect())
    names = [f"pc{i + 1}" for i in range(k)]
    pairs = {(r["column_a"], r["column_b"]): r for r in pair_moments(table, names).collect()}  # k (k + 1) / 2 rows
    ratios = table.select(*[F.first(f"ratio{i + 1}") for i in range(k)]).first()
    out = []
    for i, name in enumerate(names):
        share = pairs[name, name]["m2_a"] / total if total else 0.0
        others = [r for (a, b), r in pairs.items() if a != b and name in (a, b)]
        out.append((abs(share - ratios[i]) < 1e-6,
                    all(abs(r["c_ab"]) <= 1e-6 * max((r["m2_a"] * r["m2_b"]) ** 0.5, 1e-300) for r in others)))
    return out


def top_k(scored: DataFrame, score_col: str = "prediction", k: int = 500,
          key: str = "id") -> DataFrame:
    """K1: the ``k`` best scores, ties broken by ``key``; planned as
    TakeOrderedAndProject (each task keeps ``k`` rows, the merge sees
    ``k`` x tasks)."""
    return scored.orderBy(F.col(score_col).desc(), F.col(key).asc()).limit(k)
