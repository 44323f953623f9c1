"""Forests grown a tree in a task: the trees are Spark ML's, the work does not grow with the groups."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from ledgerlens.ml import forest as T
from ledgerlens.ml import models as M

SMALL = {"max_depth": 7, "max_features": 3, "min_samples_leaf": 1, "min_samples_split": 4, "n_estimators": 12}


@pytest.fixture(scope="module")
def data(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    rows = spark.range(900).select(
        "id", (F.sin(F.col("id") * 0.7) + noise).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)).cast("double").alias("b"),
        (F.col("id") % 3).cast("double").alias("few"), F.lit(4.0).alias("constant"), (F.col("id") % 2).cast("double").alias("dummy"))
    label = ((F.col("a") + F.col("b") / 60 + F.col("few") / 3 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) / 12) > 2).cast("double")
    return M.training_table(M.assemble(rows.withColumn("inactive", label), ["a", "b", "few", "constant", "dummy"])).checkpoint()


def binned_rows(data):
    at = T.thresholds(data, M.FEATURES, 32)
    blocks = sorted(T.binned(data, M.LABEL, M.FEATURES, at).collect(), key=lambda r: (r["part"], r["no"]))
    x = np.concatenate([np.frombuffer(r["x"], np.uint8).reshape(len(at), -1) for r in blocks], axis=1)
    return at, x, np.concatenate([np.frombuffer(r["y"], np.uint8) for r in blocks])


@pytest.mark.parametrize("depth, least", [(22, 1), (5, 1), (9, 7), (0, 1)])
@pytest.mark.parametrize("gini", [False, True])
def test_a_tree_is_the_one_of_spark_ml(spark, data, tmp_path, monkeypatch, gini, depth, least):
    learner = (DecisionTreeClassifier if gini else DecisionTreeRegressor)(
        featuresCol=M.FEATURES, labelCol=M.LABEL, maxDepth=depth, minInstancesPerNode=least)
    model = learner.fit(data)
    model.write().save(str(tmp_path / "tree"))
    want = [r["nodeData"] if "nodeData" in r else r for r in spark.read.parquet(str(tmp_path / "tree" / "data")).orderBy("id").collect()]
    at, x, y = binned_rows(data)
    every = lambda n: np.tile(np.arange(len(at)), (n, 1))
    tree = T.grow_tree(x, y, np.ones(len(y), np.int64), every, at, 32, depth, least, gini)
    for c, of in (("l", lambda r: r["leftChild"]), ("r", lambda r: r["rightChild"]), ("feature", lambda r: r["split"]["featureIndex"]),
                  ("threshold", lambda r: (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0]), ("prediction", lambda r: r["prediction"]),
                  ("count", lambda r: r["rawCount"])):
        assert tree[c].tolist() == [of(r) for r in want]
    assert np.allclose(tree["gain"], [r["gain"] for r in want])
    assert np.allclose(T.importances(tree, len(at)), model.featureImportances.toArray())
    monkeypatch.setattr(T, "NODES_AT_ONCE", 3)
    again = T.grow_tree(x, y, np.ones(len(y), np.int64), every, at, 32, depth, least, gini)
    assert T.digest(again) == T.digest(tree)
    # a row of weight 2 counts as two rows
    weight = np.arange(len(y)) % 3
    own, twice = np.repeat(np.arange(len(y)), weight), np.ones(weight.sum(), np.int64)
    parts = [T.grow_tree(a, b, w, every, at, 32, depth, least, gini) for a, b, w in ((x, y, weight), (np.ascontiguousarray(x[:, own]), y[own], twice))]
    assert T.digest(parts[0]) == T.digest(parts[1])


def test_cuts():
    few = np.array([1.0, 2.0, 5.0])
    assert T.cuts(few, np.ones(3), 31).tolist() == [1.5, 3.5] and T.cuts(few[:1], np.ones(1), 31).tolist() == []
    many = np.arange(1000.0)
    assert len(T.cuts(many, np.ones(1000), 31)) == 31 and np.diff(T.cuts(many, np.ones(1000), 31)).max() < 34


def jobs(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("learner", [M.forest_classifier, M.forest_regressor])
def test_the_jobs_of_a_forest_do_not_grow_with_its_groups(spark, data, monkeypatch, learner):
    monkeypatch.setattr(M, "FIT_TREE_ROWS", 2 * 900)
    assert len(M.tree_groups(900, 12)) == 6
    (digests, importances), n_jobs = jobs(spark, f"facts-{learner.__name__}", lambda: M.forest_facts(learner(SMALL), data))
    assert n_jobs < 25  # a fit of each group takes one for every level
    assert len(set(digests)) == 12 and sum(importances.total()) == pytest.approx(1) and importances.total()[3] == 0
    again, _ = M.forest_facts(learner(SMALL), M.training_table(data.repartition(3).orderBy(F.xxhash64("id"))))
    other, _ = M.forest_facts(learner(SMALL, seed=7), data)
    assert again == digests and not set(other) & set(digests)
    # beside a forest that Spark ML grows
    whole = learner(SMALL | {"n_estimators": 60}).fit(data).featureImportances.toArray()
    _, many = M.forest_facts(learner(SMALL | {"n_estimators": 60}), data)
    assert np.abs(np.array(many.total()) - whole).max() < 0.05


def test_a_stored_forest_scores_as_spark_ml_does_without_its_driver(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "FIT_TREE_ROWS", 5 * 900)
    forest, n_jobs = jobs(spark, "stored", lambda: M.StoredForest.grow(M.forest_regressor(SMALL), data, str(tmp_path / "forest")))
    assert forest.trees == [5, 5, 2] and n_jobs < 40
    monkeypatch.setattr(M.RandomForestRegressionModel, "load", lambda path: pytest.fail("a group was loaded on the driver"))
    scores, n_jobs = jobs(spark, "scores", lambda: {r["id"]: r["prediction"] for r in forest.transform(data).select("id", "prediction").collect()})
    assert n_jobs < 12
    monkeypatch.undo()
    parts = [M.RandomForestRegressionModel.load(f"{tmp_path}/forest/{k}") for k in range(3)]
    assert [(p.getNumTrees, p.numFeatures, p.getMaxDepth()) for p in parts] == [(5, 5, 7), (5, 5, 7), (2, 5, 7)]
    sums = np.sum([[r["prediction"] * p.getNumTrees for r in p.transform(data).orderBy("id").collect()] for p in parts], axis=0)
    assert np.allclose([scores[i] for i in sorted(scores)], sums / 12)
    assert M.accuracy(forest.transform(data).withColumn("prediction", F.round("prediction"))) > 0.85


def test_forests_that_no_task_can_hold_are_grown_by_spark_ml(spark, data, tmp_path, monkeypatch):
    three = SMALL | {"n_estimators": 3, "max_depth": 3}
    monkeypatch.setattr(M, "FIT_TREE_ROWS", 900)
    odd = data.withColumn("inactive", F.col("inactive") * 2)
    assert M.grown_in_tasks(M.forest_regressor(three), data) is not None
    assert M.grown_in_tasks(M.forest_regressor(three), odd) is None
    monkeypatch.setattr(M, "TASK_BYTES", 900)
    assert M.grown_in_tasks(M.forest_regressor(three), data) is None
    digests, importances = M.forest_facts(M.forest_classifier(three), data)
    assert len(digests) == 3 and sum(importances.total()) == pytest.approx(1)
    forest = M.StoredForest.grow(M.forest_regressor(three), data, str(tmp_path / "forest"))
    assert forest.trees == [1, 1, 1] and forest.transform(data).where("prediction between 0 and 1").count() == 900
