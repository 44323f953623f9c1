"""Perceptrons fitted in shared passes: Spark ML's fits, as long as its loss comes down."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.ml import models as M
from ledgerlens.ml import perceptron as P


def table(spark, wide=1.0, n=1100):
    part = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000
    rows = spark.range(n).select("id", (part(1) * wide).alias("a"), part(2).alias("b"), (F.col("id") % 2).cast("double").alias("c"))
    label = (F.col("a") / wide + F.col("b") + part(3) / 2 > 1.1).cast("double")
    return M.with_folds(M.training_table(M.assemble(rows.withColumn("inactive", label), ["a", "b", "c"]), 4), 3, 42).persist()


def starts(data, learners):
    return [np.array(m.copy({m.maxIter: 0}).fit(data.limit(2)).weights.toArray()) for m in learners]


def test_fits_are_those_of_spark_ml(spark, monkeypatch):
    data = table(spark)
    learners = [M.neural_net(3, 7, 12, 0.05, 42), M.neural_net(3, 4, 20, 0.02, 5)]
    own = {"hidden": [7, 4], "steps": [0.05, 0.02], "max_iter": [12, 20]}
    blocks = P.pack(data, M.LABEL, M.FEATURES, "fold", 3).persist()
    fits = P.fit_many(blocks, 3, starts(data, learners), [0, 1, 2], **own)
    assert [(f.point, f.fold) for f in fits] == [(p, f) for p in (0, 1) for f in (0, 1, 2)]
    right = P.fold_accuracy(blocks, fits, 3)
    for fit, share in zip(fits, right):
        model = learners[fit.point].fit(data.where(F.col("fold") != fit.fold))
        history = list(model.summary().objectiveHistory)
        assert all(b < a for a, b in zip(history, history[1:]))  # here the loss comes down
        assert np.allclose(fit.losses, history, rtol=1e-10) and np.allclose(fit.weights, model.weights.toArray(), rtol=1e-8)
        assert share == pytest.approx(M.accuracy(model.transform(data.where(F.col("fold") == fit.fold))))
    # blocks dealt to other partitions
    monkeypatch.setattr(P, "BLOCK_ROWS", 50)
    monkeypatch.setattr(P, "PART_ROWS", 90)
    dealt = P.pack(data, M.LABEL, M.FEATURES, "fold", 3).persist()
    assert dealt.rdd.getNumPartitions() == 12
    again = P.fit_many(dealt, 3, starts(data, learners), [0, 1, 2], **own)
    assert all(np.allclose(a.weights, b.weights, rtol=1e-8) for a, b in zip(fits, again))


def test_a_fit_ends_when_its_weights_stand_still(spark):
    data = table(spark, n=300)
    blocks = P.pack(data, M.LABEL, M.FEATURES, "fold", 3).persist()
    fit, = P.fit_many(blocks, 3, starts(data, [M.neural_net(3, 4, 50)]), [1], hidden=[4], steps=[0.01], max_iter=[50], tolerance=0.5)
    assert len(fit.losses) == 2


def test_a_loss_that_would_rise_comes_down(spark):
    data = table(spark, wide=-50000.0)
    learner = M.neural_net(3, 40, 30, 1.5, 42)
    history = list(learner.fit(data.where("fold <> 0")).summary().objectiveHistory)
    assert any(b > a for a, b in zip(history, history[1:]))
    blocks = P.pack(data, M.LABEL, M.FEATURES, "fold", 3).persist()
    fit, = P.fit_many(blocks, 3, starts(data, [learner]), [0], hidden=[40], steps=[1.5], max_iter=[30])
    assert all(b <= a for a, b in zip(fit.losses, fit.losses[1:])) and fit.losses[-1] < fit.losses[0]


def test_a_search_takes_one_job_a_step_for_all_folds(spark):
    data, sc = table(spark).drop("fold"), spark.sparkContext
    sc.setJobGroup("mlp", "mlp")
    try:
        result = M.cv_search(data, "mlp", folds=3, points=[{"learning_rate_init": 0.05, "max_iter": 40, "hidden_layer_sizes": 5}])
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("mlp")) < 40 + 40  # a job for every fold's step would be 120 and more
    assert [(e["fold"], e["converged"], e["descending"], e["steps"]) for e in result.evidence] == [(f, True, True, 41) for f in range(3)]
    assert 0 <= result.best_score <= 1


def test_other_labels_are_an_error(spark):
    with pytest.raises(Exception, match="labels other than 0 and 1"):
        P.pack(table(spark, n=50).withColumn("inactive", F.lit(2.0)), M.LABEL, M.FEATURES, "fold", 3).count()


def test_boosted_trees_are_the_same_with_and_without_node_ids(spark):
    data = table(spark)
    flat = M.boosted_trees(3, n_estimators=4, subsample=0.9, colsample=0.8)
    assert not flat.getCacheNodeIds() and M.boosted_trees(16).getCacheNodeIds()
    trees = [m.toDebugString.split("\n", 1)[1] for m in (flat.fit(data), flat.copy({flat.cacheNodeIds: True}).fit(data))]
    assert trees[0] == trees[1]
