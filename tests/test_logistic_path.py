"""Logistic regressions fitted together against Spark ML's own and against their optimality conditions."""

import numpy as np
import pytest
from fixtures import SF_SMALL
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlens.ml import logistic_path as L
from ledgerlens.ml import models as M


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 6)) * [1, 5, 0.1, 1, 1, 1] + [0, 100, 0, 0, 0, 0]
    x[:, 5] = x[:, 0] - x[:, 3]  # depends on others
    y = (x[:, 0] - 0.4 * (x[:, 1] - 100) + rng.logistic(size=600) > 0.3).astype(float)
    rows = [(i, float(b), [float(v) for v in a] + [1.0]) for i, (a, b) in enumerate(zip(x, y))]  # a constant feature
    df = spark.createDataFrame(rows, "id long, inactive double, a array<double>")
    return M.with_folds(M.training_table(df.select("id", "inactive", array_to_vector("a").alias("features"))), 3, 1).persist()


def test_same_fits_as_spark(table):
    blocks = L.pack(table, "inactive", "features", "fold").persist()
    points = [(0.02, 0.0), (0.0, 0.05), (0.01, 0.01)]
    fits = L.fit_many(blocks, 7, points, [0, 1, 2, None], tolerance=1e-9)
    assert [(f.point, f.fold) for f in fits] == [(p, f) for p in range(3) for f in (0, 1, 2, None)]
    assert all(f.converged and f.violation <= 1e-7 for f in fits)
    assert all(b <= a + 1e-12 for f in fits for a, b in zip(f.objectives, f.objectives[1:]))
    for f in fits:
        if f.fold in (1, None):
            rows = table if f.fold is None else table.where(F.col("fold") != f.fold)
            reg = f.l1 + f.l2
            lr = LogisticRegression(labelCol="inactive", regParam=reg, elasticNetParam=f.l1 / reg, maxIter=500, tol=1e-12).fit(rows)
            margin = np.array(lr.coefficients) - f.coefficients
            assert f.objectives[-1] <= lr.summary.objectiveHistory[-1] + 1e-9
            assert np.abs(margin[[1, 2, 4]]).max() < 1e-3 * max(1, np.abs(f.coefficients).max())
            assert f.coefficients[6] == 0
            # the features that depend on each other may share their weight in other ways: the sum counts
            assert f.coefficients[0] + f.coefficients[5] == pytest.approx(lr.coefficients[0] + lr.coefficients[5], abs=1e-3)
    right = L.fold_accuracy(blocks, fits, 7)
    f = next(k for k, x in enumerate(fits) if (x.point, x.fold) == (1, 2))
    own = [(r.inactive, float(np.dot(r.features.toArray(), fits[f].coefficients) + fits[f].intercept))
           for r in table.where("fold = 2").collect()]
    assert right[f] == pytest.approx(np.mean([(m > 0) == (y > 0.5) for y, m in own]))
    blocks.unpersist()


def test_no_penalty_and_separable(spark):
    rows = [(i, float(i >= 20), [float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, inactive double, a array<double>").select("inactive", array_to_vector("a").alias("features"))
    fit = L.fit_many(L.pack(df, "inactive", "features"), 1, [(0.0, 0.0)], [None], max_passes=8)[0]
    assert fit.objectives[-1] < fit.objectives[0] and not fit.converged  # no finite optimum: said, not hidden
    strong = L.fit_many(L.pack(df, "inactive", "features"), 1, [(10.0, 0.0)], [None])[0]
    assert strong.converged and strong.coefficients[0] == 0
    with pytest.raises(ValueError):
        L.fit_many(L.pack(df.limit(0), "inactive", "features"), 1, [(0.0, 0.0)], [None])


def test_many_tasks_and_small_blocks(table, monkeypatch):
    whole = L.fit_many(L.pack(table, "inactive", "features", "fold"), 7, [(0.01, 0.0)], [0])[0]
    monkeypatch.setattr(L, "DRIVER_PARTIALS", 2)
    parts = L.fit_many(L.pack(table.repartition(9), "inactive", "features", "fold"), 7, [(0.01, 0.0)], [0])[0]
    assert parts.converged and np.allclose(parts.coefficients, whole.coefficients, atol=1e-6)


def test_search_over_all_penalties(spark):
    from ledgerlens.plans.registry import _train_vectors

    data = _train_vectors(spark, SF_SMALL)
    for family, n in (("logistic", 2), ("logistic_l1", 2), ("logistic_net", 2)):
        res = M.cv_search(data, family, n_points=n)
        assert len(res.scores) == n and len(res.evidence) == 3 * n
        assert all(e["converged"] and e["descending"] for e in res.evidence)
        assert 0 <= res.best_score <= 1 and res.best_score == max(s for _, s in res.scores)
    assert M.penalties("logistic_net", {"C": 10.0, "l1_ratio": 0.25}, 100) == pytest.approx((2.5e-4, 7.5e-4))
    assert M.penalties("logistic_none", {}, 100) == (0.0, 0.0)


def test_other_families_bring_evidence(spark):
    from ledgerlens.plans.registry import _train_vectors

    data = _train_vectors(spark, SF_SMALL)
    for family, point in (("svm", {"C": 1.0}), ("forest", {"max_depth": 3, "max_features": 2, "min_samples_leaf": 1, "n_estimators": 4})):
        res = M.cv_search(data, family, folds=2, points=[point])
        assert len(res.evidence) == 2 and all(e["converged"] and e["descending"] for e in res.evidence)
    table = M.evidence_table(spark, res, "forest")
    assert table.count() == 2 and table.where("converged").count() == 2
