"""Model operators: rows-only checks plus score range and top-k size."""

import pytest
from fixtures import SF_SMALL

from ledgerlens.ml import models as M
from ledgerlens.plans.scoring import rank_inactive
from ledgerlens.sources import standin as S

SMALL_FOREST = {"max_depth": 6, "max_features": 5, "min_samples_leaf": 1,
                "min_samples_split": 4, "n_estimators": 10}


def test_rank_inactive(spark):
    run = rank_inactive(S.account_labels(spark, SF_SMALL, "train"),
                        S.population_ids(spark, SF_SMALL, "test"), S.users(spark, SF_SMALL),
                        S.ledger(spark, SF_SMALL), k=20, grid=SMALL_FOREST)
    top = [r.id for r in run.top.collect()]
    assert len(top) == 20 and len(set(top)) == 20
    assert all(i % 5 == 0 for i in top)
    # test features carry exactly the trained columns
    assert run.test_features.columns[1:] == [c for c in run.train_features.columns if c != "inactive"][1:]


def test_forest_scores_in_unit_interval(spark):
    from ledgerlens.plans.registry import _train_vectors

    data = _train_vectors(spark, SF_SMALL)
    model = M.forest_regressor(SMALL_FOREST).fit(data)
    preds = model.transform(data).select("prediction").toPandas().prediction
    assert preds.between(0, 1).all()
    acc = M.accuracy(M.forest_classifier(SMALL_FOREST).fit(data).transform(data))
    assert 0.5 <= acc <= 1.0


def test_cv_search_and_pca(spark):
    from ledgerlens.plans.registry import _train_vectors

    data = _train_vectors(spark, SF_SMALL)
    res = M.cv_search(data, "logistic", n_points=2, folds=3)
    assert 0 <= res.best_score <= 1 and "C" in res.best_params
    _, ratios = M.principal_components(data, 3)
    assert len(ratios) == 3 and sum(ratios) <= 1 + 1e-9


def test_a_stored_ranker_scores_alone(spark, tmp_path):
    from ledgerlens.plans.scoring import Ranker, fit_ranker, score_inactive

    users, ledger = S.users(spark, SF_SMALL), S.ledger(spark, SF_SMALL)
    ranker, p3 = fit_ranker(S.account_labels(spark, SF_SMALL, "train"), users, ledger, SMALL_FOREST)
    ranker.save(str(tmp_path / "ranker"))
    stored = Ranker.load(spark, str(tmp_path / "ranker"))
    assert stored.features == ranker.features and stored.fitted.encoding.dummies == ranker.fitted.encoding.dummies
    ids = S.population_ids(spark, SF_SMALL, "test")
    top = [[r.id for r in score_inactive(r, ids, users, ledger, 25).collect()] for r in (ranker, stored)]
    assert top[0] == top[1] and len(top[0]) == 25


def test_components_beside_the_categories(spark):
    from pyspark.sql import functions as F

    df = spark.range(60).select("id", (F.col("id") % 2).alias("kind"), (F.col("id") * 1.0).alias("a"),
                                (F.sin("id") * 3).alias("b"), (F.col("id") * 2 + F.cos("id")).alias("c"))
    table = M.component_table(df, ["a", "b", "c"], ["kind"], 2)
    assert table.columns == ["id", "kind", "pc1", "pc2", "ratio1", "ratio2"] and table.count() == 60
    assert M.pca_identities(df, table, ["a", "b", "c"], 2) == [(True, True), (True, True)]
    wrong = table.withColumn("pc1", F.col("pc1") + F.col("pc2"))
    assert M.pca_identities(df, wrong, ["a", "b", "c"], 2) == [(False, False), (True, False)]


def test_regparam_mapping():
    lr = M.logistic("l1", C=10.0, n_rows=100)
    assert lr.getRegParam() == pytest.approx(1e-3) and lr.getElasticNetParam() == 1.0


def test_depth_outside_the_range_is_an_error():
    with pytest.raises(ValueError):
        M.forest_params({**SMALL_FOREST, "max_depth": 80})
    assert M.SEARCH_SPACES["forest"]["max_depth"] == ("int", 10, 30)


CORES = """
import sys
sys.path.insert(0, {root!r})
from ledgerlens.session import get_session
spark = get_session(master="local[" + sys.argv[1] + "]", shuffle_partitions=int(sys.argv[2]))
from ledgerlens.ml import models as M
from ledgerlens.plans.registry import _train_vectors
from ledgerlens.plans.scoring import rank_inactive
from ledgerlens.sources import standin as S
sf = {sf!r}
run = rank_inactive(S.account_labels(spark, sf, "train"), S.population_ids(spark, sf, "test"), S.users(spark, sf),
                    S.ledger(spark, sf), k=20, grid={grid!r})
print("TOP", [r.id for r in run.top.collect()])
print("CV", [round(s, 9) for _, s in M.cv_search(_train_vectors(spark, sf), "logistic", n_points=2).scores])
"""


def test_results_do_not_depend_on_the_cores():
    import subprocess
    import sys

    from fixtures import ROOT

    code = CORES.format(root=ROOT, sf=SF_SMALL, grid=SMALL_FOREST)
    out = [[x for x in subprocess.run([sys.executable, "-c", code, cores, parts], capture_output=True, text=True, check=True,
                                      timeout=600).stdout.splitlines() if x.startswith(("TOP", "CV"))]
           for cores, parts in (("2", "3"), ("4", "8"))]
    assert len(out[0]) == 2 and out[0] == out[1]


def test_a_forest_grown_in_groups_holds_one_of_them_at_a_time(spark, tmp_path, monkeypatch):
    import numpy as np

    from ledgerlens.plans.registry import _train_vectors
    from ledgerlens.plans.scoring import Ranker, fit_ranker

    data = _train_vectors(spark, SF_SMALL)
    whole = list(M.grown(M.forest_classifier(SMALL_FOREST), data))
    assert len(whole) == 1 and M.tree_digests(whole[0]) == M.tree_digests(M.forest_classifier(SMALL_FOREST).fit(data))
    monkeypatch.setattr(M, "FIT_TREE_ROWS", 4 * data.count())
    assert M.tree_groups(data.count(), 10) == [4, 4, 2] and M.tree_groups(10 ** 9, 3) == [1, 1, 1]
    users, ledger = S.users(spark, SF_SMALL), S.ledger(spark, SF_SMALL)
    ranker, _ = fit_ranker(S.account_labels(spark, SF_SMALL, "train"), users, ledger, SMALL_FOREST)
    ranker.save(str(tmp_path / "ranker"))
    stored = Ranker.load(spark, str(tmp_path / "ranker"))
    assert isinstance(stored.model, M.StoredForest) and stored.model.getNumTrees == 10
    p4 = ranker.prepared(S.population_ids(spark, SF_SMALL, "test"), users, ledger)
    p4 = p4.union(p4.limit(3))  # rows that repeat an id each keep their score
    one, two = (sorted(map(tuple, r.scores(p4).collect())) for r in (ranker, stored))
    assert one == two and len(one) == p4.count()
    # the mean over the trees of all groups
    vectors = M.assemble(p4, ranker.features, keep=("id",))
    parts = [M.RandomForestRegressionModel.load(f"{stored.model.path}/{k}") for k in range(3)]
    assert len({d for m in parts for d in M.tree_digests(m)}) == 10
    sums = [[r.prediction * m.getNumTrees for r in m.transform(vectors).orderBy("id", "prediction").collect()] for m in parts]
    want = np.sum(sums, axis=0) / 10
    assert np.allclose([p for _, p in one], want)
    every = [t.featureImportances.toArray() for m in parts for t in m.trees]
    assert np.allclose(ranker.model.featureImportances.toArray(), np.mean(every, axis=0))
