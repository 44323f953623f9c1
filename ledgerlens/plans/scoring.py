"""M3: train on the labelled population, score another, keep the top k.

Both populations share one written edge table.  The test population's base
features, min-max bounds and one-hot encoding use the *training*
population's fitted statistics (Q19), and the test columns are selected by
the trained model's names (P19), so a category that is dummy-encoded in
training but rare in the test set is still encoded the same way.

A ``Ranker`` holds the model and everything that was fitted with it, and can be
stored: scoring is then a job of its own that sees no training row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.ml.models import (
    BEST_FOREST,
    FEATURES,
    StoredForest,
    assemble,
    feature_columns,
    forest_regressor,
    top_k,
    training_table as dealt_rows,
    tree_groups,
)
from ledgerlens.operators.encoding import OneHotEncoding
from ledgerlens.operators.ledger import edge_table
from ledgerlens.plans.base import base_features, population_stats
from ledgerlens.plans.features import FittedFeatures, align_to, fit_model_features, model_features
from ledgerlens.session import materialize
from ledgerlens.sources.files import folder_exists, stage_folder, stage_handoff


@dataclass
class RankingRun:
    top: DataFrame
    model: object
    fitted: FittedFeatures
    train_features: DataFrame
    test_features: DataFrame


def training_table(train_labels: DataFrame, users: DataFrame, ledger: DataFrame,
                   edges: DataFrame | None = None):
    """p2 and p3 of the labelled population, with the fitted statistics."""
    p2 = materialize(base_features(train_labels, users, ledger, keep_amounts=True, edges=edges))
    fitted = fit_model_features(p2)
    return p2, model_features(p2, fitted), fitted


def scoring_table(test_ids: DataFrame, users: DataFrame, ledger: DataFrame, stats: DataFrame,
                  fitted: FittedFeatures, edges: DataFrame | None = None) -> DataFrame:
    """p4 of an unlabelled population with the training statistics (``population_stats``)."""
    p2 = materialize(base_features(test_ids.select("id"), users, ledger, stats=stats, keep_amounts=True,
                                   edges=edges))
    return model_features(p2, fitted)


@dataclass
class Ranker:
    """A fitted ranking forest with the training population's statistics."""

    model: RandomForestRegressionModel | StoredForest
    fitted: FittedFeatures
    stats: DataFrame
    features: list[str]

    def prepared(self, ids: DataFrame, users: DataFrame, ledger: DataFrame, edges: DataFrame | None = None) -> DataFrame:
        """p4 of ``ids`` as the model was trained on it, in the order of its columns."""
        return align_to(scoring_table(ids, users, ledger, self.stats, self.fitted, edges), ["id", *self.features])

    def scores(self, prepared: DataFrame) -> DataFrame:
        """``(id, prediction)``, the mean leaf value of the forest."""
        return self.model.transform(assemble(prepared, self.features, keep=("id",))).select("id", "prediction")

    def save(self, path: str) -> None:
        """Write the model (Spark ML's own format, one for each group of trees) and one small table for each fitted value below ``path``."""
        spark, path = self.stats.sparkSession, path.rstrip("/")
        if isinstance(self.model, StoredForest):
            self.model.save(f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        self.stats.write.mode("overwrite").parquet(f"{path}/population")
        self.fitted.minmax.write.mode("overwrite").parquet(f"{path}/bounds")
        dummies = [(i, *d) for i, d in enumerate(self.fitted.encoding.dummies)]
        spark.createDataFrame(dummies, "place int, name string, column string, value string").write.mode(
            "overwrite").parquet(f"{path}/dummies")
        spark.createDataFrame(list(enumerate(self.features)), "place int, name string").write.mode(
            "overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ranker:
        """Read what ``save`` has written; the collected tables have one row for each feature."""
        path = path.rstrip("/")
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        dummies = [(r["name"], r["column"], r["value"]) for r in read("dummies").orderBy("place").collect()]
        features = [r["name"] for r in read("features").orderBy("place").collect()]
        fitted = FittedFeatures(read("bounds"), OneHotEncoding(dummies), features)
        model = (StoredForest.load(spark, f"{path}/model") if folder_exists(spark, f"{path}/model/groups")
                 else RandomForestRegressionModel.load(f"{path}/model"))
        return cls(model, fitted, read("population"), features)


def fit_ranker(train_labels: DataFrame, users: DataFrame, ledger: DataFrame, grid: dict = BEST_FOREST, seed: int = 42,
               edges: DataFrame | None = None) -> tuple[Ranker, DataFrame]:
    """Fit the regression forest on the training features; also returns these (p3).

    A forest of one group of trees is fitted as it is, one of several is stored group by group."""
    train_p2, p3, fitted = training_table(train_labels, users, ledger, edges)
    feats = feature_columns(p3)
    train = materialize(dealt_rows(assemble(
        p3.withColumn("inactive", F.col("inactive").cast("double")), feats)))
    learner, spark = forest_regressor(grid, seed), train.sparkSession
    model = (learner.fit(train) if len(tree_groups(train.count(), learner.getNumTrees())) == 1
             else StoredForest.grow(learner, train, f"{stage_folder(spark)}/forest-{uuid.uuid4().hex}"))
    return Ranker(model, fitted, population_stats(train_p2), feats), p3


def rank_inactive(train_labels: DataFrame, test_ids: DataFrame, users: DataFrame,
                  ledger: DataFrame, k: int = 500, grid: dict = BEST_FOREST,
                  seed: int = 42) -> RankingRun:
    """Fit the regression forest on the training features and return the
    ``k`` test accounts with the highest predicted inactivity (``id``,
    best first; ties by id)."""
    edges = stage_handoff(edge_table(ledger), "edges")
    ranker, p3 = fit_ranker(train_labels, users, ledger, grid, seed, edges)
    p4 = ranker.prepared(test_ids, users, ledger, edges)
    return RankingRun(top_k(ranker.scores(p4), "prediction", k).select("id"), ranker.model, ranker.fitted, p3, p4)


def score_inactive(ranker: Ranker, ids: DataFrame, users: DataFrame, ledger: DataFrame, k: int = 500) -> DataFrame:
    """The scoring job: the ``k`` accounts of ``ids`` that a stored ranker puts first (``id``, best first)."""
    edges = stage_handoff(edge_table(ledger), "edges")
    return top_k(ranker.scores(ranker.prepared(ids, users, ledger, edges)), "prediction", k).select("id")


__all__ = ["FEATURES", "Ranker", "RankingRun", "fit_ranker", "rank_inactive", "score_inactive", "scoring_table", "training_table"]
