"""Registered queries: one per operator family, each over the whole
stand-in tables of a scale-factor folder.

In the registered form only (the library returns full precision and native
types) doubles are rounded to 6 places, decimals become doubles and dates
ISO strings, so that the DuckDB oracle can be compared by value.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.encoding import category_shares, fit_onehot, full_dummies
from ledgerlens.operators.ledger import account_activity, edge_table
from ledgerlens.operators.neighbours import dormant_neighbours
from ledgerlens.ml import models as M
from ledgerlens.operators import distributions as D
from ledgerlens.operators import profile as P
from ledgerlens.plans.base import AMOUNT_COLUMNS, base_features, population_stats
from ledgerlens.plans.features import MODEL_NUMERIC, align_to, eda_features, fit_model_features, model_features
from ledgerlens.plans.scoring import Ranker, fit_ranker, scoring_table, training_table
from ledgerlens.session import materialize
from ledgerlens.sources import standin as S
from ledgerlens.sources.files import read_csv, stage_folder, stage_handoff, write_csv
from ledgerlens.sources.schema import ONEHOT_COLUMNS, USERS

ROUND_DIGITS = 6


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


def _inputs(spark: SparkSession, sf_dir: str, population: str = "all"):
    return (S.account_labels(spark, sf_dir, population), S.users(spark, sf_dir),
            S.ledger(spark, sf_dir))


def p2_stage(spark: SparkSession, sf_dir: str, population: str = "all",
             labelled: bool = True) -> DataFrame:
    """Base features with amounts, written to the checkpoint folder (the
    stage hand-off: later phases read it several times)."""
    labels = (S.account_labels(spark, sf_dir, population) if labelled
              else S.population_ids(spark, sf_dir, population))
    p2 = base_features(labels, S.users(spark, sf_dir), S.ledger(spark, sf_dir),
                       keep_amounts=True)
    return materialize(p2)


def base_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2 over the whole labelled population."""
    labels, users, ledger = _inputs(spark, sf_dir)
    return round_doubles(base_features(labels, users, ledger))


def nullable_counts_as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts that are NULL for "no row on that side" travel as doubles in
    the registered form (pandas has no nullable int64 by default)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def account_activity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-account activity over the whole ledger."""
    act = account_activity(S.ledger(spark, sf_dir))
    counts = [c for c in act.columns if c.startswith("n_")]
    return round_doubles(nullable_counts_as_double(act, counts))


def dormant_neighbours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: dormant-partner counts for every ledger account with one."""
    labels, users, ledger = _inputs(spark, sf_dir)
    edges = stage_handoff(edge_table(ledger), "edges")  # one ledger scan for both
    p2 = base_features(labels, users, ledger, edges=edges)
    nb = dormant_neighbours(ledger, p2.select("id", "is_stage_2"), edges=edges)
    return nullable_counts_as_double(nb, ["n_partners_received_stage_2", "n_partners_sent_stage_2"])


def model_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 33 numeric model features of the whole population."""
    return round_doubles(model_features(p2_stage(spark, sf_dir), with_dummies=False))


def test_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features for the unlabelled test population, refitted."""
    p4 = p2_stage(spark, sf_dir, "test", labelled=False)
    return round_doubles(model_features(p4, with_dummies=False))


def _with_dummy_list(features: DataFrame, names: list[str]) -> DataFrame:
    """The dummies that are 1, as one sorted comma-joined column: the registered form has the same
    columns whatever categories the data have."""
    on = F.array(*[F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in sorted(names)])
    return features.select(*[c for c in features.columns if c not in names],
                           F.array_join(on, ",").alias("dummies"))


def model_features_full_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 as the model trains on it: numeric features and dummies of the whole population."""
    p2 = p2_stage(spark, sf_dir)
    fitted = fit_model_features(p2)
    return round_doubles(_with_dummy_list(model_features(p2, fitted), fitted.encoding.names))


def test_features_full_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 with dummies: the test population, refitted on itself."""
    p4 = p2_stage(spark, sf_dir, "test", labelled=False)
    fitted = fit_model_features(p4)
    return round_doubles(_with_dummy_list(model_features(p4, fitted), fitted.encoding.names))


def scoring_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19 + Q19: the test population with the training population's statistics, bounds, dummies
    and column order."""
    ledger, users = S.ledger(spark, sf_dir), S.users(spark, sf_dir)
    edges = stage_handoff(edge_table(ledger), "edges")
    p2, p3, fitted = training_table(S.account_labels(spark, sf_dir, "train"), users, ledger, edges)
    p4 = scoring_table(S.population_ids(spark, sf_dir, "test"), users, ledger, population_stats(p2), fitted, edges)
    aligned = align_to(p4, ["id", *M.feature_columns(p3)])
    return round_doubles(_with_dummy_list(aligned, fitted.encoding.names))


def csv_roundtrip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: the profiles written as CSV, some values as null tokens or infinite, and read back
    with the declared schema."""
    odd = F.pmod(F.col("id"), F.lit(7))
    balance = (F.when(odd == 1, "NaN").when(odd == 2, "NA").when(odd == 3, "inf").when(odd == 4, "-Infinity")
               .otherwise(F.col("start_balance").cast("string")))
    gender = F.when(odd == 5, "nan").when(odd == 6, "").otherwise(F.col("gender"))
    path = f"{stage_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(S.users(spark, sf_dir).withColumns({"start_balance": balance, "gender": gender}), path)
    back = read_csv(spark, path, USERS)
    return round_doubles(back.withColumn("registration_time", F.date_format("registration_time", "yyyy-MM-dd HH:mm:ss")))


def top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on a deterministic score: the 100 accounts longest dormant, ties by id, with their rank."""
    p2 = p2_stage(spark, sf_dir)
    best = M.top_k(p2.select("id", "days_past_last_trxs"), "days_past_last_trxs", 100)
    # the rank window runs over the 100 rows that are left
    order = Window.orderBy(F.desc("days_past_last_trxs"), "id")
    return best.select(F.row_number().over(order).alias("rank"), "id", "days_past_last_trxs")


def accuracy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 on fixed predictions: dormant accounts predicted inactive."""
    p2 = p2_stage(spark, sf_dir)
    scored = p2.select(F.col("inactive").cast("double").alias(M.LABEL), F.col("is_stage_2").cast("double").alias("prediction"))
    n = scored.count()
    return spark.createDataFrame([(n, round(float(M.accuracy(scored)), 6))], "n_rows bigint, accuracy double")


def label_feature_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: id, label and the assembled vector's size and sum."""
    p3 = model_features(p2_stage(spark, sf_dir), with_dummies=False)
    data = M.assemble(p3, M.feature_columns(p3))
    x = vector_to_array(M.FEATURES)
    return round_doubles(data.select("id", M.LABEL, F.size(x).alias("n_features"),
                                     F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("total")), 4)


def eda_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploration variant of the features."""
    labels, users, ledger = _inputs(spark, sf_dir)
    return round_doubles(eda_features(base_features(labels, users, ledger)))


def onehot_fit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category counts, shares, kept and baseline flags."""
    labels, users, ledger = _inputs(spark, sf_dir)
    p2 = base_features(labels, users, ledger)
    return round_doubles(category_shares(p2, ONEHOT_COLUMNS))


def onehot_encode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted dummies of every account, unpivoted to
    ``(id, dummy, value)``."""
    p2 = p2_stage(spark, sf_dir)
    enc = fit_onehot(p2, ONEHOT_COLUMNS)
    wide = enc.transform(p2.select("id", *ONEHOT_COLUMNS))
    return wide.select("id", *enc.names).unpivot(["id"], enc.names, "dummy", "value")


def profiled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table the exploration phase profiles: p2 of the whole population."""
    return p2_stage(spark, sf_dir).drop(*AMOUNT_COLUMNS)


def profile_census_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(P.census(profiled_table(spark, sf_dir)))


def profile_nulls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.null_counts(profiled_table(spark, sf_dir))


def profile_describe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profiled_table(spark, sf_dir)
    return round_doubles(P.describe(t, P.numeric_columns(t)))


def profile_uniques_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profiled_table(spark, sf_dir)
    return P.unique_values(t, P.string_columns(t) + P.integer_columns(t))


def profile_head_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(P.head(profiled_table(spark, sf_dir), 5, ["id"]))


def outliers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profiled_table(spark, sf_dir)
    return round_doubles(P.outliers(t, P.numeric_columns(t), 3.0))


def correlation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = profiled_table(spark, sf_dir)
    return P.correlation(t, P.numeric_columns(t), 3)


# The exploration notebook's column sets: 20 numeric columns of p2, and the
# label cast to string with three profile columns as categories.
EDA_NUMERIC = [
    "start_balance", "n_transactions_sent", "n_transactions_received", "n_transactions",
    "n_penalties", "n_bonuses", "n_partners_received", "n_partners_sent", "n_partners",
    "days_before_first_trx", "days_from_registr", "days_past_last_trxs", "count_intensity",
    "count_sent_intensity", "count_received_intensity", "is_stage_2", "stage_2_partners_share",
    "n_partners_received_stage_2", "n_partners_sent_stage_2", "n_partners_stage_2",
]
EDA_CATEGORICAL = ["inactive", "account_type", "area_name", "business_type"]


def eda_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2 with the label as a category."""
    t = profiled_table(spark, sf_dir)
    return t.withColumn("inactive", F.col("inactive").cast("string"))


def dist_categorical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.category_histogram(eda_table(spark, sf_dir), EDA_CATEGORICAL)


def dist_crosstab_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.crosstab_pairs(eda_table(spark, sf_dir), EDA_CATEGORICAL)


def dist_density_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(D.density_curves(eda_table(spark, sf_dir), EDA_NUMERIC))


def dist_density_cells_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same curves by the fast Gauss transform, exact to rounding at this error."""
    return round_doubles(D.density_curves(eda_table(spark, sf_dir), EDA_NUMERIC, cells_above=1000, error=1e-13))


def dist_box_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(D.box_stats(eda_table(spark, sf_dir), EDA_NUMERIC))


def dist_hist2d_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.hist2d(eda_table(spark, sf_dir), EDA_NUMERIC)


def dist_trend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(D.trend_lines(eda_table(spark, sf_dir), EDA_NUMERIC))


def dist_box_by_category_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(D.box_stats_by_category(eda_table(spark, sf_dir), EDA_CATEGORICAL,
                                                 EDA_NUMERIC))


def dummy_correlation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + A17: the exploration features with every category of the two
    kept string columns as a prefixed dummy, then the correlation matrix."""
    e = eda_features(p2_stage(spark, sf_dir)).drop("id")
    wide = full_dummies(e, ["area_type", "gender"], min_share=0.01)
    return P.correlation(wide, P.numeric_columns(wide), 3)


def _train_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled training table (train population, refitted features)."""
    p2 = p2_stage(spark, sf_dir, "train")
    p3 = model_features(p2)
    feats = M.feature_columns(p3)
    return materialize(M.training_table(M.assemble(
        p3.withColumn("inactive", F.col("inactive").cast("double")), feats)))


@functools.cache
def _stored_ranker(application: str, path: str, sf_dir: str) -> tuple[str, Ranker]:
    """The chosen forest, fitted once for an application and data folder and stored among its stages; its
    path and the fitted object."""
    spark = SparkSession.active()
    ranker, _ = fit_ranker(S.account_labels(spark, sf_dir, "train"), S.users(spark, sf_dir), S.ledger(spark, sf_dir))
    path = f"{path}/ranker-{uuid.uuid4().hex}"
    ranker.save(path)
    return path, ranker


def _scored(spark: SparkSession, sf_dir: str, ranker: Ranker) -> DataFrame:
    p4 = ranker.prepared(S.population_ids(spark, sf_dir, "test"), S.users(spark, sf_dir), S.ledger(spark, sf_dir))
    return ranker.scores(p4)


def forest_rank_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3 + K1 + P19: the 500 test accounts most likely inactive, scored by the stored forest."""
    path, _ = _stored_ranker(spark.sparkContext.applicationId, stage_folder(spark), sf_dir)
    return M.top_k(_scored(spark, sf_dir, Ranker.load(spark, path)), "prediction", 500).select("id")


#: The fewest trees of the search range, for the checks that need a second fit.
CHECK_FOREST = M.BEST_FOREST | {"n_estimators": 25}


def forest_checks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3: what must hold of the forests whatever the data: ``(check, n, ok)``.

    Scores lie in [0, 1]; the top 500 are distinct and in order; the stored forest puts the same accounts
    first as the fitted one; importances sum to 1; a fit on the same rows in another order and other
    partitions is the same forest."""
    path, fitted = _stored_ranker(spark.sparkContext.applicationId, stage_folder(spark), sf_dir)
    stored = Ranker.load(spark, path)
    scores = materialize(_scored(spark, sf_dir, stored))
    n, low, high = scores.agg(F.count(F.lit(1)), F.min("prediction"), F.max("prediction")).first()
    top = M.top_k(scores, "prediction", 500).collect()  # 500 rows
    same = [r["id"] for r in M.top_k(_scored(spark, sf_dir, fitted), "prediction", 500).collect()]
    order = [(-r["prediction"], r["id"]) for r in top]
    sums = [float(sum(m.featureImportances.toArray())) for m in (fitted.model, stored.model)]
    rows = [("scores_in_range", n, n == 0 or (low >= 0 and high <= 1)),
            ("top_distinct_and_ordered", len(top), order == sorted(set(order))),
            ("stored_forest_same_top", len(same), same == [r["id"] for r in top]),
            ("importances_sum_to_1", 2, all(abs(s - 1) < 1e-9 for s in sums))]
    data = _train_vectors(spark, sf_dir)
    shuffled = materialize(data.repartition(5).orderBy(F.xxhash64("id")))
    for name, learner in (("classifier", M.forest_classifier), ("regressor", M.forest_regressor)):
        trees, importances = M.forest_facts(learner(CHECK_FOREST), M.training_table(data))
        again, _ = M.forest_facts(learner(CHECK_FOREST), M.training_table(shuffled))
        ok = trees == again and abs(sum(importances.total()) - 1) < 1e-9
        rows.append((f"{name}_order_of_rows", len(trees), bool(ok)))
    return spark.createDataFrame(rows, "check string, n bigint, ok boolean")


def forest_importances_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: classifier forest fitted on the training population; the fitted
    model's feature importances."""
    p2 = p2_stage(spark, sf_dir, "train")
    p3 = model_features(p2)
    feats = M.feature_columns(p3)
    train = materialize(M.training_table(M.assemble(p3, feats)))
    _, importances = M.forest_facts(M.forest_classifier(), train)
    return spark.createDataFrame(list(zip(feats, importances.total())), "feature string, importance double")


def _search_facts(spark: SparkSession, searches: dict[str, M.SearchResult], n_rows: int) -> DataFrame:
    """What must hold for every point of a search whatever the data: one row for each, beside the number
    of rows.  The scores themselves come from ``models.cv_search`` and ``models.search_table``."""
    rows = []
    for family, result in searches.items():
        for k, (_, score) in enumerate(result.scores):
            own = [e for e in result.evidence if e["point"] == k]
            rows.append((family, k, n_rows, len({e["fold"] for e in own}), all(e["converged"] for e in own),
                         all(e["descending"] for e in own), 0.0 <= score <= result.best_score <= 1.0))
    return spark.createDataFrame(rows, "family string, point int, n_rows bigint, folds int, converged boolean, "
                                       "descending boolean, score_in_range boolean")


def model_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5 + M6: the 3-fold cross-validated search over the default number of points (20) of the
    elastic-net logistic regression space; every fit of a point has to converge."""
    data = _train_vectors(spark, sf_dir)
    return _search_facts(spark, {"logistic_net": M.cv_search(data, "logistic_net", folds=3)}, data.count())


# One point per family that Spark ML fits one by one, well inside the search ranges.
FAMILY_POINTS = {
    "svm": {"C": 1.0},
    "gbt": {"subsample": 0.9, "colsample": 0.8, "max_depth": 5, "min_child_weight": 5, "learning_rate": 0.1,
            "n_estimators": 50},
    "mlp": {"learning_rate_init": 0.1, "max_iter": 250, "hidden_layer_sizes": 150},
}


def model_accuracy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5-M9: 3-fold cross-validation of every family: the logistic penalties at points drawn from their
    full ranges, the others at one point each."""
    from concurrent.futures import ThreadPoolExecutor

    data = _train_vectors(spark, sf_dir)
    searches = {f: M.cv_search(data, f, n_points=3, folds=3) for f in ("logistic", "logistic_l1", "logistic_net")}
    searches["logistic_none"] = M.cv_search(data, "logistic_none", n_points=1, folds=3)
    # independent validations, submitted as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=len(FAMILY_POINTS)) as pool:
        done = pool.map(lambda item: (item[0], M.cv_search(data, item[0], folds=3, points=[item[1]])), FAMILY_POINTS.items())
        searches |= dict(done)
    return _search_facts(spark, searches, data.count())


def pca_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained variance of 3 principal components of the
    non-categorical training features."""
    p2 = p2_stage(spark, sf_dir, "train")
    p3 = model_features(p2, with_dummies=False)
    feats = [c for c in M.feature_columns(p3) if c != "is_stage_2"]
    data = M.assemble(p3, feats)
    _, ratios = M.principal_components(data, 3)
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(ratios)],
                                 "component int, explained_variance double")


def pca_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training account's 3 components beside its categorical columns, per category: the
    category counts, and per component whether the projection keeps its promises (``models.pca_identities``)."""
    p3 = materialize(model_features(p2_stage(spark, sf_dir, "train")))
    categorical = ["is_stage_2", *[c for c in p3.columns if c not in ("id", M.LABEL, *MODEL_NUMERIC)]]
    feats = [c for c in M.feature_columns(p3) if c not in categorical]
    table = materialize(M.component_table(p3, feats, categorical, 3))
    checks = M.pca_identities(p3.select(*feats), table, feats, 3)
    counted = table.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_stage_2").alias("n_stage_2"))
    n, dormant = counted.first()
    return spark.createDataFrame([(k + 1, n, dormant, *ok) for k, ok in enumerate(checks)],
                                 "component int, n_rows bigint, n_stage_2 bigint, ratio_is_share_of_variance boolean, "
                                 "uncorrelated_with_others boolean")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "base_features": base_features_query,
        "account_activity": account_activity_query,
        "dormant_neighbours": dormant_neighbours_query,
        "model_features": model_features_query,
        "test_features": test_features_query,
        "model_features_full": model_features_full_query,
        "test_features_full": test_features_full_query,
        "scoring_features": scoring_features_query,
        "csv_roundtrip": csv_roundtrip_query,
        "top_k_deterministic": top_k_query,
        "accuracy_fixed_predictions": accuracy_query,
        "label_feature_split": label_feature_split_query,
        "eda_features": eda_features_query,
        "onehot_fit": onehot_fit_query,
        "onehot_encode": onehot_encode_query,
        "profile_census": profile_census_query,
        "profile_nulls": profile_nulls_query,
        "profile_describe": profile_describe_query,
        "profile_uniques": profile_uniques_query,
        "profile_head": profile_head_query,
        "outliers": outliers_query,
        "correlation": correlation_query,
        "dist_categorical": dist_categorical_query,
        "dist_crosstab": dist_crosstab_query,
        "dist_density": dist_density_query,
        "dist_density_cells": dist_density_cells_query,
        "dist_box": dist_box_query,
        "dist_hist2d": dist_hist2d_query,
        "dist_trend": dist_trend_query,
        "dist_box_by_category": dist_box_by_category_query,
        "dummy_correlation": dummy_correlation_query,
        "forest_rank_top500": forest_rank_query,
        "forest_checks": forest_checks_query,
        "forest_importances": forest_importances_query,
        "model_search": model_search_query,
        "model_accuracy": model_accuracy_query,
        "pca_variance": pca_query,
        "pca_projection": pca_projection_query,
    }
