"""The null/boundary rules on the 5-account fixture (FIXTURES.md §3)."""

import math

import pytest
from fixtures import EXPECTED, EXPECTED_AMOUNTS, micro
from pyspark.sql import functions as F

from ledgerlens.functions.expr import MINMAX_EPSILON
from ledgerlens.plans.base import base_features
from ledgerlens.plans.features import MODEL_NUMERIC, eda_features, model_features


@pytest.fixture(scope="module")
def p2(spark):
    labels, users, trx = micro(spark)
    return base_features(labels, users, trx, keep_amounts=True).orderBy("id").toPandas()


@pytest.mark.parametrize("col", sorted(EXPECTED))
def test_base_columns(p2, col):
    got = p2[col].tolist()
    for g, e in zip(got, EXPECTED[col]):
        assert g == pytest.approx(e), (col, got)


@pytest.mark.parametrize("col", sorted(EXPECTED_AMOUNTS))
def test_amounts(p2, col):
    got = [None if v is None else float(v) for v in p2[col].tolist()]
    assert got == [None if e is None else float(e) for e in EXPECTED_AMOUNTS[col]]


def test_missing_string_becomes_zero(p2):
    assert p2.loc[p2.id == 5, "business_type"].item() == "0"


def test_filled_dates(p2):
    # never-senders get the population's earliest last date
    assert str(p2.loc[p2.id == 3, "last_trx_date"].item()) == "2020-02-04"
    assert str(p2.loc[p2.id == 4, "first_trx_date"].item()) == "2020-02-03"


def test_model_features_no_nan(spark):
    labels, users, trx = micro(spark)
    p2 = base_features(labels, users, trx, keep_amounts=True)
    p3 = model_features(p2).toPandas()
    num = p3[MODEL_NUMERIC]
    assert not num.isna().any().any()
    assert all(math.isfinite(v) for v in num.to_numpy().ravel())
    # min-max then log: the maximum amount maps to log(1 + eps), the minimum to log(eps)
    assert p3["amount_received_log"].max() == pytest.approx(math.log(1 + MINMAX_EPSILON))
    assert p3["amount_received_log"].min() == pytest.approx(math.log(MINMAX_EPSILON))
    # amount_received: 61 for id 1 -> scaled 1; log ratio sent/received
    r1 = p3.loc[p3.id == 1].iloc[0]
    assert r1["amount_sent_receive_logratio"] == pytest.approx(
        r1["amount_sent_log"] / r1["amount_received_log"])


def test_onehot_on_fixture(spark):
    labels, users, trx = micro(spark)
    p3 = model_features(base_features(labels, users, trx, keep_amounts=True))
    cols = set(p3.columns)
    # business_type: food 2/5, shop 2/5, '0' 1/5 -> all > 0.1, least frequent '0' dropped
    assert {"food", "shop"} <= cols and "0" not in cols
    # area_name: a 2/5, b 3/5 -> all pass, 'a' dropped; area_type likewise drops 'rural'
    assert "b" in cols and "a" not in cols
    assert "urban" in cols and "rural" not in cols
    # gender: male 2/5, female 2/5, unknown 1/5 -> all pass, drop 'unknown'
    assert {"male", "female"} <= cols and "unknown" not in cols


def test_eda_variant_columns(spark):
    labels, users, trx = micro(spark)
    e = eda_features(base_features(labels, users, trx))
    assert {"area_type", "gender", "n_partners_ratio_log"} <= set(e.columns)
    assert "n_transactions_sent_log" not in e.columns


def test_refit_vs_reuse_stats(spark):
    """Scoring another population with the fitted row keeps its globals."""
    from ledgerlens.plans.base import population_stats

    labels, users, trx = micro(spark)
    p2 = base_features(labels, users, trx)
    stats = population_stats(p2)
    sub = labels.where(F.col("id") <= 2)
    refit = base_features(sub, users, trx).orderBy("id").toPandas()
    reused = base_features(sub, users, trx, stats=stats).orderBy("id").toPandas()
    # refitted: id 2 registered last in the sub-population -> 0 days
    assert refit["days_from_registr"].tolist() == [10.5, 0.0]
    assert reused["days_from_registr"].tolist() == [30.0, 19.5]
