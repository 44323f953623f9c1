
import math

import pytest
from fixtures import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.operators.ledger import account_activity
from ledgerlens.plans.base import base_features
from ledgerlens.plans.features import MODEL_NUMERIC, model_features
from ledgerlens.sources import standin as S


@pytest.fixture(scope="module")
def inputs(spark):
    return (S.account_labels(spark, SF_SMALL), S.users(spark, SF_SMALL), S.ledger(spark, SF_SMALL))


def test_sent_equals_received_equals_rows(spark, inputs):
    _, _, ledger = inputs
    act = account_activity(ledger)
    sums = act.agg(F.sum("n_transactions_sent"), F.sum("n_transactions_received")).first()
    assert sums[0] == sums[1] == ledger.count()


def test_partner_bounds_and_row_count(spark, inputs):
    labels, users, ledger = inputs
    p2 = base_features(labels, users, ledger).toPandas()
    assert len(p2) == labels.count()
    assert (p2.n_partners_received_stage_2 <= p2.n_partners_received).all()
    assert (p2.n_partners_sent_stage_2 <= p2.n_partners_sent).all()
    assert set(p2.is_stage_2.unique()) <= {0, 1}


def test_model_features_clean(spark, inputs):
    labels, users, ledger = inputs
    p3 = model_features(base_features(labels, users, ledger, keep_amounts=True)).toPandas()
    vals = p3[MODEL_NUMERIC].to_numpy().ravel()
    assert all(v is not None and math.isfinite(v) for v in vals)


def test_input_order_does_not_matter(spark, inputs):
    labels, users, ledger = inputs
    a = base_features(labels, users, ledger).orderBy("id").toPandas()
    shuffled = ledger.orderBy(F.rand(7)).repartition(5)
    b = base_features(labels.orderBy(F.rand(3)), users, shuffled).orderBy("id").toPandas()
    assert a.equals(b)
