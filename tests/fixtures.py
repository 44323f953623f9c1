"""What the tests share, and the hand-made micro fixture: 5 accounts, 7 transactions."""

import os
from datetime import datetime
from decimal import Decimal

from ledgerlens.sources.schema import LABELS, TRANSACTIONS, USERS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def ts(s):
    return datetime.strptime(s, "%Y-%m-%d %H:%M")


def micro(spark):
    users = spark.createDataFrame([
        (1, 100.0, ts("2020-01-01 00:00"), "individual", "food", "a", "rural", "male"),
        (2, 0.0, ts("2020-01-11 12:00"), "individual", "food", "a", "rural", "male"),
        (3, 50.0, ts("2020-01-21 00:00"), "individual", "shop", "b", "urban", "female"),
        (4, 400.0, ts("2020-01-31 00:00"), "individual", "shop", "b", "urban", "female"),
        (5, 400.0, ts("2020-01-02 00:00"), "individual", None, "b", "urban", "unknown"),
    ], USERS)
    trx = spark.createDataFrame([
        (-1, 1, ts("2020-01-02 10:00"), Decimal("50")),
        (1, 3, ts("2020-01-05 09:00"), Decimal("20")),
        (2, 3, ts("2020-01-12 09:00"), Decimal("5")),
        (5, 1, ts("2020-02-03 08:00"), Decimal("4")),
        (5, -1, ts("2020-02-04 11:00"), Decimal("3")),
        (2, 1, ts("2020-02-05 10:00"), Decimal("7")),
        (1, 3, ts("2020-03-06 08:00"), Decimal("10")),
    ], TRANSACTIONS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], LABELS)
    return labels, users, trx


# column -> values for ids 1..5
EXPECTED = {
    "n_transactions_sent": [2, 2, 0, 0, 2],
    "n_transactions_received": [3, 0, 3, 0, 0],
    "n_transactions": [5, 0, 0, 0, 0],
    "n_penalties": [0, 0, 0, 0, 1],
    "n_bonuses": [1, 0, 0, 0, 0],
    "n_partners_sent": [1, 2, 0, 0, 2],
    "n_partners_received": [3, 0, 2, 0, 0],
    "n_partners": [4, 0, 0, 0, 0],
    "days_before_first_trx": [4, 1, 0, 0, 32],
    "days_from_registr": [30.0, 19.5, 10.0, 0.0, 29.0],
    "days_past_last_trxs": [0, 30, 31, 31, 31],
    "is_stage_2": [0, 0, 1, 1, 1],
    "n_partners_received_stage_2": [1, 0, 0, 0, 0],
    "n_partners_sent_stage_2": [1, 1, 0, 0, 0],
    "stage_2_partners_share": [0.5, 0, 0, 0, 0],
    "avg_time_between_trxs": [6.0, 0, 0, 0, 0],
    "count_intensity": [1 / 6, 0, 0, 0, 0],
}
EXPECTED_AMOUNTS = {
    "amount_sent": [30, 12, None, None, 7],
    "amount_received": [61, None, 35, None, None],
    "amount_bonuses": [50, None, None, None, None],
    "amount_penalties": [None, None, None, None, 3],
}
