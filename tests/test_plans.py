"""Plan shape: the properties that decide behaviour at scale."""

from fixtures import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.operators.ledger import account_activity
from ledgerlens.plans.base import base_features
from ledgerlens.sources import standin as S


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_scan_is_pruned_and_filtered(spark):
    plan = S.ledger(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    orders = [ln for ln in plan.splitlines() if "orders.parquet" in ln][0]
    assert "o_orderdate" in orders and "LessThan(o_orderdate" in orders
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    lineitem = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    assert "l_shipdate" not in lineitem and "l_tax" not in lineitem


def test_activity_is_two_aggregation_shuffles_without_distinct(spark):
    plan = executed(account_activity(S.ledger(spark, SF_SMALL)))
    assert "Expand" not in plan          # no countDistinct rewrite
    assert plan.count("hashpartitioning(source") == 1
    assert plan.count("hashpartitioning(account") == 1
    assert "partial_sum" in plan and "partial_count" in plan   # map-side combine


def test_final_base_plan_reads_no_raw_table(spark):
    p2 = base_features(S.account_labels(spark, SF_SMALL), S.users(spark, SF_SMALL),
                       S.ledger(spark, SF_SMALL))
    plan = executed(p2)
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_hot_account_matches_brute_force(spark):
    """One account sends a third of all rows (to many partners): counts and
    distinct partners stay exact."""
    import pandas as pd

    rows = []
    for i in range(3000):
        src = 7 if i % 3 == 0 else 100 + i % 50
        rows.append((src, 200 + i % 400, f"2020-01-{1 + i % 28:02d} 00:00:00", 1.25))
    df = (spark.createDataFrame(rows, "source long, target long, t string, amount double")
          .select("source", "target", F.col("t").cast("timestamp_ntz").alias("time"),
                  F.col("amount").cast("decimal(18,2)").alias("amount")))
    got = account_activity(df.repartition(6)).toPandas().set_index("id")
    pdf = pd.DataFrame(rows, columns=["source", "target", "t", "amount"])
    sent = pdf.groupby("source").agg(n=("target", "size"), p=("target", "nunique"))
    assert got.loc[7, "n_transactions_sent"] == sent.loc[7, "n"] == 1000
    assert got.loc[7, "n_partners_sent"] == sent.loc[7, "p"]
    recv = pdf.groupby("target").agg(n=("source", "size"), p=("source", "nunique"))
    for t in (200, 333, 599):
        assert got.loc[t, "n_transactions_received"] == recv.loc[t, "n"]
        assert got.loc[t, "n_partners_received"] == recv.loc[t, "p"]


def test_dormant_neighbours_scan_the_ledger_once(spark):
    from ledgerlens.plans.registry import dormant_neighbours_query

    plan = executed(dormant_neighbours_query(spark, SF_SMALL))
    assert "lineitem.parquet" not in plan  # only the written pair table and what was made from it


def test_density_does_not_shuffle_values_on_the_column_name(spark):
    from ledgerlens.operators.distributions import density_curves

    df = spark.range(1000).select((F.col("id") % 50).cast("double").alias("a"), F.col("id").cast("double").alias("b"))
    plan = executed(density_curves(df, ["a", "b"], points=20)).split("Initial Plan")[0]
    assert "BroadcastHashJoin [column_name" in plan


def test_pairs_are_added_as_whole_numbers_and_joined_without_a_sort(spark):
    """No decimal in the aggregates over pairs, no generator over structs, no sort of the pairs."""
    from ledgerlens.operators.ledger import account_sides, edge_table
    from ledgerlens.operators.neighbours import dormant_partner_counts

    plan = executed(account_activity(S.ledger(spark, SF_SMALL)))
    aggregates = [ln for ln in plan.splitlines() if "partial_sum" in ln]
    assert aggregates and not any("amount#" in ln or "inline(" in ln for ln in aggregates)
    assert "inline(" not in plan
    edges = spark.range(1000).selectExpr("id % 50 source", "id % 70 target")
    plan = executed(dormant_partner_counts(account_sides(edges, payload=()), spark.range(20)))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_amount_sums_are_exact_over_the_whole_type(spark):
    from decimal import Decimal as D

    from ledgerlens.sources.schema import SYSTEM_ID, TRANSACTIONS

    top, t = D("9999999999999999.99"), None
    rows = [(1, 2, t, top), (1, 2, t, top), (1, 3, t, D("-0.01")), (1, SYSTEM_ID, t, D("-12.34")), (SYSTEM_ID, 1, t, -top),
            (SYSTEM_ID, 1, t, -top), (4, 5, t, None), (4, 1, t, D("0.05")), (4, 1, t, None)]
    df = account_activity(spark.createDataFrame(rows, TRANSACTIONS).repartition(3))
    assert {df.schema[c].dataType.simpleString() for c in df.columns if c.startswith("amount_")} == {"decimal(38,2)"}
    got = {r["id"]: r for r in df.collect()}
    one = got[1]
    assert one["amount_sent"] == 2 * top - D("12.35") and one["amount_penalties"] == D("-12.34")
    assert one["amount_received"] == -2 * top + D("0.05") and one["amount_bonuses"] == -2 * top
    assert got[4]["amount_sent"] == D("0.05") and got[4]["amount_received"] is None
    assert got[5]["amount_received"] is None and got[5]["n_partners_received"] == 1
    assert got[2]["amount_received"] == 2 * top and got[2]["amount_bonuses"] is None


def test_amounts_of_other_types_are_added_as_they_are(spark):
    rows = [(1, 2, None, 0.125), (1, 2, None, 0.5), (-1, 1, None, 4.0), (3, 1, None, None)]
    ledger = spark.createDataFrame(rows, "source long, target long, time timestamp_ntz, amount double")
    for kind, total in (("double", 0.625), ("decimal(20,3)", 0.625)):
        got = {r["id"]: r for r in account_activity(ledger.withColumn("amount", F.col("amount").cast(kind))).collect()}
        assert float(got[1]["amount_sent"]) == float(got[2]["amount_received"]) == total
        assert float(got[1]["amount_received"]) == float(got[1]["amount_bonuses"]) == 4.0
        assert got[3]["amount_sent"] is None
