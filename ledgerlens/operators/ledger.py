"""Ledger aggregation: every per-account count, partner count, date and
amount from one scan and two shuffles.

Plan shape
----------
1. ``edge_table``: ``groupBy(source, target)`` -> one row per distinct
   directed pair with its count, amount, first and last date.  The partial
   (map-side) aggregate collapses a hot pair before the shuffle, and hashing
   on the pair spreads a hot account (the system account, a hub) over all
   reducers.  Amounts are added as two whole numbers each (``amount_parts``):
   exact as decimal sums, without their cost in every row of both aggregates.
2. ``account_sides``: each pair is emitted once for its source (sent side)
   and once for its target (received side).
3. ``account_activity``: ``groupBy(account)`` with conditional aggregates.
   Because pairs are already distinct, "distinct partners" is a plain count;
   no ``countDistinct`` (which would add an Expand or a second exchange) is
   needed.  Map-side partial aggregation leaves at most one row per account
   per map task, so a hot account costs one row per task in the shuffle.

The same ``edge_table`` feeds the dormant-neighbour pass.  The branches
prune different columns, so Spark cannot share their shuffles; the base
feature plan therefore writes the edge table to the checkpoint folder and
the ledger is scanned once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.schema import SYSTEM_ID, TRANSACTIONS

# Fixed value: an amount of c hundredths is held as (c >> 30, c & (2**30 - 1)).  Both parts of a
# decimal(18,2) stay below 2**30, so their bigint sums hold for 2**33 rows of any amounts.
LOW_BITS = 30
AMOUNT_PARTS = ("amount_high", "amount_low")


def amount_parts(ledger: DataFrame) -> DataFrame:
    """The ledger with ``amount`` as ``amount_high``, ``amount_low``, both NULL for no amount; an
    amount of another type than TRANSACTIONS declares stays as it is."""
    if ledger.schema["amount"].dataType != TRANSACTIONS["amount"].dataType:
        return ledger
    hundredths = (F.col("amount") * 100).cast("bigint")
    parts = (F.shiftright("_hundredths", LOW_BITS), F.col("_hundredths").bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    others = [c for c in ledger.columns if c != "amount"]
    return (ledger.select(*others, hundredths.alias("_hundredths"))
            .select(*others, *[e.alias(c) for c, e in zip(AMOUNT_PARTS, parts)]))


def _amount_columns(df: DataFrame) -> list[str]:
    return [c for c in ("amount", *AMOUNT_PARTS) if c in df.columns]


def amount_sum(cond: Column, columns: list[str]) -> Column:
    """The exact sum of the amounts of the rows that ``cond`` holds for, NULL if there are none."""
    if columns == ["amount"]:
        return F.sum(F.when(cond, F.col("amount")))
    high, low = (F.sum(F.when(cond, F.col(c))).cast("decimal(20,0)") for c in AMOUNT_PARTS)
    total = high * F.lit(Decimal(1 << LOW_BITS) / 100) + low * F.lit(Decimal("0.01"))
    return total.cast("decimal(38,2)")


def edge_table(ledger: DataFrame) -> DataFrame:
    """Distinct directed pairs ``(source, target, n, amount_high, amount_low,
    first_date, last_date)``."""
    rows = amount_parts(ledger.select("source", "target", F.to_date("time").alias("date"), "amount"))
    return (rows.groupBy("source", "target")
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(c).alias(c) for c in _amount_columns(rows)],
                 F.min("date").alias("first_date"),
                 F.max("date").alias("last_date")))


def account_sides(edges: DataFrame, payload: tuple[str, ...] | None = None) -> DataFrame:
    """Each distinct pair seen from both ends:
    ``(account, partner, is_sent, *payload)``, with every further column of the
    pair table unless ``payload`` names those wanted.  Only the flag comes out of the
    generator; the pair's columns pass beside it, packed into no structs."""
    if payload is None:
        payload = tuple(c for c in edges.columns if c not in ("source", "target"))
    both = edges.select("source", "target", *payload, F.explode(F.array(F.lit(True), F.lit(False))).alias("is_sent"))
    sent = F.col("is_sent")
    return both.select(F.when(sent, F.col("source")).otherwise(F.col("target")).alias("account"),
                       F.when(sent, F.col("target")).otherwise(F.col("source")).alias("partner"),
                       "is_sent", *payload)


# Output columns of account_activity, NULL where the account has no row on
# that side (the feature plans rely on these NULLs, see plans/base.py).
ACTIVITY_COLUMNS = [
    "n_transactions_sent", "n_transactions_received", "n_penalties", "n_bonuses",
    "n_partners_received", "n_partners_sent", "first_trx_date", "last_trx_date",
    "amount_sent", "amount_received", "amount_bonuses", "amount_penalties",
]


def activity_from_sides(sides: DataFrame) -> DataFrame:
    sent = F.col("is_sent")
    recv = ~sent
    system = F.col("partner") == SYSTEM_ID
    n, amounts = F.col("n"), _amount_columns(sides)
    one = F.lit(1).cast("bigint")
    return sides.groupBy(F.col("account").alias("id")).agg(
        F.sum(F.when(sent, n)).alias("n_transactions_sent"),
        F.sum(F.when(recv, n)).alias("n_transactions_received"),
        F.sum(F.when(sent, F.when(system, n).otherwise(0))).alias("n_penalties"),
        F.sum(F.when(recv, F.when(system, n).otherwise(0))).alias("n_bonuses"),
        F.sum(F.when(recv, one)).alias("n_partners_received"),
        F.sum(F.when(sent, one)).alias("n_partners_sent"),
        F.min(F.when(sent, F.col("first_date"))).alias("first_trx_date"),
        F.max(F.when(sent, F.col("last_date"))).alias("last_trx_date"),
        amount_sum(sent, amounts).alias("amount_sent"),
        amount_sum(recv, amounts).alias("amount_received"),
        amount_sum(recv & system, amounts).alias("amount_bonuses"),
        amount_sum(sent & system, amounts).alias("amount_penalties"),
    )


def account_activity(ledger: DataFrame) -> DataFrame:
    """A1-A7 fused: per account (every account in the ledger, the system
    account included) the sent/received counts, penalties (per source),
    bonuses (per target), distinct partners both ways, first/last sent date
    and the four amount sums.  Amounts are exact decimals."""
    return activity_from_sides(account_sides(edge_table(ledger)))
