"""Dormant neighbours (C4: J3 + A4 + P7 + P8).

For each account, the number of distinct counterparties that are flagged
dormant *and* belong to the labelled population: senders into the account
(received side) and receivers from it (sent side).

Plan: the two-sided distinct-pair table is semi-joined with the flagged ids
on ``partner``, then counted per account.  The pairs are already distinct, so
the count is a distinct count without ``countDistinct``.  The flagged side is
one id per account; both sides shuffle on ``partner``, each task hashes its
share of the flagged ids, so the pairs need no sort, and AQE splits a skewed
(hub) partner partition.  The system account, the
hottest partner of all (every bonus and penalty), is never a population
member and is removed from both sides before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ledger import account_sides, edge_table
from ledgerlens.sources.schema import SYSTEM_ID


def dormant_partner_counts(sides: DataFrame, flagged_ids: DataFrame) -> DataFrame:
    """``(id, n_partners_received_stage_2, n_partners_sent_stage_2)``, NULL
    where the account has no flagged partner on that side."""
    flagged = (flagged_ids.select(F.col("id").alias("partner"))
               .where(F.col("partner") != SYSTEM_ID)
               .hint("shuffle_hash"))
    hits = (sides.select("account", "partner", "is_sent")
            .where(F.col("partner") != SYSTEM_ID)
            .join(flagged, "partner", "left_semi"))
    one = F.lit(1).cast("bigint")
    return hits.groupBy(F.col("account").alias("id")).agg(
        F.sum(F.when(~F.col("is_sent"), one)).alias("n_partners_received_stage_2"),
        F.sum(F.when(F.col("is_sent"), one)).alias("n_partners_sent_stage_2"),
    )


def dormant_neighbours(ledger: DataFrame, flags: DataFrame, flag_col: str = "is_stage_2",
                       edges: DataFrame | None = None) -> DataFrame:
    """Public form over a raw ledger and a ``(id, flag)`` table of the
    population: counts of flagged partners per account, 0-filled, with their
    total and share of all partners left to the caller.  ``edges`` is the ledger's
    pair table where the caller has it already."""
    flagged = flags.where(F.col(flag_col) == 1).select("id")
    return dormant_partner_counts(account_sides(edge_table(ledger) if edges is None else edges, payload=()), flagged)
