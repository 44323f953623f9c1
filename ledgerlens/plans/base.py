"""Base features (the ``p2`` stage) for a labelled population.

labels ⟕ users ⟕ account_activity, then derived columns, population-scoped
globals, the dormant flag and dormant-neighbour counts.

Global values (latest registration, earliest/latest last date, latest first
date) are fitted over the joined population, as a one-row aggregate used
through scalar subqueries: no cross join and no unpartitioned window.  The
fitted row is a value: pass another population's row as ``stats`` to score
with its statistics instead of refitting.

Null rules kept from the pipeline this reproduces:

* totals (``n_transactions``, ``n_partners``) add the raw one-sided values
  before filling, so a one-sided account ends with 0;
* ``n_partners_stage_2`` fills its terms first;
* every ratio is 0 when its denominator is 0 or NULL;
* a missing last sent date becomes the population's earliest last date
  (never-senders look longest dormant), a missing first date the latest;
* dormant means strictly more than ``stage_2_days`` days since the
  population's latest last date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import (
    days_between,
    fill0,
    fill0d,
    filled_sum,
    flag,
    fractional_days,
    null_sum,
    safe_div,
)
from ledgerlens.operators.ledger import account_sides, activity_from_sides, edge_table
from ledgerlens.operators.neighbours import dormant_partner_counts
from ledgerlens.session import materialize
from ledgerlens.sources.files import stage_handoff
from ledgerlens.sources.schema import STRING_COLUMNS

# Fixed value: days without a sent transaction after which an account is
# flagged dormant ("stage 2"); the comparison is strict.
STAGE_2_DAYS = 30

BASE_COLUMNS = [
    "n_transactions_sent", "n_transactions_received", "n_penalties", "n_bonuses",
    "n_partners_received", "n_partners_sent", "first_trx_date", "last_trx_date",
    "n_transactions", "n_partners", "registration_date", "days_before_first_trx",
    "days_from_registr", "count_intensity", "count_sent_intensity",
    "count_received_intensity", "days_past_last_trxs", "is_stage_2",
    "n_partners_received_stage_2", "n_partners_sent_stage_2", "n_partners_stage_2",
    "stage_2_partners_share", "avg_time_between_trxs",
]
AMOUNT_COLUMNS = ["amount_sent", "amount_received", "amount_bonuses", "amount_penalties"]
STAT_COLUMNS = ["max_registration_time", "min_last_trx_date", "max_first_trx_date",
                "max_last_trx_date"]


def population_stats(joined: DataFrame) -> DataFrame:
    """The fitted global values of a population (one row).

    Works on the raw join and on ``p2`` alike: the filled dates only take
    the population's own earliest last / latest first date, so the minima
    and maxima are unchanged."""
    return joined.agg(
        F.max("registration_time").alias("max_registration_time"),
        F.min("last_trx_date").alias("min_last_trx_date"),
        F.max("first_trx_date").alias("max_first_trx_date"),
        F.max("last_trx_date").alias("max_last_trx_date"),
    )


def _scalar(stats: DataFrame, name: str):
    return stats.select(name).scalar()


def base_features(labels: DataFrame, users: DataFrame, ledger: DataFrame,
                  stats: DataFrame | None = None, stage_2_days: int = STAGE_2_DAYS,
                  keep_amounts: bool = False, materialize_stages: bool = True,
                  edges: DataFrame | None = None) -> DataFrame:
    """Build ``p2``: one row per labelled id.

    ``labels`` has ``id`` and optionally ``inactive``; ``users`` follows the
    USERS schema; ``ledger`` the TRANSACTIONS schema.  With ``keep_amounts``
    the four raw amount sums ride along for the model-feature stage, so it
    needs no second ledger scan.  ``edges`` (from ``edge_table``) lets
    several populations share one written pair table.

    Stages: the ledger is scanned and shuffled once into the distinct-pair
    table, written as a parquet table in the checkpoint folder because two
    passes read it (activity, then dormant partners; the second reads only
    ``source``/``target`` and prunes the rest).  The per-account join is
    checkpointed too (keeping its hash partitioning on ``id``): the fitted
    statistics, the dormant flags and the output all read it, and without
    the cut each would re-run (and, being column-pruned differently, not
    share) the ledger aggregation.
    """
    if edges is None:
        edges = edge_table(ledger)
        if materialize_stages:
            edges = stage_handoff(edges, "edges")
    sides = account_sides(edges)
    activity = activity_from_sides(sides)
    user_cols = [c for c in users.columns if c != "id"]
    joined = labels.join(users, "id", "left").join(activity, "id", "left")
    if materialize_stages:
        joined = materialize(joined)
    if stats is None:
        stats = population_stats(joined)

    max_reg = _scalar(stats, "max_registration_time")
    min_last = _scalar(stats, "min_last_trx_date")
    max_first = _scalar(stats, "max_first_trx_date")
    max_last = _scalar(stats, "max_last_trx_date")

    sent_n, recv_n = F.col("n_transactions_sent"), F.col("n_transactions_received")
    sent_p, recv_p = F.col("n_partners_sent"), F.col("n_partners_received")
    # with another population's latest registration, an account registered after it has age 0
    age = fractional_days(max_reg, F.col("registration_time"))
    dfr = F.when(age < 0, F.lit(0.0)).otherwise(age)
    n_trx_raw = null_sum(recv_n, sent_n)
    last_filled = F.coalesce(F.col("last_trx_date"), min_last)
    days_past = days_between(max_last, last_filled)

    label_cols = [c for c in labels.columns if c != "id"]
    derived = joined.select(
        "id", *label_cols, *user_cols,
        fill0(sent_n).alias("n_transactions_sent"),
        fill0(recv_n).alias("n_transactions_received"),
        fill0("n_penalties").alias("n_penalties"),
        fill0("n_bonuses").alias("n_bonuses"),
        fill0(recv_p).alias("n_partners_received"),
        fill0(sent_p).alias("n_partners_sent"),
        F.coalesce(F.col("first_trx_date"), max_first).alias("first_trx_date"),
        last_filled.alias("last_trx_date"),
        fill0(n_trx_raw).alias("n_transactions"),
        fill0(null_sum(recv_p, sent_p)).alias("n_partners"),
        F.to_date("registration_time").alias("registration_date"),
        fill0(days_between(F.col("first_trx_date"), F.to_date("registration_time"))).alias(
            "days_before_first_trx"),
        fill0d(dfr).alias("days_from_registr"),
        safe_div(n_trx_raw, dfr).alias("count_intensity"),
        safe_div(sent_n, dfr).alias("count_sent_intensity"),
        safe_div(recv_n, dfr).alias("count_received_intensity"),
        fill0(days_past).alias("days_past_last_trxs"),
        flag(days_past > stage_2_days).alias("is_stage_2"),
        *AMOUNT_COLUMNS,
    )

    dormant = derived.where(F.col("is_stage_2") == 1).select("id")
    neighbours = dormant_partner_counts(account_sides(edges, payload=()), dormant)
    with_nb = derived.join(neighbours, "id", "left")

    recv_s2 = fill0("n_partners_received_stage_2")
    sent_s2 = fill0("n_partners_sent_stage_2")
    out = with_nb.select(
        "id", *label_cols,
        *[F.coalesce(F.col(c), F.lit("0")).alias(c) if c in STRING_COLUMNS
          else (fill0d(c).alias(c) if c == "start_balance" else F.col(c))
          for c in user_cols],
        *BASE_COLUMNS[:18],
        recv_s2.alias("n_partners_received_stage_2"),
        sent_s2.alias("n_partners_sent_stage_2"),
        filled_sum("n_partners_sent_stage_2", "n_partners_received_stage_2").alias(
            "n_partners_stage_2"),
        safe_div(filled_sum("n_partners_sent_stage_2", "n_partners_received_stage_2"),
                 F.col("n_partners")).alias("stage_2_partners_share"),
        safe_div(F.col("days_from_registr"), F.col("n_transactions")).alias(
            "avg_time_between_trxs"),
        *(AMOUNT_COLUMNS if keep_amounts else []),
    )
    return out
