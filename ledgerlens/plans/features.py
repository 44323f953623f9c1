"""Model features (the ``p3``/``p4`` stages) from base features.

``model_features`` is a projection of ``p2`` (which carries the raw amount
sums, see ``base_features(keep_amounts=True)``) plus two fitted values: the
min-max bounds of the nine amount columns (a one-row DataFrame read through
scalar subqueries) and the one-hot encoding (a bounded list).  Both are
refitted per population by default (parity with the pipeline this
reproduces); pass a ``FittedFeatures`` from another population to score with
its statistics instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_double, fill0d, null_sum, safe_div, safe_log
from ledgerlens.operators.encoding import SHARE_THRESHOLD, OneHotEncoding, fit_onehot
from ledgerlens.operators.scaling import fit_minmax, minmax_log_expr
from ledgerlens.sources.schema import ONEHOT_COLUMNS

# Fixed value: columns whose natural log becomes a feature (log(0) and log(<0) -> 0).
LOG_COLUMNS = [
    "start_balance", "n_transactions", "n_transactions_received", "n_transactions_sent",
    "n_bonuses", "n_partners", "n_partners_stage_2", "n_partners_received",
    "n_partners_received_stage_2", "n_partners_sent", "n_partners_sent_stage_2",
    "days_before_first_trx", "count_received_intensity", "count_sent_intensity",
    "count_intensity",
]
# Fixed value: (feature, numerator, denominator) over already-zeroed logs.
LOG_RATIOS = [
    ("n_partners_ratio_log", "n_partners_received_log", "n_partners_sent_log"),
    ("n_transactions_ratio_log", "n_transactions_received_log", "n_transactions_sent_log"),
    ("count_intensity_ratio_log", "count_received_intensity_log", "count_sent_intensity_log"),
    ("n_partners_stage_2_ratio_log", "n_partners_received_stage_2_log",
     "n_partners_sent_stage_2_log"),
]
# Fixed value: amount columns that are min-max scaled, then logged.
AMOUNT_TRANSFORM = [
    "amount_received_intensity", "amount_sent_intensity", "amount_intensity",
    "balance_growth", "amount_penalties", "amount_bonuses", "amount_total",
    "amount_sent", "amount_received",
]
KEPT_BASE = ["days_past_last_trxs", "is_stage_2", "stage_2_partners_share",
             "avg_time_between_trxs"]
MODEL_NUMERIC = (KEPT_BASE + [c + "_log" for c in LOG_COLUMNS] + [r[0] for r in LOG_RATIOS]
                 + [c + "_log" for c in AMOUNT_TRANSFORM] + ["amount_sent_receive_logratio"])

# The exploration variant keeps fewer logs and two raw categories.
EDA_LOGS = ["start_balance", "n_transactions", "n_bonuses", "n_partners", "n_partners_stage_2",
            "days_before_first_trx", "count_intensity"]
EDA_KEPT_STRINGS = ["area_type", "gender"]


@dataclass
class FittedFeatures:
    """Statistics fitted on one population, reusable on another (Q19)."""

    minmax: DataFrame
    encoding: OneHotEncoding
    columns: list[str]


def _label_cols(df: DataFrame) -> list[str]:
    return ["inactive"] if "inactive" in df.columns else []


def log_features(p2: DataFrame) -> DataFrame:
    """P14 + P8: the 15 safe logs and the 4 log-ratios, appended."""
    logs = [safe_log(c).alias(c + "_log") for c in LOG_COLUMNS]
    with_logs = p2.select("*", *logs)
    return with_logs.select("*", *[safe_div(num, den).alias(name)
                                   for name, num, den in LOG_RATIOS])


def amount_features(df: DataFrame) -> DataFrame:
    """A6/A7-derived amounts: totals (null-propagating), intensities
    (zero-safe), then NULL -> 0 for all nine."""
    sent = F.col("amount_sent")
    recv = F.col("amount_received")
    dfr = F.col("days_from_registr")
    total = null_sum(sent, recv)
    growth = as_double("start_balance") + as_double(recv) - as_double(sent)
    exprs = {
        "amount_received_intensity": safe_div(recv, dfr),
        "amount_sent_intensity": safe_div(sent, dfr),
        "amount_intensity": safe_div(total, dfr),
        "balance_growth": fill0d(growth),
        "amount_penalties": fill0d("amount_penalties"),
        "amount_bonuses": fill0d("amount_bonuses"),
        "amount_total": fill0d(total),
        "amount_sent": fill0d(sent),
        "amount_received": fill0d(recv),
    }
    others = [c for c in df.columns if c not in exprs]
    return df.select(*others, *[e.alias(c) for c, e in exprs.items()])


def _prepared(p2: DataFrame) -> DataFrame:
    return amount_features(log_features(p2))


def fit_model_features(p2: DataFrame, threshold: float = SHARE_THRESHOLD) -> FittedFeatures:
    prepared = _prepared(p2)
    minmax = fit_minmax(prepared, AMOUNT_TRANSFORM)
    encoding = fit_onehot(p2, ONEHOT_COLUMNS, threshold)
    return FittedFeatures(minmax, encoding, MODEL_NUMERIC + encoding.names)


def model_features(p2: DataFrame, fitted: FittedFeatures | None = None,
                   with_dummies: bool = True) -> DataFrame:
    """C2 (and C3 on another population): ``id``, the label if present, the
    33 numeric features and the dummies."""
    if fitted is None:
        fitted = (fit_model_features(p2) if with_dummies else
                  FittedFeatures(fit_minmax(_prepared(p2), AMOUNT_TRANSFORM), OneHotEncoding(),
                                 list(MODEL_NUMERIC)))
    prepared = _prepared(p2)
    scaled = prepared.select(
        "*", *[minmax_log_expr(c, fitted.minmax).alias(c + "_log") for c in AMOUNT_TRANSFORM])
    scaled = scaled.select(
        "*", safe_div("amount_sent_log", "amount_received_log").alias(
            "amount_sent_receive_logratio"))
    cols = ["id", *_label_cols(p2), *MODEL_NUMERIC]
    if not with_dummies:
        return scaled.select(*cols)
    encoded = fitted.encoding.transform(scaled.select(*cols, *ONEHOT_COLUMNS))
    return encoded.select(*cols, *fitted.encoding.names)


def align_to(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select a trained model's columns by name; fail on any absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for alignment: {missing}")
    return df.select(*columns)


def eda_features(p2: DataFrame) -> DataFrame:
    """The exploration variant (logs and log-ratios, two raw category
    columns kept, no amounts)."""
    f = log_features(p2)
    cols = ["id", *_label_cols(p2), *EDA_KEPT_STRINGS, *KEPT_BASE,
            *[c + "_log" for c in EDA_LOGS], *[r[0] for r in LOG_RATIOS]]
    return f.select(*cols)
