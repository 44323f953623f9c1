"""Min-max scaling followed by a safe log, with fitted bounds.

``fit_minmax`` returns a one-row DataFrame of bounds (a value that can be
reused to score another population); ``minmax_log_expr`` reads it through
scalar subqueries, which Spark merges into a single subquery job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_double, minmax_log


def fit_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(as_double(c)).alias(f"min_{c}"), F.max(as_double(c)).alias(f"max_{c}")]
    return df.agg(*aggs)


def minmax_log_expr(c: str, bounds: DataFrame):
    lo = bounds.select(f"min_{c}").scalar()
    hi = bounds.select(f"max_{c}").scalar()
    return minmax_log(F.col(c), lo, hi)
