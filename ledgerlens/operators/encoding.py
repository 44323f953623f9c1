"""Share-thresholded one-hot encoding (E1, E2) and category shares.

Rule: a value gets a 0/1 column named by the raw value only if its share of
the column is strictly above ``threshold``; if *every* value of a column
passes, the least frequent one (ties: smallest value) is dropped as the
baseline.  Columns are processed in order and a later column's dummy
replaces an equally named earlier one.

The fit is one distributed aggregation over the unpivoted columns; only the
passing values reach the driver, at most ``floor(1/threshold)`` per column,
so the collected list is bounded whatever the data size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: minimum share (exclusive) for a category to get a dummy.
SHARE_THRESHOLD = 0.1


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, value, n)`` for every value of every column; NULLs
    are not a category."""
    return (_long(df, cols).where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def category_shares(df: DataFrame, cols: list[str], threshold: float = SHARE_THRESHOLD) -> DataFrame:
    """A9-A11 as a table: ``(column_name, value, n, share, kept, baseline)``.

    ``kept``: share > threshold.  ``baseline``: the value dropped because
    every value of its column is kept and it is the least frequent
    (count asc, value asc).  Per-column totals and the least frequent value
    come from an aggregate (``min`` over a ``(count, value)`` struct), not a
    window, so a column with many values is not one task.
    """
    counts = category_counts(df, cols)
    per_col = counts.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.min(F.struct("n", "value")).alias("least"),
    )
    share = F.col("n") / F.col("total")
    all_pass = (F.col("least.n") / F.col("total")) > threshold
    return counts.join(per_col, "column_name").select(
        "column_name", "value", "n",
        share.alias("share"),
        (share > threshold).alias("kept"),
        (all_pass & (F.col("value") == F.col("least.value"))).alias("baseline"),
    )


@dataclass
class OneHotEncoding:
    """Fitted encoding: ordered ``(dummy name, source column, value)``."""

    dummies: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [d[0] for d in self.dummies]

    def transform(self, df: DataFrame) -> DataFrame:
        """Append the dummy columns (a same-named column is replaced)."""
        names = set(self.names)
        keep = [F.col(c) for c in df.columns if c not in names]
        dummies = [F.when(F.col(col) == F.lit(val), F.lit(1)).otherwise(F.lit(0)).alias(name)
                   for name, col, val in self.dummies]
        return df.select(*keep, *dummies)


def fit_onehot(df: DataFrame, cols: list[str], threshold: float = SHARE_THRESHOLD) -> OneHotEncoding:
    """E1 + E2 fit.  Collects only kept values (bounded by the threshold)."""
    if not 0 < threshold < 1:
        raise ValueError(f"share threshold out of range: {threshold}")
    rows = (category_shares(df, cols, threshold)
            .where(F.col("kept"))
            .select("column_name", "value", "n", "baseline")
            .collect())
    by_col: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        by_col[r["column_name"]].append(r)
    current: dict[str, tuple[str, str]] = {}
    for c in cols:
        ranked = sorted(by_col[c], key=lambda r: (-r["n"], r["value"]))
        for r in ranked:
            current.pop(r["value"], None)      # a later column's dummy replaces it
            current[r["value"]] = (c, r["value"])
        for r in ranked:
            if r["baseline"]:
                current.pop(r["value"], None)
    return OneHotEncoding([(name, col, val) for name, (col, val) in current.items()])


def full_dummies(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                 values: dict[str, list[str]] | None = None, min_share: float | None = None) -> DataFrame:
    """One 0/1 column per value, named ``<column>_<value>``.

    The values are declared in ``values`` or are those with a share of at least
    ``min_share`` of their column (at most 1 / ``min_share`` of them reach the
    driver); one of the two must be given, since a column for every distinct
    value of an arbitrary column has no bound.  A value below ``min_share`` is
    an error, not silently left out."""
    keep = keep if keep is not None else [c for c in df.columns if c not in cols]
    if values is None:
        if not min_share or not 0 < min_share <= 1:
            raise ValueError("full_dummies needs declared values or 0 < min_share <= 1")
        shares = category_shares(df, cols, 0.0)
        rare = shares.where(F.col("share") < min_share).groupBy("column_name").count().collect()
        if rare:
            raise ValueError("values below min_share in " + ", ".join(f"{r[0]} ({r[1]})" for r in rare))
        found = shares.select("column_name", "value").orderBy("column_name", "value").collect()
        values = {c: [r["value"] for r in found if r["column_name"] == c] for c in cols}
    dummies = [F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}")
               for c in cols for v in values[c]]
    return df.select(*[F.col(c) for c in keep], *dummies)
