"""Pairwise moments of many columns from one pass, the base of correlation and trend lines.

For k columns there are k(k+1)/2 pairs, each over the rows in which both values
are present.  Instead of a row for every (row, pair), a task multiplies the
matrix of its rows with itself: with X the values (missing ones 0) and M the
presence marks, ``M'M`` counts the pairs' rows, ``X'M`` holds their sums,
``(X*X)'M`` their squares and ``X'X`` their products.  A task emits one row for
each pair; these are added up in a hash aggregate keyed by the pair.

Values are measured from their column's mean (two one-row scalar subqueries a
column, merged by Spark), so the sums do not cancel; the exact least and
largest value of either side within a pair tell a constant column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = ["n", "n_inf", "s_a", "s_b", "q_a", "q_b", "p"]
_ENDS = ["min_a", "max_a", "min_b", "max_b"]


class _Gram:
    """The moments of all pairs of one task's rows."""

    def __init__(self, k: int):
        self.sums = {name: np.zeros((k, k)) for name in ("n", "n_inf", "s", "q", "p")}
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)

    def add(self, x: np.ndarray) -> None:
        present = ~np.isnan(x)
        endless = np.isinf(x)
        m = present.astype(np.float64)
        v = np.where(present & ~endless, x, 0.0)
        self.sums["n"] += m.T @ m
        if endless.any():
            e = endless.astype(np.float64)
            self.sums["n_inf"] += e.T @ m + m.T @ e
        self.sums["s"] += v.T @ m
        self.sums["q"] += (v * v).T @ m
        self.sums["p"] += v.T @ v
        # ends of column i over the rows in which column j is present
        low, high = np.where(present, x, np.inf), np.where(present, x, -np.inf)
        full = present.all(axis=0)
        self.low[:, full] = np.minimum(self.low[:, full], low.min(axis=0)[:, None])
        self.high[:, full] = np.maximum(self.high[:, full], high.max(axis=0)[:, None])
        for j in np.flatnonzero(~full):
            rows = present[:, j]
            if rows.any():
                self.low[:, j] = np.minimum(self.low[:, j], low[rows].min(axis=0))
                self.high[:, j] = np.maximum(self.high[:, j], high[rows].max(axis=0))

    def rows(self) -> pa.RecordBatch:
        i, j = np.triu_indices(len(self.low))
        s, q = self.sums["s"], self.sums["q"]
        found = {"i": i.astype(np.int32), "j": j.astype(np.int32), "n": self.sums["n"][i, j], "n_inf": self.sums["n_inf"][i, j],
                 "s_a": s[i, j], "s_b": s[j, i], "q_a": q[i, j], "q_b": q[j, i], "p": self.sums["p"][i, j],
                 "min_a": self.low[i, j], "max_a": self.high[i, j], "min_b": self.low[j, i], "max_b": self.high[j, i]}
        return pa.RecordBatch.from_arrays([pa.array(a) for a in found.values()], names=list(found))


def pair_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_a, column_b, n, mean_a, mean_b, m2_a, m2_b, c_ab)`` for every unordered pair of
    ``cols`` in their order, a column with itself included.

    Over the ``n`` rows in which both values are present (neither NULL nor NaN): the means, the sums of
    squared deviations and the sum of their products.  A side that is constant has a sum of exactly 0.
    Pairs with an infinite value have NaN moments, pairs without rows NULL ones.  One row of ``df`` is
    one row until the aggregate, which gets at most one row for each (task, pair).
    """
    k = len(cols)
    if not k:
        raise ValueError("no columns")
    x = [F.col(f"`{c}`").cast("double") for c in cols]
    finite = [F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v) for v in x]
    centre = df.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(f"m{i}") for i, v in enumerate(finite)])
    means = [centre.select(f"m{i}").scalar() for i in range(k)]
    shifted = df.select(*[(v - m).alias(f"x{i}") for i, (v, m) in enumerate(zip(x, means))])

    def multiply(batches):
        gram = _Gram(k)
        for batch in batches:
            if batch.num_rows:
                gram.add(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]))
        yield gram.rows()

    schema = "i int, j int, " + ", ".join(f"{c} double" for c in [*_SUMS, *_ENDS])
    total = shifted.mapInArrow(multiply, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in _ENDS])

    names = F.array(*[F.lit(c) for c in cols])
    shift = F.array(*means)
    n = F.col("n")
    nan = F.col("n_inf") > 0

    def mean(side, index):
        return F.when(nan, F.lit(float("nan"))).otherwise(F.try_divide(F.col(f"s_{side}"), n) + F.get(shift, F.col(index)))

    def squares(side):
        inside = F.greatest(F.col(f"q_{side}") - F.col(f"s_{side}") * F.try_divide(F.col(f"s_{side}"), n), F.lit(0.0))
        constant = F.col(f"min_{side}") == F.col(f"max_{side}")
        return F.when(nan, F.lit(float("nan"))).when(n > 0, F.when(constant, F.lit(0.0)).otherwise(inside))

    product = F.when(nan, F.lit(float("nan"))).when(n > 0, F.col("p") - F.col("s_a") * F.try_divide(F.col("s_b"), n))
    return total.select(
        F.get(names, F.col("i")).alias("column_a"), F.get(names, F.col("j")).alias("column_b"), n.cast("bigint").alias("n"),
        mean("a", "i").alias("mean_a"), mean("b", "j").alias("mean_b"),
        squares("a").alias("m2_a"), squares("b").alias("m2_b"), product.alias("c_ab"))


def correlations(moments: DataFrame) -> DataFrame:
    """``(column_a, column_b, corr)`` of a moment table; NULL for fewer than two rows or a constant side."""
    return moments.select("column_a", "column_b", F.when(F.col("n") > 1, F.try_divide(
        F.col("c_ab"), F.sqrt("m2_a") * F.sqrt("m2_b"))).alias("corr"))


def lines(moments: DataFrame) -> DataFrame:
    """``(column_x, column_y, n, slope, intercept, r2)``: least squares of every column on every other,
    from a moment table.  A constant x has no line; a constant y is met exactly (r2 is 1)."""

    def one(x, y):
        m2_x, m2_y = F.col(f"m2_{x}"), F.col(f"m2_{y}")
        slope = F.try_divide(F.col("c_ab"), m2_x)
        r2 = F.when(m2_x == 0, None).when(m2_y == 0, F.lit(1.0)).otherwise(
            F.try_divide(F.col("c_ab") * F.col("c_ab"), m2_x * m2_y))
        return F.struct(F.col(f"column_{x}").alias("column_x"), F.col(f"column_{y}").alias("column_y"), "n", slope.alias("slope"),
                        (F.col(f"mean_{y}") - slope * F.col(f"mean_{x}")).alias("intercept"), r2.alias("r2"))

    pairs = moments.where((F.col("column_a") != F.col("column_b")) & (F.col("n") > 0))
    return pairs.select(F.inline(F.array(one("a", "b"), one("b", "a"))))
