"""Exact quantiles (linear interpolation) that move only the values near a wanted rank.

Spark's exact ``percentile`` keeps a value->count map per group and merges it in
one task; a sort moves every value.  Here the wanted ranks are bracketed first:

1. unpivot to ``(group..., column_name, x)``, drop NULLs; one quantile sketch for
   each group gives, for every wanted rank, a bracket of values that holds it (the
   sketch's error is bounded, and the bracket is three times as wide);
2. one more scan counts: a value inside a bracket by itself, all values between two
   brackets in one row.  Both collapse on the map side, so about ``6 / ACCURACY`` of
   the values for each wanted rank are shuffled, and a hot value is one row;
3. the counted rows are range-partitioned by ``(group..., column_name, x)`` and
   written once with their partition number; a slice is a group's part of one
   partition, so a hot group is many slices.  Running counts inside each slice and a
   table of slices (partitions + groups rows) give each slice's rank offset;
4. each wanted rank ``floor((n-1)p)``, ``ceil((n-1)p)`` is looked up in the slice
   that holds it, joined on the slice (no hot key), and interpolated.  A rank that
   falls between brackets, which the sketch's bound rules out, is found by counting
   every value by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialize

#: Relative accuracy of the sketches that bracket the wanted ranks, and a bracket's half width in units of it.
ACCURACY = 1000
MARGIN = 3
#: Tables of one row a group up to this size are broadcast to the scans; larger ones are joined as the planner likes.
BROADCAST_ROWS = 100_000


def unpivot_numeric(df: DataFrame, value_cols: list[str], group_cols: list[str] = ()) -> DataFrame:
    """``(group..., column_name, x double)`` with NULL/NaN values dropped."""
    group_cols = list(group_cols)
    proj = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = proj.unpivot(group_cols, value_cols, "column_name", "x")
    return long.where(F.col("x").isNotNull() & ~F.isnan("x"))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key; the left side's keys stay."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for c in keys:
        one = left[c].eqNullSafe(other[f"_r_{c}"])
        cond = one if cond is None else cond & one
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in keys])


def join_groups(long: DataFrame, per_group: DataFrame, keys: list[str]) -> DataFrame:
    """``long`` with the columns of a one-row-per-group table, which is written once and counted."""
    per_group = materialize(per_group)
    small = per_group.count() <= BROADCAST_ROWS
    return null_safe(long, F.broadcast(per_group) if small else per_group, keys)


def _brackets(long: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``(group..., column_name, lo, hi)``: a bracket for every probability; small groups are one bracket."""
    d = MARGIN / ACCURACY
    ends = [e for p in probs for e in (max(p - d, 0.0), min(p + d, 1.0))]
    sketch = F.percentile_approx("x", [float(e) for e in ends], ACCURACY)
    found = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), sketch.alias("q"))
    whole = F.col("n") <= 2 * ACCURACY
    below, above = F.lit(float("-inf")), F.lit(float("inf"))
    lo = [F.when(whole | F.lit(p <= d), below).otherwise(F.col("q")[2 * i]) for i, p in enumerate(probs)]
    hi = [F.when(whole | F.lit(p >= 1 - d), above).otherwise(F.col("q")[2 * i + 1]) for i, p in enumerate(probs)]
    return found.select(*keys, F.array(*lo).alias("lo"), F.array(*hi).alias("hi"))


def bracketed_counts(df: DataFrame, value_cols: list[str], probs: list[float],
                     group_cols: list[str] = ()) -> DataFrame:
    """``(group..., column_name, x, low, w)``: counted rows in the order of ``x``.

    A value in a bracket of ``probs`` is a row of its own, with ``low = x``; the values
    between two brackets are one row from ``low`` to ``x``.
    """
    keys = [*group_cols, "column_name"]
    long = unpivot_numeric(df, value_cols, list(group_cols))
    rows = join_groups(long, _brackets(long, keys, probs), keys)
    x, k = F.col("x"), range(len(probs))
    inside = F.lit(False)
    gap = F.lit(0)
    for i in k:
        inside = inside | ((x >= F.col("lo")[i]) & (x <= F.col("hi")[i]))
        gap = gap + (x > F.col("hi")[i]).cast("int")
    rows = rows.select(*keys, "x", gap.alias("gap"), F.when(inside, x).alias("own"))
    return (rows.groupBy(*keys, "gap", "own")
            .agg(F.max("x").alias("x"), F.min("x").alias("low"), F.count(F.lit(1)).alias("w"))
            .select(*keys, "x", "low", "w"))


class SortedValues:
    """Counted values of every (group, column), sorted and cut into slices: those near the ranks
    of ``probs`` by themselves and the others in sums, or with ``probs=None`` every value.

    ``values``: ``(pid, group..., column_name, x, low, w, upto)``, the running count
    ``upto`` inside the slice; ``slices``: ``(pid, group..., column_name, cnt, before, n)``.
    """

    def __init__(self, df: DataFrame, value_cols: list[str], group_cols: list[str] = (),
                 probs: list[float] | None = None):
        self.source = df, value_cols, list(group_cols)
        self.keys = [*group_cols, "column_name"]
        if probs is None:
            counted = (unpivot_numeric(df, value_cols, list(group_cols))
                       .groupBy(*self.keys, "x").agg(F.count(F.lit(1)).alias("w"))
                       .select(*self.keys, "x", F.col("x").alias("low"), "w"))
        else:
            counted = bracketed_counts(df, value_cols, probs, group_cols)
        # one range shuffle of counted rows, written once: later branches read the same slices
        ranged = materialize(counted.repartitionByRange(*self.keys, "x").select(
            "*", F.spark_partition_id().alias("pid")))
        inside = Window.partitionBy("pid", *self.keys).orderBy("x")
        self.values = ranged.select("pid", *self.keys, "x", "low", "w", F.sum("w").over(inside).alias("upto"))
        per_slice = ranged.groupBy("pid", *self.keys).agg(F.sum("w").alias("cnt"))
        group = Window.partitionBy(*self.keys)
        self.slices = materialize(per_slice.select(
            "*", (F.sum("cnt").over(group.orderBy("pid")) - F.col("cnt")).alias("before"),
            F.sum("cnt").over(group).alias("n")))

    def quantiles(self, probs: list[float]) -> DataFrame:
        """``(group..., column_name, p, value)``."""
        p_arr = F.array(*[F.lit(float(p)) for p in probs])
        h = (F.col("n") - 1).cast("double") * F.col("p")
        wanted = (self.slices.select("pid", *self.keys, "cnt", "before", "n", F.explode(p_arr).alias("p"))
                  .select("*", (h - F.floor(h)).alias("frac"), F.inline(F.array(
                      F.struct(F.floor(h).cast("long").alias("rank"), F.lit(True).alias("is_lo")),
                      F.struct(F.ceil(h).cast("long").alias("rank"), F.lit(False).alias("is_lo"))))))
        held = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("cnt"))
        local = wanted.where(held).select("pid", *self.keys, "p", "frac", "is_lo",
                                          (F.col("rank") - F.col("before")).alias("local"))
        hit = materialize(null_safe(self.values, local, ["pid", *self.keys]).where(
            (F.col("local") >= F.col("upto") - F.col("w")) & (F.col("local") < F.col("upto"))))
        if not hit.where(F.col("low") < F.col("x")).isEmpty():  # a rank between brackets
            return SortedValues(*self.source).quantiles(probs)
        both = hit.groupBy(*self.keys, "p").agg(
            F.max(F.when(F.col("is_lo"), F.col("x"))).alias("x_lo"),
            F.max(F.when(~F.col("is_lo"), F.col("x"))).alias("x_hi"), F.max("frac").alias("frac"))
        return both.select(*self.keys, "p",
                           (F.col("x_lo") + (F.col("x_hi") - F.col("x_lo")) * F.col("frac")).alias("value"))


def exact_quantiles(df: DataFrame, value_cols: list[str], probs: list[float],
                    group_cols: list[str] = ()) -> DataFrame:
    """``(group..., column_name, p, value)``: the linear-interpolation quantile
    of every value column (per group), as pandas/numpy/DuckDB
    ``quantile_cont`` define it."""
    _check(probs)
    return SortedValues(df, value_cols, list(group_cols), probs).quantiles(probs)


def approx_quantiles(df: DataFrame, value_cols: list[str], probs: list[float],
                     group_cols: list[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Same output as ``exact_quantiles`` from a mergeable quantile sketch
    per (group, column): bounded memory per group, one shuffle of sketches,
    rank error about 1/``accuracy``.  For when exact order statistics are
    not needed."""
    _check(probs)
    group_cols = list(group_cols)
    keys = [*group_cols, "column_name"]
    long = unpivot_numeric(df, value_cols, group_cols)
    arr = F.percentile_approx("x", [float(p) for p in probs], accuracy)
    return (long.groupBy(*keys).agg(arr.alias("qs"))
            .select(*keys, F.posexplode("qs").alias("k", "value"))
            .select(*keys, F.element_at(F.array(*[F.lit(float(p)) for p in probs]),
                                        F.col("k") + 1).alias("p"), "value"))


def quantile_columns(q: DataFrame, probs: list[float], names: list[str],
                     group_cols: list[str] = ()) -> DataFrame:
    """Pivot the long quantile table to one column per probability."""
    keys = [*list(group_cols), "column_name"]
    aggs = [F.max(F.when(F.abs(F.col("p") - F.lit(p)) < 1e-12, F.col("value"))).alias(n)
            for p, n in zip(probs, names)]
    return q.groupBy(*keys).agg(*aggs)


def _check(probs):
    for p in probs:
        if not (0.0 <= p <= 1.0) or math.isnan(p):
            raise ValueError(f"probability out of range: {p}")
