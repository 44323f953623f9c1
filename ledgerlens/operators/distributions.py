"""Distribution tables (C7: D1-D7), the data behind the exploration charts.

Nothing is drawn; every operator returns a small aggregate table computed
in one or two distributed passes.  Pairwise operators are one job for all
pairs and mirror their result to ordered pairs: trend lines come from a
moment table, 2-D histograms from counted vectors of bins.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.encoding import category_counts
from ledgerlens.operators.moments import lines, pair_moments
from ledgerlens.operators.quantiles import (
    approx_quantiles,
    exact_quantiles,
    join_groups,
    quantile_columns,
    unpivot_numeric,
)
from ledgerlens.session import materialize

# Density grid size, box whisker factor, Scott's rule exponent.
DENSITY_POINTS = 500
# exp(-z*z/2) is exactly 0.0 in double precision for |z| > 38.6, so kernel
# terms beyond this many bandwidths contribute nothing and are not emitted.
KERNEL_REACH = 40.0
# Width of a cell of the fast Gauss transform, in bandwidths.
CELL = 0.5
WHISKER_IQR = 1.5
SCOTT_EXPONENT = -0.2
HIST2D_BINS = 20


def category_histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, value, n)`` per string column."""
    return category_counts(df, cols)


def _unordered_pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def crosstab_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_a, value_a, column_b, value_b, n)`` for every ordered
    pair of distinct columns."""
    structs = [F.struct(F.lit(a).alias("column_a"), F.col(a).cast("string").alias("value_a"),
                        F.lit(b).alias("column_b"), F.col(b).cast("string").alias("value_b"))
               for a, b in _unordered_pairs(cols)]
    counts = (df.select(F.inline(F.array(*structs)))
              .groupBy("column_a", "value_a", "column_b", "value_b")
              .agg(F.count(F.lit(1)).alias("n")))
    mirrored = counts.select(F.col("column_b").alias("column_a"), F.col("value_b").alias("value_a"),
                             F.col("column_a").alias("column_b"), F.col("value_a").alias("value_b"),
                             "n")
    return counts.unionByName(mirrored)


def gauss_terms(error: float) -> int:
    """Moments per cell that keep every kernel within ``error`` of its value.

    A kernel exp(-(s - t)^2 / 2) is the sum of He_k(s) exp(-s^2 / 2) t^k / k!, with t the value's
    and s the grid point's distance from the cell's centre in bandwidths.  Cramer's inequality
    bounds the k-th term by 1.0865 |t|^k / sqrt(k!), and |t| is at most half a cell.
    """
    if not 0 < error < 1:
        raise ValueError(f"error must lie between 0 and 1: {error}")
    tail = [1.0865 * (CELL / 2) ** k / math.sqrt(math.factorial(k)) for k in range(60)]
    return next(k for k in range(1, 60) if sum(tail[k:]) <= error)


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients of He_0, He_1, ... by the powers of s."""
    rows = [[1], [0, 1]]
    while len(rows) < terms:
        k = len(rows) - 1
        up, low = [0, *rows[k]], [*rows[k - 1], 0, 0]
        rows.append([u - k * v for u, v in zip(up, low)])
    return rows[:terms]


def _cell_sums(values: DataFrame, stats: DataFrame, points: int, error: float) -> DataFrame:
    """``(column_name, i, s)``: kernel sums at the grid points from each cell's moments."""
    terms = gauss_terms(error)
    width = F.lit(CELL) * F.col("h")
    at = values.join(F.broadcast(stats), "column_name").withColumn(
        "cell", F.floor((F.col("x") - F.col("mn")) / width))
    centre = F.col("mn") + (F.col("cell") + F.lit(0.5)) * width
    t = (F.col("x") - centre) / F.col("h")
    moments = at.select("column_name", "cell", t.alias("t")).groupBy("column_name", "cell").agg(
        *[F.sum(F.pow("t", F.lit(float(k))) / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k in range(terms)])
    he = _hermite(terms)
    powers = [sum((F.col(f"m{k}") * F.lit(float(he[k][j])) for k in range(j, terms) if he[k][j]), F.lit(0.0)).alias(f"p{j}")
              for j in range(terms)]
    step = (F.col("mx") - F.col("mn")) / F.lit(points)
    reach = F.lit(KERNEL_REACH + CELL) * F.col("h")
    first = F.greatest(F.ceil((F.col("c") - reach - F.col("mn")) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("c") + reach - F.col("mn")) / step), F.lit(points - 1)).cast("int")
    grid = (moments.join(F.broadcast(stats), "column_name").select("column_name", "mn", "mx", "h", centre.alias("c"), *powers)
            .select("*", F.explode(F.when(first <= last, F.sequence(first, last))).alias("i"))
            .withColumn("z", (F.col("mn") + F.col("i") * step - F.col("c")) / F.col("h")))
    value = F.col(f"p{terms - 1}")
    for j in range(terms - 2, -1, -1):
        value = value * F.col("z") + F.col(f"p{j}")
    return grid.groupBy("column_name", "i").agg(F.sum(value * F.exp(F.lit(-0.5) * F.col("z") * F.col("z"))).alias("s"))


def density_curves(df: DataFrame, cols: list[str], points: int = DENSITY_POINTS,
                   bins: int | None = None, bandwidth: float | None = None,
                   cells_above: int | None = None, error: float = 1e-9) -> DataFrame:
    """D3: Gaussian kernel density per numeric column on ``points`` grid
    points from min (inclusive) to max (exclusive), NULLs dropped.

    Bandwidth: Scott's rule ``sd * n^(-1/5)`` (sample sd) unless given.
    Exact by default: the kernel sum runs over distinct values weighted by
    their count; each value is expanded (no join) to the grid points within
    ``KERNEL_REACH`` bandwidths, beyond which a Gaussian term underflows to
    exactly 0.0, so the sums are those of the full grid.  The bandwidth
    shrinks like n^(-1/5), so the expansion per value shrinks as the data
    grows.  With ``bins`` the values are first snapped to ``bins``
    equal-width bin centres, bounding the work per column whatever the row
    count (an approximation).

    With ``cells_above``, columns with more distinct values than that (as a
    distinct-count sketch estimates them) use a fast Gauss transform: one scan
    adds up a few moments for each cell of half a bandwidth, on the map side, and
    only cells are expanded to the grid.  A density then differs from the exact one
    by at most ``error / (h sqrt(2 pi))``, that is ``error`` of a single kernel's
    height, beside rounding.
    """
    long = unpivot_numeric(df, cols)
    stats = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("mn"), F.max("x").alias("mx"),
        *([] if cells_above is None else [F.approx_count_distinct("x").alias("distinct")]))
    if bandwidth is None:
        h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(SCOTT_EXPONENT))
    else:
        h = F.lit(float(bandwidth))
    stats = stats.select("*", h.alias("h"))
    if bins:
        width = (F.col("mx") - F.col("mn")) / F.lit(bins)
        b = F.least(F.floor((F.col("x") - F.col("mn")) / width), F.lit(bins - 1))
        centre = F.when(width > 0, F.col("mn") + (b + F.lit(0.5)) * width).otherwise(F.col("mn"))
        values = (long.join(F.broadcast(stats.select("column_name", "mn", "mx")), "column_name")
                  .select("column_name", centre.alias("x")))
    else:
        values = long
    every, by_cells = stats, None
    if cells_above is not None:
        every = stats = materialize(stats)  # one row for each column
        many = (F.col("distinct") > cells_above) & (F.col("h") > 0) & (F.col("mx") > F.col("mn"))
        by_cells = _cell_sums(values, stats.where(many), points, error)
        stats = stats.where(~F.coalesce(many, F.lit(False)))
        values = values.join(F.broadcast(stats.select("column_name")), "column_name", "left_semi")
    weights = values.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("w"))
    step = (F.col("mx") - F.col("mn")) / F.lit(points)
    reach = F.lit(KERNEL_REACH) * F.col("h")
    lo_i = F.greatest(F.ceil((F.col("x") - reach - F.col("mn")) / step), F.lit(0))
    hi_i = F.least(F.floor((F.col("x") + reach - F.col("mn")) / step), F.lit(points - 1))
    bounded = (step > 0) & (F.col("h") > 0)
    first = F.when(bounded, lo_i).otherwise(F.lit(0)).cast("int")
    last = F.when(bounded, hi_i).otherwise(F.lit(points - 1)).cast("int")
    grid = F.explode(F.when(first <= last, F.sequence(first, last))
                     .otherwise(F.array().cast("array<int>"))).alias("i")
    # one row for each column of the schema: bounded whatever the data, so the large side is not shuffled
    expanded = weights.join(F.broadcast(stats), "column_name").select("column_name", "x", "w", "n", "h",
                                                         "mn", "mx", grid)
    gx = F.col("mn") + F.col("i") * (F.col("mx") - F.col("mn")) / F.lit(points)
    z = (gx - F.col("x")) / F.col("h")
    kern = F.col("w") * F.exp(F.lit(-0.5) * z * z)
    sums = expanded.groupBy("column_name", "i").agg(F.sum(kern).alias("s"))
    # every grid point, including those no value reaches (density 0)
    if by_cells is not None:
        sums = sums.unionByName(by_cells)
    full = every.select("column_name", "n", "h", "mn", "mx",
                        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2.0 * math.pi))
    return (full.join(sums, ["column_name", "i"], "left")
            .select("column_name", "i", gx.alias("x"),
                    F.try_divide(F.coalesce(F.col("s"), F.lit(0.0)), norm).alias("density")))


BOX_PROBS = [0.25, 0.5, 0.75]


def box_stats(df: DataFrame, cols: list[str], group_cols: list[str] = (),
              approx: bool = False) -> DataFrame:
    """D4 (and D7 with ``group_cols``): quartiles (linear; a quantile sketch
    with ``approx=True``), IQR, fences at 1.5 IQR, whiskers (most extreme
    values inside the fences), outlier count, min, max and count, per column
    (per group)."""
    group_cols = list(group_cols)
    keys = [*group_cols, "column_name"]
    quantiles = approx_quantiles if approx else exact_quantiles
    q = quantile_columns(quantiles(df, cols, BOX_PROBS, group_cols), BOX_PROBS, ["q1", "median", "q3"], group_cols)
    iqr = F.col("q3") - F.col("q1")
    q = q.select(*keys, "q1", "median", "q3", iqr.alias("iqr"),
                 (F.col("q1") - F.lit(WHISKER_IQR) * iqr).alias("lower_fence"),
                 (F.col("q3") + F.lit(WHISKER_IQR) * iqr).alias("upper_fence"))
    x = F.col("x")
    inside_lo = x >= F.col("lower_fence")
    inside_hi = x <= F.col("upper_fence")
    of_group = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"]
    # one more scan against the fences; every group is one row of each task
    rows = join_groups(unpivot_numeric(df, cols, group_cols), q, keys)
    return rows.groupBy(*keys, *of_group).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.min(F.when(inside_lo, x)).alias("whisker_low"),
        F.max(F.when(inside_hi, x)).alias("whisker_high"),
        F.count_if(~(inside_lo & inside_hi)).alias("n_outliers"),
    ).select(*keys, "n", "min", "q1", "median", "q3", "max", "iqr", "lower_fence", "upper_fence",
             "whisker_low", "whisker_high", "n_outliers")


def box_stats_by_category(df: DataFrame, cat_cols: list[str], num_cols: list[str]) -> DataFrame:
    """``box_stats`` of every numeric column within each value of each
    categorical column: ``(category_column, category_value, column_name, ...)``."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cat_cols], *num_cols).unpivot(
        num_cols, cat_cols, "category_column", "category_value")
    return box_stats(long, num_cols, ["category_column", "category_value"])


def hist2d(df: DataFrame, cols: list[str], bins: int = HIST2D_BINS) -> DataFrame:
    """``(column_a, column_b, bin_a, bin_b, n)`` for every ordered pair:
    ``bins`` equal-width bins over each column's [min, max], the last edge
    closed; a constant column has one bin.  A row counts for a pair if both
    values are present (neither NULL nor NaN).

    Counted in two levels: rows collapse to distinct vectors of bins first
    (most of a skewed table falls into few of them), and only counted vectors
    are expanded to pairs."""
    x = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols}
    bounds = df.agg(*[F.min(x[c]).alias(f"mn_{i}") for i, c in enumerate(cols)],
                    *[F.max(x[c]).alias(f"mx_{i}") for i, c in enumerate(cols)])
    binned = []
    for i, c in enumerate(cols):
        mn = bounds.select(f"mn_{i}").scalar()
        mx = bounds.select(f"mx_{i}").scalar()
        pos = F.floor(F.try_divide(x[c] - mn, mx - mn) * F.lit(bins))
        binned.append(F.when(x[c].isNotNull(), F.least(F.coalesce(pos, F.lit(0)), F.lit(bins - 1))).cast("int"))
    vectors = df.select(F.array(*binned).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col("v")[i].alias("bin_i"), F.col("v")[j].alias("bin_j"))
                      for i in range(len(cols)) for j in range(i + 1, len(cols))])
    counts = (vectors.select("w", F.inline(pairs)).where(F.col("bin_i").isNotNull() & F.col("bin_j").isNotNull())
              .groupBy("i", "j", "bin_i", "bin_j").agg(F.sum("w").alias("n")))
    names = F.array(*[F.lit(c) for c in cols])
    return counts.select(F.inline(F.array(*[
        F.struct(F.get(names, F.col(a)).alias("column_a"), F.get(names, F.col(b)).alias("column_b"),
                 F.col(f"bin_{a}").alias("bin_a"), F.col(f"bin_{b}").alias("bin_b"), "n")
        for a, b in (("i", "j"), ("j", "i"))])))


def trend_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Ordinary least squares of ``column_y`` on ``column_x`` for every
    ordered pair: ``(column_x, column_y, n, slope, intercept, r2)``,
    pairwise-complete rows, from one moment table (``moments.pair_moments``);
    a constant x gives NULL slope."""
    return lines(pair_moments(df, cols))
