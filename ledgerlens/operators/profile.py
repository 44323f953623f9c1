"""Table profiling (C6: A12-A17, F3, K2, P16-P18).

Every operator is one or two distributed aggregate passes returning a small
long-format table; nothing is collected except schema metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.moments import correlations, pair_moments
from ledgerlens.operators.quantiles import (
    approx_quantiles,
    exact_quantiles,
    quantile_columns,
    unpivot_numeric,
)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL) and f.name not in exclude]


def integer_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL)]


def string_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def census(df: DataFrame) -> DataFrame:
    """Rows, columns, rows per column and the count of integer,
    floating and string columns (one row)."""
    fields = df.schema.fields
    n_cols = len(fields)
    n_int = sum(isinstance(f.dataType, _INTEGRAL) for f in fields)
    n_float = sum(isinstance(f.dataType, _FRACTIONAL) for f in fields)
    n_str = sum(isinstance(f.dataType, T.StringType) for f in fields)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        F.lit(n_cols).cast("bigint").alias("n_columns"),
        (n / F.lit(n_cols)).alias("rows_per_column"),
        F.lit(n_int).cast("bigint").alias("n_integer_columns"),
        F.lit(n_float).cast("bigint").alias("n_float_columns"),
        F.lit(n_str).cast("bigint").alias("n_string_columns"),
    )


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column_name, n_null)`` for every column, one pass."""
    cols = cols or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], cols, "column_name", "n_null")


QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column_name, count, mean, std, min, q25, q50, q75, max)``;
    sample standard deviation, exact linear-interpolation quartiles (a
    quantile sketch with ``approx=True``)."""
    cols = cols or numeric_columns(df)
    long = unpivot_numeric(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quantiles = approx_quantiles if approx else exact_quantiles
    q = quantile_columns(quantiles(df, cols, QUARTILES), QUARTILES, ["q25", "q50", "q75"])
    return moments.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def unique_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, value)``, the distinct values of each column
    (as strings), a distributed table rather than per-column lists."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    return long.distinct()


def head(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """K2: first ``n`` rows under an explicit order (TakeOrderedAndProject)."""
    order_by = order_by or [df.columns[0]]
    return df.orderBy(*order_by).limit(n)


def outliers(df: DataFrame, cols: list[str] | None = None, n_std: float = 3.0) -> DataFrame:
    """Upper-tail outliers per column.

    ``count`` = rows *not* at or below ``mean + n_std * sd`` (NULLs count),
    ``percentage`` = count / rows rounded to 3, ``min`` = smallest value
    above the threshold.  Two passes: the moments (one row, read through
    scalar subqueries), then one aggregate with all columns.
    """
    cols = cols or numeric_columns(df)
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for c in cols:
        t = stats.select(f"m_{c}").scalar() + F.lit(n_std) * stats.select(f"s_{c}").scalar()
        x = F.col(c).cast("double")
        aggs += [(n - F.count_if(x <= t)).alias(f"c_{c}"),
                 F.min(F.when(x > t, x)).alias(f"v_{c}")]
    row = df.agg(*aggs)
    long = row.select(F.col("_n"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c_{c}").alias("count"),
                 F.col(f"v_{c}").alias("min")) for c in cols])))
    return long.select("column_name", "count",
                       F.round(F.col("count") / F.col("_n"), 3).alias("percentage"), "min")


def correlation(df: DataFrame, cols: list[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Pearson correlation for every ordered pair (diagonal included),
    pairwise-complete, ``(column_a, column_b, corr)``, from one moment table
    (``moments.pair_moments``); a constant column gives NULL instead of a
    division error."""
    one = correlations(pair_moments(df, cols or numeric_columns(df)))
    if digits is not None:
        one = one.withColumn("corr", F.round("corr", digits))
    # every row of the table is a pair and its mirror image
    both = F.array(F.struct("column_a", "column_b", "corr"),
                   F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "corr"))
    return one.select(F.inline(F.when(F.col("column_a") == F.col("column_b"), F.slice(both, 1, 1)).otherwise(both)))
