"""Packing many small values into one row for each bucket and task, for cheap shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Values that a task gathers before it writes them out as rows.
FLUSH = 2_000_000


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def even_keys(spark: SparkSession, n: int) -> np.ndarray:
    """Bucket numbers that hash partitioning deals to n partitions one by one: entry i goes to partition i."""
    keys = np.full(n, -1, np.int64)
    upto = 16 * n
    while (keys < 0).any():  # n numbers at most are kept
        where = spark.range(upto).select(F.col("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"))
        for p, first in where.groupBy("p").agg(F.min("id")).collect():
            keys[p] = first
        upto *= 4
    return keys


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a bucket together in one partition, one bucket after another."""
    return df.repartition(partitions(df.sparkSession), "bucket").sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each bucket, from batches in which a bucket's rows follow each other."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now:
                if rows:
                    yield now, rows
                now, rows = row["bucket"], []
            rows.append(row)
    if rows:
        yield now, rows


def parts(keys: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted bucket numbers."""
    cut = np.searchsorted(keys, np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), int(cut[b]), int(cut[b + 1])
