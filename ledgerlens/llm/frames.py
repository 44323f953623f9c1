"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.sources.files import stage_folder

# Fixed value: the white space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables of a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def without(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns of ``df`` that do not clash (in any letter case) with ``names``."""
    taken = {n.lower() for n in names}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in used:
        n += 1
        name = f"{stem}_{n}"
    return name


def shared_folder(spark: SparkSession, stem: str) -> str:
    """A new folder name among the application's stages, which the driver and all executors share
    (``sources.files.remove_stages`` removes them)."""
    return f"{stage_folder(spark)}/{stem}-{uuid.uuid4().hex}"


def staged(df: DataFrame, stem: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage is cut and
    what follows reads only the columns it needs, also after executors are lost."""
    path = shared_folder(df.sparkSession, stem)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame) -> DataFrame:
    """``df``, small beside what its tasks work on, spread over as few tasks as its size asks for
    (adaptive execution on).  A file that is written costs time and, on local disks, the launch of
    processes beside the executor, however few its rows."""
    return df.hint("rebalance")


def sha256_hex(c: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(c.cast("binary"), 256)
