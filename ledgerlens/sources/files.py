"""File scans and sinks.

CSV is read with a declared schema (inference would scan the data twice and
guess types per file).  Sinks overwrite, with a header and without any index
column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expr import replace_inf
from ledgerlens.session import checkpoint_dir


# Texts that mean "no value" in the input files.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV scan with a declared schema.

    The fields are read as text, the usual null tokens become NULL, and the rest
    is cast to the declared types: a text that does not fit its type fails the
    read.  Infinite numbers become 0 (P13); timestamps take a space or ``T`` and an
    optional fraction."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(path)
    cols = []
    for f in schema.fields:
        value = F.when(~F.trim(F.col(f.name)).isin(NULL_TOKENS), F.col(f.name))
        if not isinstance(f.dataType, T.StringType):
            value = F.trim(value).cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = replace_inf(value)
        cols.append(value.alias(f.name))
    return raw.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV sink, overwrite, one file per task (no coalesce(1))."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def stage_folder(spark: SparkSession) -> str:
    """Where this application's stages lie, below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stages/{spark.sparkContext.applicationId}"


def stage_handoff(df: DataFrame, name: str) -> DataFrame:
    """S3: materialise a stage as a parquet table in the shared checkpoint
    folder and read it back, so later phases start from the written table
    (survives executor loss, cuts lineage)."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    return spark.read.parquet(path)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder's files as they are, over what ``target`` holds."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    a, b = path(source), path(target)
    b.getFileSystem(conf).delete(b, True)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def remove_stages(spark: SparkSession) -> None:
    """Remove this application's stages; for the owner of the run, once its results are written."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
