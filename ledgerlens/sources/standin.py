"""Stand-in ledger inputs over the driver's TPC-H-style test tables.

The three inputs (labelled accounts, account profiles, transactions) are
derived from ``customer``, ``nation``, ``region``, ``orders`` and ``lineitem``
as plain projections and joins, so every query built on them grows with the
tables.  Customers and parts are treated as one account space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.schema import SYSTEM_ID

# Fixed values of the stand-in definition.
LABEL_CUTOFF = "2001-01-01 00:00:00"     # orders on/after this mark an active account
REGISTRATION_EPOCH = "1995-01-01 00:00:00"
REGISTRATION_DAY_SPREAD = 700            # registration day offset = id % 700
REGISTRATION_HOUR_SPREAD = 24            # registration hour offset = id % 24
SPLIT_MODULUS = 5                        # test population: id % 5 = 0, train: the rest


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cutoff() -> Column:
    return F.lit(LABEL_CUTOFF).cast("timestamp_ntz")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions ``(source, target, time, amount)``.

    Quantity 1 lines are bonuses paid by the system to the customer,
    quantity 2 lines are penalties paid by the customer to the system, the
    rest are payments from the customer to the even part id.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = (_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderdate")
              .where(F.col("o_orderdate") < _cutoff()))
    j = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    q = F.col("l_quantity")
    system = F.lit(SYSTEM_ID).cast("bigint")
    source = F.when(q == 1, system).otherwise(F.col("o_custkey"))
    target = (F.when(q == 1, F.col("o_custkey"))
              .when(q == 2, system)
              .otherwise(F.col("l_partkey") - F.col("l_partkey") % 2))
    return j.select(
        source.cast("bigint").alias("source"),
        target.cast("bigint").alias("target"),
        F.col("o_orderdate").alias("time"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )


def account_labels(spark: SparkSession, sf_dir: str, population: str = "all") -> DataFrame:
    """Labelled accounts ``(id, inactive)``: inactive = no order on/after the
    cut-off.  ``population`` is ``all``, ``train`` or ``test``."""
    cust = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    late = (_table(spark, sf_dir, "orders")
            .where(F.col("o_orderdate") >= _cutoff())
            .select(F.col("o_custkey").alias("id"))
            .distinct()
            .withColumn("_late", F.lit(1)))
    labels = cust.join(late, "id", "left").select(
        "id", F.col("_late").isNull().cast("int").alias("inactive"))
    return _split(labels, population)


def population_ids(spark: SparkSession, sf_dir: str, population: str = "test") -> DataFrame:
    """Unlabelled population ``(id)``, as the test-set file carries it."""
    cust = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return _split(cust, population)


def _split(df: DataFrame, population: str) -> DataFrame:
    if population == "all":
        return df
    is_test = (F.col("id") % SPLIT_MODULUS) == 0
    if population == "test":
        return df.where(is_test)
    if population == "train":
        return df.where(~is_test)
    raise ValueError(f"unknown population {population!r}")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account profiles in the USERS schema."""
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    r = _table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    reg = (F.lit(REGISTRATION_EPOCH).cast("timestamp_ntz")
           + F.make_dt_interval((key % REGISTRATION_DAY_SPREAD).cast("int"),
                                (key % REGISTRATION_HOUR_SPREAD).cast("int")))
    gender = (F.when(key % 10 < 5, "male")
              .when(key % 10 < 9, "female")
              .otherwise("unknown"))
    j = (c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
         .join(r, n["n_regionkey"] == r["r_regionkey"], "inner"))
    return j.select(
        key.alias("id"),
        F.col("c_acctbal").cast("double").alias("start_balance"),
        reg.cast("timestamp_ntz").alias("registration_time"),
        F.lit("individual").alias("account_type"),
        F.col("c_mktsegment").alias("business_type"),
        F.col("n_name").alias("area_name"),
        F.col("r_name").alias("area_type"),
        gender.alias("gender"),
    )
