"""Session construction and lineage cutting.

The library itself never changes session settings; ``get_session`` is for
tests and the bench alone.  Jobs take the session that the platform gives them
(``SparkSession.builder.getOrCreate()``), whose ``spark.checkpoint.dir`` names a
shared, reliable folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens") -> SparkSession:
    """Build (or fetch) a session tuned for the ledger workload.

    AQE stays on so that join strategy, partition coalescing and skewed
    partitions are re-planned from runtime statistics.  Nothing is broadcast
    by hand: the planner broadcasts a side only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    master = master or os.environ.get("LEDGERLENS_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LEDGERLENS_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove the files of checkpointed stages once they are unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read
    from the session.  Only a local-mode session without that setting (a
    bare test session) gets a scratch folder; on a cluster the setting is
    required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared, reliable folder for "
                "lineage cuts (a machine-local folder would be lost with its executor)")
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the reliable checkpoint folder.

    Used at the stage hand-off between base and model features: the base
    table is read several times (fit statistics, category shares, the final
    projection) and must not re-run the ledger aggregation each time, nor be
    lost with an executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
