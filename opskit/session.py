"""Session helpers: durable intermediate results in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a fresh folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would be lost
    together with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="opskit-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there (lineage is cut)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Even out rows over the configured number of shuffle partitions (not coalesced again)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, inside the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
