"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "voxledger", cores: str = "8") -> SparkSession:
    """A local session for tests and the bench; on a cluster use spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder of the cluster.

    The rows and their partitions are then fixed, so a lost executor cannot
    change partition bounds that another branch of the plan relies on.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="voxledger-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
