"""Session, checkpoint and scratch-path helpers.

Library code never invents storage locations on a cluster: lineage is cut with
``DataFrame.checkpoint`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting (a
test run) gets a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(app: str = "sharelens", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by tests, bench and the driver entry point."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the running context or from ``spark.checkpoint.dir``.  When
    neither is set, a local-mode session gets a fresh temporary folder; any
    other master raises, because a machine-local folder is not visible to the
    executors of a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a folder shared by all executors"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sharelens-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), eager so the next plan starts here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` that also returns the row count, observed during the
    checkpoint job itself (no second job)."""
    obs = Observation()
    out = cut_lineage(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return out, int(obs.get["n"])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, next to the shared checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/sharelens-tables/{name}-{uuid.uuid4().hex[:12]}"
