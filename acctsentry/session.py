"""Session helpers: one place for the configuration the engine relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine needs for exact results (UTC clock fields) and for
# runtime re-planning (AQE: size-checked broadcast, skew-join splitting,
# partition coalescing).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffle files go when the query that wrote them has ended: what is read again is
    # checkpointed, and jobs of many small steps would else hold all their shuffles at once.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows may be long texts: a batch is bounded by bytes before it is by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def get_spark(master: str | None = None, app: str = "acctsentry", **conf) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        # checkpoint files go with the frames that they belong to
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **ENGINE_CONF, **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the engine settings that an existing session lets change."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``. Where it is unset, a session that runs
    in one JVM (tests, a laptop) gets a temporary folder; on a cluster, where
    executors would not share such a folder, this raises ``ValueError``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="acctsentry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
