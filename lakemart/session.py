"""Session profiles (K17) and shared-storage scratch locations.

Profiles only set configuration; they never hard-code cluster sizes
beyond what a profile name promises.  Local test sessions keep the UI off
and use few shuffle partitions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Profiles: name -> Spark conf.  "cluster" is what a large deployment wants:
# AQE re-plans joins/partition counts at runtime and splits skewed partitions.
PROFILES: dict[str, dict[str, str]] = {
    "local": {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    },
    "cluster": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.shuffle.partitions": "4000",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.enabled": "false",
        # checkpointed aggregates/frontiers are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    },
    # ---- fixed values: the reference's tuned single-host profile -------------
    "tuned": {
        "spark.executor.instances": "2",
        "spark.executor.cores": "8",
        "spark.executor.memory": "14g",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "100",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    },
    "streaming": {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    },
}


def build_session(profile: str = "local", master: str | None = None,
                  app_name: str = "lakemart", **conf: str) -> SparkSession:
    """Build (or reuse) a session from a named profile plus overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(PROFILES[profile])
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (tests, a laptop) do we create a local
    one and register it, so later ``checkpoint()`` calls use it too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/lakemart/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one testdata-style parquet table ``{sf_dir}/{name}.parquet``, listed anew."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
