"""Spark session helpers.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only reads ``spark.checkpoint.dir`` from it. A local scratch folder is set only
when the session runs in local mode and the setting is absent (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "boreflow", partition_bytes: str | None = None
) -> SparkSession:
    """A local session configured the way tests and the bench expect.

    ``partition_bytes`` sets the AQE advisory partition size and the file
    split size together; size it to the data (e.g. ``"8m"`` for a few
    hundred MB on 8 cores, ``"256m"`` at terabytes).
    """
    builder = SparkSession.builder
    if partition_bytes:
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", partition_bytes).config(
            "spark.sql.files.maxPartitionBytes", partition_bytes
        )
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session
    without that setting gets a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder shared by all executors"
            )
        path = tempfile.mkdtemp(prefix="boreflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
