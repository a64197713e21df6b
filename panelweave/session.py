"""Session settings the operators rely on.

Two settings matter to every ordered operator:

* ``spark.panelweave.maxGroupRows`` - how many rows of one series a single task
  may be handed. Longer series are cut into pieces (see ``operators.timeline``).
* ``spark.checkpoint.dir`` - the shared folder for checkpoints and scratch tables.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

GROUP_ROWS = "spark.panelweave.maxGroupRows"
BROADCAST_BYTES = "spark.panelweave.maxBroadcastBytes"
DEFAULT_GROUP_ROWS = 5_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def local_session(name: str = "panelweave", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session for laptops, tests and the benchmark. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def group_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS, str(DEFAULT_GROUP_ROWS)))


def broadcast_byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES, str(DEFAULT_BROADCAST_BYTES)))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where none is set: a temporary one in local mode, else an error.

    In local mode driver and executors are one process on one disk. Anywhere else executors
    would write to their own disks, so the folder has to be named.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelweave-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a table that must be written once."""
    return f"{shared_folder(spark)}/panelweave/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Checkpoint, so that several readers see one physical layout and lineage is cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder as Parquet and read back.

    Like ``pin`` this cuts lineage; readers also prune columns and push filters, and the size is that of
    the files, where a checkpoint keeps the estimate of the plan it cut, which grows with every join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
