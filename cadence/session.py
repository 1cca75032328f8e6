"""Session helpers: the settings every job of this package relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the engine needs on any cluster. Month and day buckets are computed
# in the session time zone, so it is pinned to UTC (the solution files store
# naive timestamps).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# What bounds a task, whatever the input: a task aggregates in memory the rows of one split of the
# fact, or of one shuffle partition. Splits and joined-up partitions are made no larger than this, and
# a shuffle starts with no fewer partitions than this, nor than this for each split of the fact (adaptive
# execution joins small ones), so a larger input means more tasks. A session that asks for smaller ones,
# or more, keeps them.
SPLIT_BYTES = 8 << 20
PARTITION_BYTES = 4 << 20
SHUFFLE_PARTS, PARTS_A_SPLIT = 400, 4
SPLITS, PARTS, FIRST_PARTS = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
JOINED_UP = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cadence") -> SparkSession:
    """Session for tests and local runs. On a cluster use the one you have and
    call :func:`configure`."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CADENCE_DRIVER_MEMORY", "16g"))
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    bound_tasks(spark)
    checkpoint_dir(spark)
    return spark


def bound_tasks(spark: SparkSession, splits: int = 0) -> None:
    """Splits of at most SPLIT_BYTES, shuffles of at least SHUFFLE_PARTS partitions and PARTS_A_SPLIT
    for each of the fact's ``splits``, joined up to at most PARTITION_BYTES."""
    for key, most in ((SPLITS, SPLIT_BYTES), (JOINED_UP, PARTITION_BYTES)):
        if in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    parts = max(SHUFFLE_PARTS, PARTS_A_SPLIT * splits)
    if int(spark.conf.get(FIRST_PARTS, spark.conf.get(PARTS))) < parts:
        spark.conf.set(FIRST_PARTS, str(parts))


def in_bytes(size: str) -> int:
    """A size as Spark's settings write it: 64MB, 8m, 128k, 1024b or a plain number of bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)(?:i?b)?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts. The cluster's ``spark.checkpoint.dir``
    wins; a scratch folder is only made on a local master when none is set
    (tests). Elsewhere a missing folder is an error: machine-local cuts would lose rows."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir is not set: {sc.master} needs a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="cadence-ckpt-")
    sc.setCheckpointDir(local)
    return local
