"""Session helpers.

A cluster job gets its session (and its shared checkpoint folder) from the
platform; only local runs and tests create one here.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

from .sources.files import delete_at_exit

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tierwise") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIERWISE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a cluster this setting comes from the platform and is only read here.
    When it is unset (a local run or a test) a fresh folder is created and
    registered, which is only valid because local mode has one machine; it goes when
    the application ends.
    """
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="tierwise-shared-")
        delete_at_exit(spark, path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path
