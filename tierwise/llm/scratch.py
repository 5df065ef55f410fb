"""Tables written to the cluster's shared folder to cut lineage.

Every table goes below ``spark.checkpoint.dir``, so a lost executor loses no
part of it. A run's folder has a name of its own and is never overwritten; it
goes when the application ends, or by the age sweep of ``sources.ledger``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierwise.sources.ledger import RunFolders


#: Bytes of texts that a Python worker is handed at once, about; a batch counts
#: in the executor's memory beside the heap, on both sides of the worker's socket.
BATCH_BYTES = 4 << 20
BATCH_CONF, SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches hold about ``BATCH_BYTES``, or one row; a limit that the session sets itself stands."""
    if spark.conf.get(BATCH_CONF) == SPARKS_OWN:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it.

    A cluster job ships the package itself (``--py-files`` or an installed
    wheel); this covers sessions whose workers run where the driver does.
    """
    bound_batches(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


class Scratch:
    """A folder of its own in the shared folder, for one run of an operator."""

    def __init__(self, spark: SparkSession, operator: str) -> None:
        workers_find_package(spark)
        self.spark = spark
        self.root = RunFolders(spark, operator).root
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once as Parquet and return it as read back."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_observed(self, df: DataFrame, name: str, sums: list[str]) -> tuple[DataFrame, list]:
        """As ``save``, with the values of aggregate expressions over the rows written."""
        seen = Observation()
        named = [F.expr(e).alias(f"o{k}") for k, e in enumerate(sums)]
        saved = self.save(df.observe(seen, *named), name)
        return saved, [seen.get[f"o{k}"] for k in range(len(sums))]
