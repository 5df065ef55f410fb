"""Folders for tables that live no longer than a run (S3).

The reference's temporary tables end with its session. Here a run's tables lie in a
folder of its own in the cluster's shared folder, where every executor finds them.
The folder goes when the run closes it, else when the application ends; what a
killed application leaves is swept by age.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import SparkSession

from ..session import shared_dir
from . import files

BASE = "tierwise-runs"
OWNER = "owner.json"


def base(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{BASE}"


class RunFolders:
    """One run's folder, to be used as a context or closed by hand."""

    def __init__(self, spark: SparkSession, kind: str) -> None:
        self.spark = spark
        self.root = f"{base(spark)}/{kind}-{uuid.uuid4().hex}"
        files.create_new(spark, f"{self.root}/{OWNER}", json.dumps({
            "kind": kind, "application": spark.sparkContext.applicationId,
            "started": dt.datetime.now(dt.timezone.utc).isoformat()}))
        files.delete_at_exit(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def close(self) -> None:
        """Removes the folder with all its tables; frames that read them can't be used any more."""
        files.delete(self.spark, self.root)

    def __enter__(self) -> RunFolders:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def owned(spark: SparkSession) -> dict[str, float]:
    """Folder name -> hours since its run began, for every run that left or still holds one."""
    out = {}
    for name in files.listed(spark, base(spark)):
        began = files.listed(spark, f"{base(spark)}/{name}").get(OWNER)
        if began is not None:
            out[name] = (time.time() - began) / 3600
    return out


def sweep(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Removes the folders of runs that began longer ago; returns their names.

    The age must exceed the longest run, as a run that still works is not told
    apart from one that was killed."""
    gone = sorted(name for name, hours in owned(spark).items() if hours >= older_than_hours)
    for name in gone:
        files.delete(spark, f"{base(spark)}/{name}")
    return gone
