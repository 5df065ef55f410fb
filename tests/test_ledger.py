"""Run folders: removed on close, at the end of the application, and by age."""

import os
import subprocess
import sys

import pytest

from tierwise.plans import monthly as M
from tierwise.sources import files
from tierwise.sources.binding import load_sources
from tierwise.sources.ledger import RunFolders, base, owned, sweep

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_closed_run_leaves_no_folder(spark):
    with RunFolders(spark, "test") as run:
        spark.range(3).write.parquet(run.path("t"))
        assert spark.read.parquet(run.path("t")).count() == 3
        assert os.path.basename(run.root) in owned(spark)
    assert not files.exists(spark, run.root)


def test_folders_are_swept_by_age(spark):
    run = RunFolders(spark, "killed")
    name = os.path.basename(run.root)
    assert name not in sweep(spark, 1) and files.exists(spark, run.root)
    others = set(owned(spark)) - {name}
    assert name in sweep(spark, owned(spark)[name]) and not files.exists(spark, run.root)
    for other in others & set(owned(spark)):
        assert files.exists(spark, f"{base(spark)}/{other}")


@pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")
def test_a_finished_workbook_leaves_no_folder(spark):
    import datetime as dt
    out = M.run_adhoc(load_sources(spark, SF), dt.date(1998, 7, 15))
    assert M.workbook(out)["out_validation_counts"].count() == 8
    assert files.exists(spark, out["_folders"].root)
    M.close_adhoc(out)
    assert not files.exists(spark, out["_folders"].root)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")
def test_a_finished_query_leaves_no_folder(tmp_path):
    """The tables of a query end with its application."""
    code = f"""
import os, sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
import __spark_entry__ as E
assert E.queries()["src_calls"](spark, {SF!r}).count() > 0
assert E.queries()["enrolled_population"](spark, {SF!r}).count() > 0
assert os.listdir({str(tmp_path)!r} + "/tierwise-runs")
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    assert os.listdir(tmp_path / "tierwise-runs") == []
