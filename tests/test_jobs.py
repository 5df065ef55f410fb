"""The command-line jobs end to end on the sf0.001 binding."""

import os
import tempfile

import pytest

from tierwise import jobs
from tierwise.plans import monthly as M
from tierwise.sources.ledger import owned

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")


def test_refresh_then_reports(spark):
    root = tempfile.mkdtemp(prefix="tw-jobs-")
    common = ["--as-of", "1998-07-15", "--root", f"{root}/snap", "--sf-dir", SF]
    jobs.main(["refresh", *common])
    jobs.main(["refresh", *common, "--keep-runs", "1"])
    assert len(os.listdir(f"{root}/snap/runs")) == 1
    jobs.main(["dashboard", *common, "--out", f"{root}/dash"])
    jobs.main(["period-report", *common, "--out", f"{root}/period", "--customer", "CUST_A",
               "--start", "1998-06-01", "--end", "1998-06-30", "--format", "csv"])
    before = set(owned(spark))
    jobs.main(["workbook", *common, "--out", f"{root}/wb", "--customer", "CUST_A"])
    assert set(owned(spark)) == before
    jobs.main(["sweep", "--older-than-hours", "1000"])
    assert set(owned(spark)) == before
    jobs.main(["dashboard", *common, "--out", f"{root}/all", "--month", "all"])
    assert M.snapshot(spark, f"{root}/snap")["topics"].count() == 200
    assert spark.read.parquet(f"{root}/all/dash_tobacco_focus").count() == 5
    assert spark.read.parquet(f"{root}/dash/dash_tobacco_focus").count() == 5
    assert spark.read.option("header", "true").csv(f"{root}/period/kpi_headlines").count() == 4
    assert spark.read.parquet(f"{root}/wb/out_validation_counts").count() == 8
