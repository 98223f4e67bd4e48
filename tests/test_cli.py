"""The command-line flows write their outputs (run in a subprocess)."""

import os
import subprocess
import sys

from conftest import SF001

from salesguard.sources import sinks

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_range_flow_writes_versions(spark, scratch):
    cmd = [sys.executable, "-m", "salesguard", "range", "--data", SF001, "--out", scratch,
           "--as-of", "2001-08-01", "--days", "2405", "--master", "local[2]"]
    for _ in range(2):
        subprocess.run(cmd, cwd=REPO, check=True, capture_output=True, timeout=600)
    v0, v1 = (sinks.read_table(spark, f"{scratch}/ranges", v) for v in (0, 1))
    assert v0.count() == v1.count() > 0
    assert set(v1.columns) == {"facility_id", "item_id", "min", "max", "updated_at"}
    assert spark.read.parquet(f"{scratch}/errors").count() > 0


def run(flow, out, *more):
    cmd = [sys.executable, "-m", "salesguard", flow, "--data", SF001, "--out", out, "--master", "local[2]", *more]
    subprocess.run(cmd, cwd=REPO, check=True, capture_output=True, timeout=900)


def test_report_flow_writes_csv(spark, scratch):
    run("report", f"{scratch}/report", "--as-of", "2001-08-01", "--days", "2405")
    got = spark.read.option("header", True).csv(f"{scratch}/report")
    assert "cannibalization_flag" in got.columns and got.count() > 0


def test_spikes_flow_looks_back_from_today_by_default(spark, scratch):
    run("spikes", f"{scratch}/all", "--as-of", "2001-08-01", "--days", "2405")
    assert spark.read.parquet(f"{scratch}/all").count() > 0
    run("spikes", f"{scratch}/now")                        # the test tables end in 2001
    assert not [f for f in os.listdir(f"{scratch}/now") if f.startswith("l2_category=")]
