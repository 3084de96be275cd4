"""Line numbers of split files, by the block table and by counting."""

from __future__ import annotations

import gzip
import os

import pytest

from logspark.session import scratch_path
from logspark.sources import logfiles


@pytest.fixture
def folder(spark):
    """Files of which some are split into many blocks, one is empty, one is compressed and one lies deeper."""
    path = scratch_path(spark, "logs")
    os.makedirs(f"{path}/deep")
    sizes = {"a.log": 5000, "b.log": 1, "c.log": 0, "deep/d.log": 3000}
    for name, n in sizes.items():
        with open(f"{path}/{name}", "w") as f:
            f.writelines(f"{name} line {i} {'x' * (i % 50)}\n" for i in range(n))
    with gzip.open(f"{path}/e.log.gz", "wt") as f:
        f.writelines(f"e.log line {i}\n" for i in range(400))
    return path


@pytest.fixture
def many_blocks(spark):
    """Blocks of 4 KiB, several of them in a task."""
    wanted = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "512"}
    before = {k: spark.conf.get(k) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("max_blocks", [logfiles.MAX_BLOCKS, 0])
def test_offsets_are_the_line_numbers(spark, folder, many_blocks, max_blocks):
    rows = logfiles.read_logs(spark, folder, "k", max_blocks).collect()
    assert len(rows) == 8401
    for r in rows:
        name, _, number = r["value"].split(" ")[:3]
        assert int(number) == r["offset"] and name.split("/")[-1].split(".")[0] in r["path"]


@pytest.mark.parametrize("max_blocks", [logfiles.MAX_BLOCKS, 0])
def test_lines_are_scanned_once_more_and_never_shuffled(spark, folder, many_blocks, max_blocks):
    plan = logfiles.read_logs(spark, folder, max_blocks=max_blocks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "SortMergeJoin" not in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1


def test_an_empty_folder_has_no_lines(spark):
    path = scratch_path(spark, "none")
    os.makedirs(path)
    assert logfiles.read_logs(spark, path).count() == 0
