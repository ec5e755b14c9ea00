from __future__ import annotations

import os
import time
from types import SimpleNamespace

import pytest

from orderloom.plans.catalog import all_queries
from orderloom.session import clear_staged, folder_exists, fresh_path, scratch, shared_folder, shuffle_settings, staged


class Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def session(master, **conf):
    return SimpleNamespace(conf=Settings(conf), sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_folder_named_by_the_cluster_is_used():
    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_own_folder_in_local_mode_only():
    own = shared_folder(session("local[2]"))
    assert os.path.isdir(own) and shared_folder(session("local[2]")) == own
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))


def test_paths_are_fresh():
    spark = session("yarn", **{"spark.checkpoint.dir": "/shared"})
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_staged_keeps_rows_and_types(spark):
    df = spark.sql("select 1 as a, cast('1.50' as decimal(5,2)) as b, cast(null as timestamp_ntz) as c")
    copy = staged(df, "copy")
    assert copy.dtypes == df.dtypes and copy.collect() == df.collect()


def test_staged_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr("orderloom.session._application_folder", lambda s: f"{shared_folder(s)}/cleared")
    path = fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert folder_exists(spark, path)
    clear_staged(spark)
    assert not folder_exists(spark, path)


def test_scratch_is_removed_when_a_job_ends(spark):
    with pytest.raises(KeyError), scratch(spark):
        inside = fresh_path(spark, "inside")
        spark.range(3).write.parquet(inside)
        with scratch(spark):
            staged(spark.range(2), "shared")
        assert folder_exists(spark, inside)
        raise KeyError
    assert not folder_exists(spark, inside)


def test_shuffles_are_removed_as_each_query_ends(spark, tmp_path):
    def shuffled():
        disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = disks.getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {name for name in names if name.startswith("shuffle_")}

    df = spark.range(10_000).groupBy("id").count()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting)
    with scratch(spark):
        df.write.parquet(f"{tmp_path}/inside")
        # The query is still held; only the end of its run can have removed them.
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.1)
        assert not shuffled() - before
    assert spark.conf.get(setting) == was
    df.write.parquet(f"{tmp_path}/again")
    assert spark.read.parquet(f"{tmp_path}/again").count() == 10_000


def test_partitions_grow_with_the_shuffle():
    small, large = shuffle_settings(1 << 30, 8), shuffle_settings(10 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert int(large["spark.sql.shuffle.partitions"]) == 52429


def test_shared_results_follow_the_tables(spark, tmp_path):
    """A table that is replaced in the session gives the new answer."""
    for name in ("orders", "lineitem", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    names = ["clean_orders", "discount_impact", "nightly_daily"]
    before = {name: all_queries()[name](spark, str(tmp_path)).collect() for name in names}
    assert {name: all_queries()[name](spark, str(tmp_path)).collect() for name in names} == before
    few = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(100)
    few.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    after = {name: all_queries()[name](spark, str(tmp_path)).collect() for name in names}
    assert all(len(after[name]) < len(before[name]) or after[name] != before[name] for name in names)
    assert 0 < len(after["clean_orders"]) <= 100
