from types import SimpleNamespace

import pytest

from clickbasin import session
from clickbasin.session import RUNTIME_SETTINGS, pin, scratch_path, small_frame
from clickbasin.sources.storage import glob


def stub(master, checkpoint_dir=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: checkpoint_dir),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_written_tables_go_to_the_shared_folder():
    path = scratch_path(stub("yarn", "s3a://shared/checkpoints/"), "raw")
    assert path.startswith("s3a://shared/checkpoints/clickbasin/app-1/raw-")
    assert path != scratch_path(stub("yarn", "s3a://shared/checkpoints/"), "raw")


def test_only_a_local_session_may_use_this_machine():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(stub("yarn"), "raw")
    assert "/clickbasin/app-1/raw-" in scratch_path(stub("local[4]"), "raw")


def test_pin_changes_a_foreign_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    pin(spark)
    assert {key: spark.conf.get(key) for key in RUNTIME_SETTINGS} == RUNTIME_SETTINGS


def test_small_frames_are_local_and_broadcast_by_size(spark):
    frame = small_frame(spark, [("a", 1), (None, None)], "name string, n int")
    assert [tuple(r) for r in frame.collect()] == [("a", 1), (None, None)]
    joined = spark.range(10).selectExpr("CAST(id AS STRING) AS name").join(frame, "name")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan
    assert small_frame(spark, [], "name string").isEmpty()


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert glob(spark, path)
    session.clear_scratch(spark)
    assert not glob(spark, path)
