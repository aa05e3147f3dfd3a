"""Loads are seen whole or not at all, whatever step a try breaks off at."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators import loads, tracking
from tidegate.sources import hadoop


def rows(spark, low, high):
    reason = F.when(F.col("id") % 5 == 0, "a fifth")
    return spark.range(low, high).select("id", F.col("id").cast("string").alias("text"), reason.alias("reject_reason"))


def seen(spark, path, status="loaded"):
    found = loads.read_loaded(spark, path, status)
    return None if found is None else sorted((r["id"], r["load_id"]) for r in found.collect())


def states(spark, log):
    return [
        r.to_state
        for r in sorted(tracking.read_log(spark, log).collect(), key=lambda r: (r.occurred_at, r.event_id))
    ]


def test_loads_add_up_and_are_kept(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    files = spark.createDataFrame([("s3://in/a", "j"), ("s3://in/a", "j")], "file_path string, job_id string")
    assert seen(spark, path) is None
    one = loads.load(rows(spark, 0, 10), "T", path, "one/1", files, log)
    assert (one.loaded_records, one.rejected_records, one.load_id) == (8, 2, "one/1")
    assert seen(spark, path) == [(i, "one/1") for i in range(10) if i % 5]
    assert seen(spark, path, "rejected") == [(0, "one/1"), (5, "one/1")]
    loads.load(rows(spark, 10, 13), "T", path, "002")
    assert seen(spark, path)[-2:] == [(11, "002"), (12, "002")] and len(seen(spark, path)) == 10
    again = loads.load(rows(spark, 50, 90), "T", path, "one/1", files, log)
    assert again == one and len(seen(spark, path)) == 10
    assert states(spark, log) == ["LOADING", "LOADED", "COMPLETED"]
    assert spark.read.parquet(one.rejected_path).count() == 2


@pytest.mark.parametrize("step", ["write", "count", "publish"])
def test_a_crash_shows_nothing(spark, tmp_path, monkeypatch, step):
    """Readers see the loads before; the next try publishes and clears what was left."""
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    files = spark.createDataFrame([("s3://in/a", "j")], "file_path string, job_id string")
    loads.load(rows(spark, 0, 4), "T", path, "first")
    before = seen(spark, path)
    if step == "write":
        bad = rows(spark, 4, 40).withColumn("text", F.when(F.col("id") > 30, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
        with pytest.raises(Exception, match="no"):
            loads.load(bad, "T", path, "second", files, log)
    else:
        with monkeypatch.context() as patch:
            name = "put_marker" if step == "publish" else "children"
            def broken(*args):
                raise RuntimeError("gone")
            patch.setattr(hadoop if step == "publish" else loads, name if step == "publish" else "_any_column", broken)
            with pytest.raises(RuntimeError, match="gone"):
                loads.load(rows(spark, 4, 40), "T", path, "second", files, log)
    assert seen(spark, path) == before and states(spark, log) == ["LOADING"]
    done = loads.load(rows(spark, 4, 8), "T", path, "second", files, log)
    assert done.loaded_records == 3
    assert seen(spark, path) == sorted([*before, (4, "second"), (6, "second"), (7, "second")])
    assert len(hadoop.children(spark, f"{path}/tries/load_id=second")) == 1
    assert states(spark, log)[-2:] == ["LOADED", "COMPLETED"]


def test_nothing_to_load(spark, tmp_path):
    path = str(tmp_path / "t")
    done = loads.load(rows(spark, 0, 0), "T", path, "empty")
    assert (done.loaded_records, done.rejected_records) == (0, 0)
    loads.load(rows(spark, 0, 3), "T", path, "some")
    assert seen(spark, path) == [(1, "some"), (2, "some")]
