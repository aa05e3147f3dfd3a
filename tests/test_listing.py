"""Listing by tasks, looking up named files, and announcements that come again."""

import json
import os

import pytest

from tidegate.options import Config, Mapping
from tidegate.plans.batch import BatchOptions
from tidegate.sources import inventory, listing
from tidegate.streaming import arrivals

NAMES = ("a.csv", "x/b.csv", "x/y/c d%20é.csv", "x/y/z/empty.csv", "w/1.csv", "w/2.csv", "_log/h.csv", "x/.p.crc")


@pytest.fixture
def tree(tmp_path):
    for i, name in enumerate(NAMES):
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("" if "empty" in name else "x" * (i + 1))
    return tmp_path / "in"


@pytest.mark.parametrize("tasks", [1, 3, 200])
def test_every_file_is_listed_once(spark, tree, tasks):
    shown = [n for n in NAMES if not n.startswith("_") and "/." not in n]
    df = listing.list_tree(spark, str(tree), tasks)
    rows = df.collect()
    assert sorted(r.key for r in rows) == sorted(f"{tree}/{n}".lstrip("/") for n in shown)
    assert {r.path: r.size for r in rows} == {f"file://{tree}/{n}": (tree / n).stat().st_size for n in shown}
    assert all(r.bucket is None and r.etag is None and r.mod_time for r in rows)
    assert df.rdd.getNumPartitions() <= max(tasks, 1) + 3
    everything = listing.list_tree(spark, f"file://{tree}", tasks, hidden=True)
    assert everything.count() == len(NAMES)
    other = inventory.list_files(spark, str(tree))  # leaves out files of length zero
    assert other.count() == len(shown) - 1


def test_places_of_stores():
    found = {p: (listing.Place(p).root, listing.Place(p).bucket, listing.Place(p).path)
             for p in ("s3a://b/k/x y", "hdfs://h:9/d/f", "/d/f", "file:/d/f", "file:///d/f", "s3://b")}
    assert found == {
        "s3a://b/k/x y": ("s3a://b", "b", "/k/x y"),
        "hdfs://h:9/d/f": ("hdfs://h:9", "h:9", "/d/f"),
        "/d/f": ("file://", None, "/d/f"),
        "file:/d/f": ("file://", None, "/d/f"),
        "file:///d/f": ("file://", None, "/d/f"),
        "s3://b": ("s3://b", "b", "/"),
    }


def test_no_folder_is_an_error_and_an_empty_one_has_no_files(spark, tmp_path):
    assert listing.list_tree(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="gone"):
        listing.list_tree(spark, str(tmp_path / "gone")).count()


def test_named_files_are_looked_up(spark, tree):
    names = [*(f"{tree}/{n}" for n in NAMES), f"{tree}/gone.csv", f"{tree}/x", None, f"file:{tree}/a.csv"]
    df = spark.createDataFrame([(n, 1) for n in names], "file_path STRING, size INT")
    got = {r.file_path: r.size for r in listing.lookup(df).collect()}
    want = {f"{tree}/{n}": (tree / n).stat().st_size for n in NAMES}
    assert got == {**want, f"file:{tree}/a.csv": 1}


def announce(folder, number, at, *paths):
    folder.mkdir(exist_ok=True)
    file = folder / f"{number}.json"
    row = {"file_name": "n", "file_size": 1, "created_at": "2024-01-01T00:00:00Z"}
    file.write_text("".join(json.dumps({**row, "file_path": p}) + "\n" for p in paths))
    os.utime(file, (at, at))


def test_repeats_are_dropped_within_the_bound_and_reported_after_it(spark, tree, tmp_path):
    control, log, seen = tmp_path / "control", str(tmp_path / "log"), str(tmp_path / "seen")
    a, w1, w2, gone = (f"{tree}/{n}" for n in ("a.csv", "w/1.csv", "w/2.csv", "gone.csv"))

    def run():
        arrivals.on_arrival(
            arrivals.stream_announcements(spark, str(control), "1 hour", files_per_batch=1),
            None, Config((Mapping("", "ALL"),)), str(tmp_path / "out"), log, str(tmp_path / "at"),
            BatchOptions(validate_only=True, skip_validation=True), seen_path=seen,
        ).awaitTermination()

    start = 1_700_000_000
    announce(control, 0, start, a, w1, gone)
    announce(control, 1, start + 60, a, w1)
    run()
    announce(control, 2, start + 600, a, f"file://{w1}", w2)
    run()
    announce(control, 3, start + 90_000, f"{tree}/x/b.csv")
    run()
    announce(control, 4, start + 90_060, a)  # a day later; the state store has forgotten it
    run()
    decided = sorted((r.file_path, r.action) for r in spark.read.parquet(log).collect())
    assert decided == sorted(
        [(a, "validated"), (w1, "validated"), (w2, "validated"), (gone, "reject"), (f"{tree}/x/b.csv", "validated")]
    )
    assert [r.file_path for r in spark.read.parquet(f"{seen}/repeats").collect()] == [a]
