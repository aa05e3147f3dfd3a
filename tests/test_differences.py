"""Changes between snapshots: against plain dictionaries, and how little is compared."""

import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import differences

SCHEMA = "k long, part string, a string, b double"


def brute(before, after):
    one, other = ({(r[0], r[1]): r for r in rows} for rows in (before, after))
    out = [("insert", *other[k]) for k in other if k not in one]
    out += [("delete", *one[k]) for k in one if k not in other]
    out += [("update", *other[k]) for k in other if k in one and one[k] != other[k]]
    return sorted(out, key=str)


def snapshots(seed, size=300):
    draw = random.Random(seed)
    value = lambda: (draw.choice([None, "", "x", "y"]), draw.choice([None, 0.0, 1.5]))
    before = [(i, draw.choice("pq"), *value()) for i in range(size)]
    after = []
    for r in before:
        kind = draw.random()
        if kind < 0.8:
            after.append(r)
        elif kind < 0.9:
            after.append((r[0], r[1], *value()))
    after += [(size + i, "p", *value()) for i in range(20)]
    draw.shuffle(after)
    return before, after


@pytest.mark.parametrize("seed, buckets", [(1, 1), (2, 7), (3, 65_536)])
def test_changes_and_back(spark, seed, buckets):
    before, after = snapshots(seed)
    one, other = (spark.createDataFrame(rows, SCHEMA) for rows in (before, after))
    found = differences.changes(one, other, ["k", "part"], buckets)
    assert found.columns == ["change", "k", "part", "a", "b"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(before, after)
    got = differences.applied(one, found, ["k", "part"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(after, key=str)
    again = differences.applied(got, found, ["k", "part"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(after, key=str)


def test_only_buckets_that_differ_are_compared(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("k").isin(17, 4000), 0).otherwise(F.col("v")))
    buckets = differences.changed_buckets(rows, changed, ["k"], 1000).collect()
    assert len(buckets) == 2
    assert differences.changed_buckets(rows, rows.repartition(13), ["k"], 1000).isEmpty()
    found = differences.changes(rows, changed, ["k"], 1000).collect()
    assert sorted(map(tuple, found)) == [("update", 17, 0), ("update", 4000, 0)]


def test_nulls_that_move_between_columns(spark):
    """Rows whose hashes would be equal if nulls were passed over."""
    before = spark.createDataFrame([(1, "p", "x", None)], "k long, part string, a string, b string")
    after = spark.createDataFrame([(1, "p", None, "x")], "k long, part string, a string, b string")
    (row,) = differences.changes(before, after, ["k", "part"]).collect()
    assert tuple(row) == ("update", 1, "p", None, "x")


def test_empty_snapshots_and_other_columns(spark):
    rows = spark.createDataFrame([(1, "p", "x", 1.0)], SCHEMA)
    none = rows.where("1 = 0")
    assert [r.change for r in differences.changes(none, rows, ["k", "part"]).collect()] == ["insert"]
    assert [r.change for r in differences.changes(rows, none, ["k", "part"]).collect()] == ["delete"]
    assert differences.changes(none, none, ["k", "part"]).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        differences.changes(rows, rows.drop("b"), ["k"])
