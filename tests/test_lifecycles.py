"""Keyed state with timers: decisions do not depend on batches, late rows or restarts."""

import random

from pyspark.sql import functions as F

from tidegate.streaming import lifecycles, streams
from tidegate.streaming.lifecycles import Life, Lives, advance

RULES = Lives(retries=2, wait_seconds=10, live_seconds=100, late="0 seconds")
LOG = "file_path STRING, job_id STRING, event_id STRING, occurred_at TIMESTAMP, kind STRING, to_state STRING, retryable BOOLEAN"


def by_seconds(events, until, rules):
    """Walks through all seconds and asks what happens in each."""
    found, began, failures, closed, due = [], None, 0, False, None
    for second in range(until):
        if began is not None and second == began + rules.live_seconds:
            if not closed:
                found.append(("EXPIRE", second, failures))
            began, failures, closed, due = None, 0, False, None
        for _, _, effect in [e for e in events if e[0] == second]:
            began = second if began is None else began
            if closed or effect == 0:
                continue
            due = None
            if effect == 2:
                failures += 1
                if failures <= rules.retries:
                    due = second + rules.wait_seconds * 2 ** (failures - 1)
                    continue
            closed = True
            found.append(("DONE" if effect == 1 else "GIVE_UP", second, failures))
        if due == second:
            found.append(("RETRY", second, failures))
            due = None
    return found


def test_decisions_do_not_depend_on_where_time_is_cut():
    source = random.Random(5)
    seen = set()
    for _ in range(400):
        moments = (source.randrange(400) for _ in range(source.randrange(14)))
        events = sorted((m, f"e{i}", source.choice([0, 0, 1, 2, 2, 2, 3])) for i, m in enumerate(moments))
        micros = [(t * 1_000_000, i, e) for t, i, e in events]
        life, got, start = Life(), [], 0
        for cut in [*sorted(source.randrange(600) for _ in range(source.randrange(6))), 600]:
            part = [e for e in micros if start <= e[0] < cut * 1_000_000]
            got += advance(life, part, cut * 1_000_000, RULES)
            start = max(start, cut * 1_000_000)
        want = by_seconds(events, 600, RULES)
        assert [(d, t // 1_000_000, n) for d, t, n in got] == want
        assert life == Life() or life.began is not None
        seen.update(d for d, _, _ in got)
    assert seen == {"DONE", "RETRY", "GIVE_UP", "EXPIRE"}


def rows(spark, *events):
    """(file, id, second, what) as log rows."""
    kinds = {"start": ("transition", "PROCESSING", None), "done": ("transition", "PROCESSED", None),
             "again": ("error", None, True), "fatal": ("error", None, False)}
    found = [(f, "j", i, s, *kinds[w]) for f, i, s, w in events]
    made = spark.createDataFrame(found, LOG.replace("TIMESTAMP", "LONG"))
    return made.withColumn("occurred_at", F.timestamp_seconds("occurred_at")).coalesce(1)


def test_state_outlives_restarts_and_repeats_count_once(spark, tmp_path):
    source, out, at = (str(tmp_path / n) for n in ("in", "out", "at"))
    parts = [
        # out of order, one row twice, rows without a key, an id or a time
        [("a", "2", 1015, "again"), ("a", "1", 1000, "start"), ("b", "1", 1001, "fatal"), ("b", "1", 1001, "fatal"),
         (None, "1", 1000, "done"), ("c", None, 1000, "done"), ("c", "1", None, "done")],
        [("a", "2", 1015, "again"), ("d", "1", 1040, "start")],
        [("a", "3", 1050, "done"), ("late", "1", 1002, "done"), ("d", "2", 1060, "start")],
        [("clock", "1", 2000, "start")],
    ]
    late = 0
    store = spark.conf.get(lifecycles.STORE)
    for part in parts:
        rows(spark, *part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        query = lifecycles.put_decisions(stream, out, at, Lives(2, 10, 100, "20 seconds"))
        query.awaitTermination()
        late += streams.late_rows(query)
    got = spark.read.parquet(out).select(
        "file_path", "decision", F.unix_seconds("decided_at").alias("s"), "attempt"
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "DONE", 1050, 1), ("a", "RETRY", 1025, 1), ("b", "GIVE_UP", 1001, 0), ("d", "EXPIRE", 1140, 0),
    ]
    assert late == 1
    assert spark.conf.get(lifecycles.STORE) == store
