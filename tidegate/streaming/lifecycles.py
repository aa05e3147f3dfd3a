"""Lives of files as keyed state: retries after a wait, giving up, and expiry, told by timers.

A life begins with the first event of a file and ends ``live_seconds`` later; an event from then
on begins the next one. Events count in the order of their times, whatever batch brings them: they
wait in the state until the watermark has passed them, so the decisions do not depend on how the
stream was cut into batches. State of a life is dropped when it ends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidegate.operators import tracking
from tidegate.streaming.streams import put_batches

DONE, RETRY, GIVE_UP, EXPIRE = "DONE", "RETRY", "GIVE_UP", "EXPIRE"
DECISIONS = "file_path STRING, job_id STRING, decision STRING, decided_at TIMESTAMP, attempt INT"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What an event does to a life.
_OTHER, _DONE, _AGAIN, _FATAL = range(4)


@dataclass(frozen=True)
class Lives:
    """``retries`` at most, the first after ``wait_seconds`` and each next one after twice that."""

    retries: int = 3
    wait_seconds: int = 60
    live_seconds: int = 7 * 86_400
    late: str = "1 hour"

    def wait(self, failures: int) -> int:
        return (self.wait_seconds << (failures - 1)) * 1_000_000


@dataclass
class Life:
    """State of one file. Times are microseconds since 1970; ``due`` is that of the next retry."""

    began: int | None = None
    failures: int = 0
    closed: bool = False
    due: int | None = None


Event = tuple[int, str, int]
Decision = tuple[str, int, int]


def advance(life: Life, events: Sequence[Event], until: int, rules: Lives) -> Iterator[Decision]:
    """Decisions before ``until``, changing ``life``; ``events`` (time, id, effect) are in order and before it.

    An outcome that comes before a retry is due, or just then, takes its place.
    """
    for at, _, effect in events:
        yield from _due(life, at, rules)
        if life.began is None:
            life.began = at
        if life.closed or effect == _OTHER:
            continue
        life.due = None
        if effect == _AGAIN:
            life.failures += 1
        if effect == _AGAIN and life.failures <= rules.retries:
            life.due = at + rules.wait(life.failures)
        else:
            life.closed = True
            yield (DONE if effect == _DONE else GIVE_UP), at, life.failures
    yield from _due(life, until, rules)


def _due(life: Life, until: int, rules: Lives) -> Iterator[Decision]:
    """The retry that is due before ``until``, and the end of the life by then (an event just then
    belongs to the next one)."""
    if life.began is None:
        return
    end = life.began + rules.live_seconds * 1_000_000
    if life.due is not None and life.due < min(until, end):
        yield RETRY, life.due, life.failures
        life.due = None
    if end <= until:
        if not life.closed:
            yield EXPIRE, end, life.failures
        life.began, life.failures, life.closed, life.due = None, 0, False, None


class _Processor(StatefulProcessor):
    """Keeps a :class:`Life` and its waiting events, with one timer for the next thing to do."""

    def __init__(self, rules: Lives) -> None:
        self.rules = rules

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "began BIGINT, failures INT, closed BOOLEAN, due BIGINT")
        self.waiting = handle.getListState("waiting", "at BIGINT, event_id STRING, effect INT")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        found = [(r["_at"], r["event_id"], r["_effect"]) for r in rows]
        self.waiting.appendList(found)
        self._wake(min(at for at, _, _ in found), timerValues)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        # Events that came more than once wait more than once.
        waiting = sorted(set(tuple(r) for r in self.waiting.get())) if self.waiting.exists() else []
        life = Life(*self.life.get()) if self.life.exists() else Life()
        ready = [e for e in waiting if e[0] < until]
        rest = waiting[len(ready) :]
        decided = list(advance(life, ready, until, self.rules))
        if ready:
            self.waiting.put(rest) if rest else self.waiting.clear()
        if life.began is None:
            self.life.clear()
        else:
            self.life.update((life.began, life.failures, life.closed, life.due))
        later = [t for t in (life.due, rest[0][0] if rest else None) if t is not None]
        if life.began is not None:
            later.append(life.began + self.rules.live_seconds * 1_000_000)
        if later:
            self._wake(min(later), timerValues)
        for decision, at, attempt in decided:
            yield Row(file_path=key[0], job_id=key[1], decision=decision, decided_at=at, attempt=attempt)

    def _wake(self, at: int, timerValues: Any) -> None:
        """Timers are told in milliseconds and fire once the watermark is past what they wait for."""
        now = timerValues.getCurrentWatermarkInMs()
        self.handle.registerTimer(max(at // 1000 + 1, now + 1))

    def close(self) -> None:
        pass


def decisions(log: DataFrame, rules: Lives = Lives()) -> DataFrame:
    """Decisions on the files of a stream of log rows (see :mod:`tracking`).

    PROCESSED closes a life as DONE, an error that cannot be retried or the one after the last
    retry as GIVE_UP; RETRY comes when its wait is over, EXPIRE when a life ends open. Other
    transitions only begin a life. ``attempt`` counts the retryable errors so far. Repeated event
    ids of one time count once. Rows older than the watermark are dropped by Spark and counted by
    ``streams.late_rows``; rows without key, id or time are left out.
    """
    is_error = F.col("kind") == tracking.ERROR
    effect = (
        F.when(is_error & F.coalesce("retryable", F.lit(False)), _AGAIN)
        .when(is_error, _FATAL)
        .when(F.col("to_state") == "PROCESSED", _DONE)
        .otherwise(_OTHER)
    )
    rows = (
        log.withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))
        .withWatermark("occurred_at", rules.late)
        .dropna(subset=[*tracking.KEY, "event_id", "occurred_at"])
        .select(*tracking.KEY, "event_id", "occurred_at",
                F.unix_micros("occurred_at").alias("_at"), effect.alias("_effect"))
    )
    found = rows.groupBy(*tracking.KEY).transformWithState(
        statefulProcessor=_Processor(rules),
        outputStructType=DECISIONS.replace("TIMESTAMP", "BIGINT"),
        outputMode="append",
        timeMode="eventTime",
    )
    return found.withColumn("decided_at", F.timestamp_micros("decided_at"))


def put_decisions(
    log: DataFrame, path: str, checkpoint: str, rules: Lives = Lives(), every: str | None = None
) -> StreamingQuery:
    """Write the decisions of each batch to a folder of its own, from state kept in RocksDB, which
    keyed state with timers needs; other streams of the session keep their store."""
    conf = log.sparkSession.conf
    before = conf.get(STORE)
    conf.set(STORE, ROCKS)
    try:
        return put_batches(decisions(log, rules), path, checkpoint, every=every)
    finally:
        conf.set(STORE, before)
