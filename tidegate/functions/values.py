"""Identifiers, times and labels used by the processing records."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.schemas import STAGE_TEXT

SECONDS_PER_DAY = 86_400


def amount_or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0))


def text_or(value: Column, default: Column) -> Column:
    """The value, unless it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), default)


def stage_text(state: Column) -> Column:
    """Sentence for a state; an unknown state is shown by name."""
    known = F.create_map(*(F.lit(x) for x in chain.from_iterable(STAGE_TEXT.items())))
    return F.coalesce(F.try_element_at(known, state), F.concat(F.lit("State: "), state))


def batch_id(at: Column, seed: Column | None = None) -> Column:
    """``batch_<day>_<8 hex digits>``.

    The digits come from ``seed`` when given. That keeps the id when a lost task runs again,
    which random digits do not.
    """
    tail = F.sha2(seed, 256) if seed is not None else F.uuid()
    return F.concat(F.lit("batch_"), F.date_format(at, "yyyyMMdd"), F.lit("_"), F.left(tail, F.lit(8)))


def job_id(seed: Column | None = None) -> Column:
    """``job-<8 hex digits>``; see :func:`batch_id` for the seed."""
    tail = F.sha2(seed, 256) if seed is not None else F.uuid()
    return F.concat(F.lit("job-"), F.left(tail, F.lit(8)))


def expiry(at: Column, days: int) -> Column:
    """Epoch second at which a record made at ``at`` may go."""
    return F.unix_timestamp(at) + F.lit(days * SECONDS_PER_DAY)


def micros(at: Column, zoned: bool) -> Column:
    """Microseconds since 1970 of a time with zone, or of a time without as if in UTC.

    Spark's own functions read a time without zone in the zone of the session, where an hour
    may be missing or come twice.
    """
    if zoned:
        return F.unix_micros(at)
    seconds = F.unix_date(F.to_date(at)) * F.lit(SECONDS_PER_DAY).cast("bigint")
    seconds = seconds + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def rfc3339(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")


def checksum(content: Column, expected: Column) -> Column:
    """Digest of ``content`` by the algorithm that the length of ``expected`` tells."""
    size = F.length(expected)
    return (
        F.when(size == 32, F.md5(content))
        .when(size == 40, F.sha1(content))
        .when(size == 64, F.sha2(content, 256))
    )
