"""Cleaning of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_blanks(text: Column) -> Column:
    """Every run of white space becomes one blank; the ends keep theirs."""
    return F.regexp_replace(text, r"\s+", " ")


def squeeze(text: Column) -> Column:
    """No white space at the ends, single blanks inside.

    After the collapse only plain blanks are left, so a cheap ``trim`` does the ends.
    """
    return F.trim(collapse_blanks(text))


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"[^\d]", "")


def title_case(text: Column) -> Column:
    """First letter of each blank-separated word upper, the rest lower."""
    return F.initcap(text)


def plain_etag(etag: Column) -> Column:
    """Entity tag without the quotation marks around it."""
    return F.btrim(etag, F.lit('"'))
