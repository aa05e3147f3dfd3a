"""Emptiness filters, required fields, cleaning, and counting of what was dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import text
from tidegate.operators.audit import data_columns, is_metadata


def text_columns(df: DataFrame) -> list[str]:
    """Names of the data columns that hold text."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and not is_metadata(f.name)
    ]


def _any_of(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False)) if tests else F.lit(True)


def has_value(df: DataFrame) -> Column:
    """Whether a row has a non-null value in any data column."""
    return _any_of([F.col(f"`{n}`").isNotNull() for n in data_columns(df)])


def has_content(df: DataFrame) -> Column:
    """Whether a row has a value other than null and empty text in any data column."""
    texts = set(text_columns(df))

    def filled(name: str) -> Column:
        column = F.col(f"`{name}`")
        # A comparison with '' is never null for a non-null text, and is false for a null one.
        return F.coalesce(column != "", F.lit(False)) if name in texts else column.isNotNull()

    return _any_of([filled(n) for n in data_columns(df)])


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.filter(has_value(df))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.filter(has_content(df))


def squeeze_text(df: DataFrame) -> DataFrame:
    """Trim all text data columns and collapse their white space."""
    return df.withColumns({n: text.squeeze(F.col(f"`{n}`")) for n in text_columns(df)})


def collapse_text(df: DataFrame) -> DataFrame:
    """Collapse the white space of all text data columns, without trimming."""
    return df.withColumns({n: text.collapse_blanks(F.col(f"`{n}`")) for n in text_columns(df)})


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def has_required(df: DataFrame, required: Sequence[str]) -> Column:
    """Whether a row has a value in every required column; a column that is absent fails all."""
    absent = set(missing_columns(df, required))
    tests = [F.lit(False) if n in absent else F.col(f"`{n}`").isNotNull() for n in required]
    return reduce(Column.__and__, tests, F.lit(True))


def required_fields_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required field: is it there, and how many rows lack a value.

    One scan of just these columns; only counters are shuffled.
    """
    absent = set(missing_columns(df, required))
    counters = [
        (F.count(F.lit(1)) if n in absent else F.count_if(F.col(f"`{n}`").isNull())).alias(f"n{i}")
        for i, n in enumerate(required)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counters)
    rows = [
        F.struct(
            F.lit(n).alias("field"),
            F.lit(n not in absent).alias("present"),
            F.col(f"n{i}").alias("missing_rows"),
            F.col("total").alias("total_rows"),
        )
        for i, n in enumerate(required)
    ]
    return totals.select(F.inline(F.array(*rows)))


def quality_counts(df: DataFrame, keep: Column) -> DataFrame:
    """Rows in, rows kept and rows dropped by ``keep``, as one row."""
    kept = F.count_if(keep)
    return df.agg(
        F.count(F.lit(1)).alias("input_records"),
        kept.alias("output_records"),
        (F.count(F.lit(1)) - kept).alias("data_quality_issues"),
    )
