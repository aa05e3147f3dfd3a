"""Tests on JSON held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOUBTFUL = r"['\x00-\x1f]"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value of any kind; null and empty text are not.

    Spark's JSON functions stop at the end of the first value, so the text is measured as the
    inside of an array, alone and followed by one more element. A text that closes the array
    early has the same length both times; any other counts one value only if it is one.

    They also take single quotes for double ones and bare control characters in strings. Only
    texts with such characters go through the stricter, slower parser.
    """
    alone = F.concat(F.lit("["), text, F.lit("]"))
    followed = F.concat(F.lit("["), text, F.lit(",0]"))
    quick = (F.json_array_length(alone) == 1) & (F.json_array_length(followed) == 2)

    def length(array: Column) -> Column:
        return F.size(F.from_json(array, "ARRAY<STRING>", _STRICT))

    strict = (length(alone) == 1) & (length(followed) == 2)
    checked = F.when(F.rlike(text, F.lit(_DOUBTFUL)), strict).otherwise(quick)
    return F.coalesce(checked, F.lit(False))


def array_size(text: Column) -> Column:
    """Number of elements of a JSON array, null when the text is no valid array."""
    return F.when(is_json(text), F.json_array_length(text))
