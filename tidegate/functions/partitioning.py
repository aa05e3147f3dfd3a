"""Derived columns for table partitions and sort orders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the partition transforms.
TRANSFORMS = ("identity", "bucket", "truncate", "year", "month", "day", "hour")

_DATE_FORMATS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


@dataclass(frozen=True)
class PartitionField:
    """A partition column ``name`` made from ``source``; ``size`` is buckets or width."""

    source: str
    transform: str = "identity"
    name: str | None = None
    size: int | None = None

    @property
    def column_name(self) -> str:
        if self.name:
            return self.name
        return self.source if self.transform == "identity" else f"{self.source}_{self.transform}"


@dataclass(frozen=True)
class SortField:
    column: str
    direction: str = "asc"
    null_order: str = "last"

    def column_order(self) -> Column:
        name = f"{self.direction.lower()}_nulls_{self.null_order.lower()}"
        if name not in {f"{d}_nulls_{n}" for d in ("asc", "desc") for n in ("first", "last")}:
            raise ValueError(f"unknown sort order: {self.direction} nulls {self.null_order}")
        return getattr(F.col(self.column), name)()


def partition_value(field: PartitionField, data_type: T.DataType) -> Column:
    """Column expression for one partition field."""
    source = F.col(field.source)
    if field.transform == "identity":
        return source
    if field.transform in ("bucket", "truncate") and not field.size:
        raise ValueError(f"{field.transform} on {field.source} needs a size")
    if field.transform == "bucket":
        return F.pmod(F.hash(source), F.lit(field.size))
    if field.transform == "truncate":
        if isinstance(data_type, T.StringType):
            return F.left(source, F.lit(field.size))
        return source - F.pmod(source, F.lit(field.size))
    if field.transform in _DATE_FORMATS:
        return F.date_format(source, _DATE_FORMATS[field.transform])
    raise ValueError(f"unknown partition transform: {field.transform}; known: {', '.join(TRANSFORMS)}")


def with_partitions(df: DataFrame, spec: list[PartitionField]) -> DataFrame:
    """``df`` with one column per partition field; identity fields need none."""
    made = {
        f.column_name: partition_value(f, df.schema[f.source].dataType)
        for f in spec
        if f.transform != "identity" or f.column_name != f.source
    }
    return df.withColumns(made) if made else df
