"""Which mapping a file belongs to: the longest prefix its key starts with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import paths
from tidegate.options import Mapping
from tidegate.sources.control import MAPPING, mapping_row

BAD_PATH = "invalid S3 path format: "
NO_MAPPING = "no prefix mapping found for key: "


def _first_per_prefix(mappings: Sequence[Mapping]) -> list[Mapping]:
    """Longest prefix first; of equal prefixes the first one given."""
    unique: dict[str, Mapping] = {}
    for mapping in mappings:
        unique.setdefault(mapping.prefix, mapping)
    return sorted(unique.values(), key=lambda m: -len(m.prefix))


def mapping_for(key: Column, mappings: Sequence[Mapping]) -> Column:
    """Struct of the mapping that a key belongs to, null when none does.

    The mappings are one constant; only the place in it is worked out per row.
    """
    fields = [part.rsplit(" ", 1) for part in MAPPING.split(", ")]

    def literal(position: int, mapping: Mapping) -> Column:
        values = zip(mapping_row(mapping, position), fields)
        return F.struct(*(_typed(v, kind).alias(name) for v, (name, kind) in values))

    known = F.array(*(literal(i, m) for i, m in enumerate(mappings)))
    places = [
        F.when(F.startswith(key, F.lit(m.prefix)), F.lit(mappings.index(m) + 1))
        for m in _first_per_prefix(mappings)
    ]
    return F.try_element_at(known, F.coalesce(*places))


def _typed(value, kind: str) -> Column:
    if isinstance(value, list):
        return F.array(*(F.lit(v) for v in value)).cast(kind)
    return F.lit(value).cast(kind)


def route_error(path: Column, target: Column) -> Column:
    return (
        F.when(~paths.is_object_path(path), F.concat(F.lit(BAD_PATH), path))
        .when(target.isNull(), F.concat(F.lit(NO_MAPPING), paths.key(path)))
    )


def route(files: DataFrame, mappings: Sequence[Mapping], path: str = "file_path") -> DataFrame:
    """``files`` with a ``mapping`` struct and a ``route_error``, no join and no shuffle.

    Files without a mapping stay, with the reason. The mappings are part of the plan; for many
    hundreds of them, :func:`route_by_table` is the better choice.
    """
    found = mapping_for(paths.key(F.col(path)), mappings)
    return files.withColumn("mapping", found).withColumn(
        "route_error", route_error(F.col(path), F.col("mapping.target_name"))
    )


def route_by_table(files: DataFrame, mappings: DataFrame, path: str = "file_path") -> DataFrame:
    """As :func:`route`, for mappings held in a table of any size.

    A key can only match its own leading parts, so each file offers one candidate per prefix
    length in use, and an equality join finds the mappings: no comparison of every file with
    every mapping. Adaptive execution broadcasts the mappings when they are measured small and
    splits a prefix that most files share. Among the hits of a file the longest wins: their lengths
    alone are compared, in a hash aggregate, and the mapping comes after that.
    """
    first = mappings.groupBy("s3_prefix").agg(F.min_by(F.struct("*"), "position").alias("mapping"))
    lengths = mappings.agg(F.collect_set(F.length("s3_prefix"))).first()[0]
    key = paths.key(F.col(path))
    candidates = F.filter(
        F.array(*(F.left(key, F.lit(n)) for n in sorted(lengths, reverse=True))),
        lambda part: part.isNotNull(),
    )
    longest = (
        files.select(path, F.explode(F.array_distinct(candidates)).alias("s3_prefix"))
        .join(first.select("s3_prefix"), "s3_prefix", "left_semi")
        .groupBy(path)
        .agg(F.max(F.length("s3_prefix")).alias("_length"))
    )
    hits = longest.select(path, F.left(key, F.col("_length")).alias("s3_prefix"))
    hits = hits.join(first, "s3_prefix").select(path, "mapping")
    return files.join(hits, path, "left").withColumn(
        "route_error", route_error(F.col(path), F.col("mapping.target_name"))
    )


def size_error(size: Column, limit: Column) -> Column:
    """Reason text for a file above the size its mapping allows."""
    return F.when(size > limit, F.format_string("File size %d exceeds maximum %d", size, limit))
