"""Parts of object paths such as ``s3://bucket/dir/name.csv.gz``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of compressed files, and those that are stripped to see the format.
COMPRESSED_SUFFIXES = (".gz", ".gzip", ".bz2", ".zip")
STRIPPED_SUFFIXES = (".gz", ".gzip", ".bz2")

#: Names that object stores go by.
SCHEMES = ("s3://", "s3a://", "s3n://")

# File suffix to format name.
SUFFIX_FORMATS = {
    ".csv": "CSV",
    ".tsv": "TSV",
    ".json": "JSON",
    ".jsonl": "JSONL",
    ".ndjson": "JSONL",
    ".parquet": "PARQUET",
}
FALLBACK_FORMAT = "CSV"


def _without_scheme(path: Column) -> Column:
    found = (F.when(F.startswith(path, F.lit(s)), F.substr(path, F.lit(len(s) + 1))) for s in SCHEMES)
    return F.coalesce(*found, path)


def location(path: Column) -> Column:
    """A path without its scheme, so that ``s3://b/k`` and ``s3a://b/k``, or ``file:///d/f``
    and ``/d/f``, are the same place."""
    return F.regexp_replace(path, r"^(?:[A-Za-z0-9]+:)?/+", "")


def is_object_path(path: Column) -> Column:
    """Whether the path has a bucket and a key at all."""
    return F.contains(_without_scheme(path), F.lit("/"))


def bucket(path: Column) -> Column:
    """Text before the first slash; null when there is none."""
    bare = _without_scheme(path)
    return F.when(F.contains(bare, F.lit("/")), F.substring_index(bare, "/", 1))


def key(path: Column) -> Column:
    """Text after the first slash; null when there is none."""
    bare = _without_scheme(path)
    at = F.instr(bare, "/")
    return F.when(at > 0, F.substr(bare, at + 1))


def file_name(key_: Column) -> Column:
    return F.substring_index(key_, "/", -1)


def directory(key_: Column) -> Column:
    """Key up to and with its last slash, or an empty text."""
    return F.left(key_, F.length(key_) - F.length(file_name(key_)))


def is_compressed(name: Column) -> Column:
    low = F.lower(name)
    return reduce(Column.__or__, (F.endswith(low, F.lit(s)) for s in COMPRESSED_SUFFIXES))


def file_format(name: Column) -> Column:
    """Format told by the suffix, below at most one compression suffix."""
    pattern = "(" + "|".join(s.replace(".", r"\.") for s in STRIPPED_SUFFIXES) + ")$"
    bare = F.regexp_replace(F.lower(name), pattern, "")
    found = F.coalesce(
        *(F.when(F.endswith(bare, F.lit(s)), F.lit(f)) for s, f in SUFFIX_FORMATS.items()),
        F.lit(FALLBACK_FORMAT),
    )
    return F.when(name.isNotNull(), found)


def target_location(root: Column | str, area: str, target: Column) -> Column:
    """``<root>/<area>/<target>``, with area ``processed`` or ``staging``."""
    base = F.lit(root) if isinstance(root, str) else root
    return F.concat_ws("/", F.rtrim(base, F.lit("/")), F.lit(area), target)
