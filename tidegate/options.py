"""Settings of jobs: prefix mappings, their rules, and the switches of a conversion."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# Defaults for settings a configuration leaves out.
DEFAULT_FILE_FORMAT = "CSV"
DEFAULT_OUTPUT_FORMAT = "PARQUET"
DEFAULT_MAX_FILE_SIZE = 5 * 1024**3
DEFAULT_TIMEOUT_MINUTES = 60
DEFAULT_MAX_RETRIES = 3
DEFAULT_TTL_DAYS = 30

DEFAULT_JOB = "standard"


@dataclass(frozen=True)
class Rules:
    validate_record_count: bool = False
    validate_file_size: bool = False
    validate_checksum: bool = False
    required_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Processing:
    file_format: str = DEFAULT_FILE_FORMAT
    output_format: str = DEFAULT_OUTPUT_FORMAT
    compression_type: str = ""
    max_file_size: int = DEFAULT_MAX_FILE_SIZE
    chunk_size: int = 0
    output_options: dict[str, str] = field(default_factory=dict)
    spark_config: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Mapping:
    """Where files below one key prefix go, and how they are checked and processed."""

    prefix: str
    target: str
    job: str = DEFAULT_JOB
    image: str = ""
    params: dict[str, str] = field(default_factory=dict)
    environment: dict[str, str] = field(default_factory=dict)
    rules: Rules = Rules()
    processing: Processing = Processing()


@dataclass(frozen=True)
class Config:
    mappings: tuple[Mapping, ...]
    input_bucket: str = ""
    output_bucket: str = ""
    staging_bucket: str = ""
    timeout_minutes: int = DEFAULT_TIMEOUT_MINUTES
    max_retries: int = DEFAULT_MAX_RETRIES
    ttl_days: int = DEFAULT_TTL_DAYS


def _or_default(value, default):
    """Settings that are absent, zero, negative or empty take their default."""
    if isinstance(value, (int, float)):
        return value if value > 0 else default
    return value or default


def _mapping(raw: dict) -> Mapping:
    rules = raw.get("validation_rules") or {}
    work = raw.get("processing_config") or {}
    return Mapping(
        prefix=raw.get("s3_prefix", ""),
        target=raw.get("target_name", ""),
        job=_or_default(raw.get("entry_point"), DEFAULT_JOB),
        image=raw.get("container_image", ""),
        params=dict(raw.get("script_params") or {}),
        environment=dict(raw.get("environment_vars") or {}),
        rules=Rules(
            bool(rules.get("validate_record_count")),
            bool(rules.get("validate_file_size")),
            bool(rules.get("validate_checksum")),
            tuple(rules.get("required_fields") or ()),
        ),
        processing=Processing(
            file_format=_or_default(work.get("file_format"), DEFAULT_FILE_FORMAT),
            output_format=_or_default(work.get("output_format"), DEFAULT_OUTPUT_FORMAT),
            compression_type=work.get("compression_type", ""),
            max_file_size=_or_default(work.get("max_file_size"), DEFAULT_MAX_FILE_SIZE),
            chunk_size=work.get("chunk_size", 0),
            output_options=dict(work.get("output_options") or {}),
            spark_config=dict(work.get("spark_config") or {}),
        ),
    )


def parse_config(text: str) -> Config:
    """Configuration from JSON text, with defaults filled in."""
    raw = json.loads(text)
    mappings = tuple(_mapping(m) for m in raw.get("prefix_mappings") or ())
    if not mappings:
        raise ValueError("at least one prefix mapping is required")
    return Config(
        mappings=mappings,
        input_bucket=raw.get("input_bucket_name", ""),
        output_bucket=raw.get("output_bucket_name", ""),
        staging_bucket=raw.get("staging_bucket_name", ""),
        timeout_minutes=_or_default(raw.get("job_timeout_minutes"), DEFAULT_TIMEOUT_MINUTES),
        max_retries=_or_default(raw.get("max_retries"), DEFAULT_MAX_RETRIES),
        ttl_days=_or_default(raw.get("control_ttl_days"), DEFAULT_TTL_DAYS),
    )


@dataclass(frozen=True)
class ConvertOptions:
    """Switches of the conversion job; :meth:`from_params` takes them from a mapping."""

    clean_strings: bool = False
    validate_data: bool = True
    add_row_id: bool = False
    compression: str = "snappy"
    partition_by: tuple[str, ...] = ()
    max_records_per_file: int | None = None
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    header: bool = True
    multi_line: bool = True
    split: bool = False

    @classmethod
    def from_params(cls, params: dict[str, str]) -> "ConvertOptions":
        base = cls()

        def flag(name: str, default: bool) -> bool:
            return params.get(name, str(default)).strip().lower() == "true"

        rows = params.get("max-records-per-file")
        return replace(
            base,
            clean_strings=flag("clean-strings", base.clean_strings),
            validate_data=flag("validate-data", base.validate_data),
            add_row_id=flag("add-row-id", base.add_row_id),
            compression=params.get("compression", base.compression),
            partition_by=tuple(
                name.strip() for name in params.get("partition-by", "").split(",") if name.strip()
            ),
            max_records_per_file=int(rows) if rows else None,
            delimiter=params.get("csv-delimiter", base.delimiter),
            quote=params.get("csv-quote", base.quote),
            escape=params.get("csv-escape", base.escape),
            header=flag("csv-header", base.header),
            multi_line=flag("csv-multiline", base.multi_line),
            split=flag("csv-split", base.split),
        )
