"""Web archives: revisit records for payloads that were stored before.

Records are written by Spark's text writer, one record a row, with the blank lines that end a
record as line separator; an archive is compressed as a whole. Archives are read as binary files,
so a task begins a new one before the bytes of its records come near the 2 GB of one value.
Reading takes length and digest of every stored payload anew, and fails where they differ from
the headers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import common

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


@dataclass(frozen=True)
class Archive:
    """How archives are cut and dated.

    An archive holds ``records`` records at most, and ends with the one that reaches ``bytes``
    (before compression).
    """

    records: int = 10_000
    bytes: int = 256 << 20
    date: str = "2024-01-01T00:00:00Z"
    least_bytes: int = 0
    compression: str = "gzip"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column."""
    digest = F.sha1(payload)
    signs = []
    for group in range(8):  # 5 hex digits are 20 bits, or 4 signs
        bits = F.conv(F.substring(digest, group * 5 + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(31) + 1
            signs.append(F.lit(BASE32).substr(place, F.lit(1)))
    return F.concat(*signs)


def resolve(df: DataFrame, key: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Add ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the smallest key
    is the response and the others revisit it. Null payloads count as empty. Rows that share the
    smallest key are all responses, and rows without a key are responses only where no row of
    their payload has one. Only digests and keys are shuffled to find the originals, and only
    those of payloads that come again meet the rows; Spark may broadcast them if they are few,
    or split a payload that very many rows share.
    """
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    headed = df.withColumns(
        {"payload_bytes": F.octet_length(data).cast("long"), "payload_digest": base32_sha1(data)}
    )
    again = (
        headed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min(key).alias("__first"), F.count(F.lit(1)).alias("__rows"))
        .where("__rows > 1")
        .select("payload_digest", "__first")
    )
    joined = headed.join(again, "payload_digest", "left")
    revisit = F.col("__first").isNotNull() & ~F.col(key).eqNullSafe(F.col("__first"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("__first")).alias("refers_to"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def records(resolved: DataFrame, key: str, url: str, payload: str, archive: Archive) -> DataFrame:
    """One text per row: a WARC record with fresh headers, without the blank lines at its end."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce(F.col(payload), F.lit("")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _header("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    block = F.concat(http, body)
    identity = lambda c: F.concat(F.lit("<urn:record:"), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", identity(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("payload-"), "payload_digest")))),
        _header("WARC-Date", F.lit(archive.date)),
        _header("WARC-Target-URI", F.col(url)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, identity(F.col("refers_to")))),
        _header("X-Record-Key", F.col(key)),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
    )
    return resolved.select(F.concat(head, block).alias("value"))


def write_archives(
    df: DataFrame,
    path: str,
    key: str,
    url: str,
    payload: str,
    archive: Archive = Archive(),
) -> None:
    """Write a record per row below ``path``: responses in full, revisits as headers only.

    Archives are in folders by their number in the task that wrote them. Other columns of ``df``
    are not looked at, so their names may be any.
    """
    common.prepare_workers(df.sparkSession)
    resolved = resolve(df.select(key, url, payload), key, payload, archive.least_bytes)
    cut = records(resolved, key, url, payload, archive).mapInArrow(
        numbered(archive.bytes), "value string, archive int"
    )
    cut.write.partitionBy("archive").options(
        lineSep=CRLF * 2, compression=archive.compression, maxRecordsPerFile=archive.records
    ).text(path)


def numbered(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the archive of each record: a new one after every ``most`` bytes of a task's records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        for batch in batches:
            places = np.empty(batch.num_rows, np.int32)
            for row, length in enumerate(pc.binary_length(batch.column(0)).to_pylist()):
                if held >= most:
                    number, held = number + 1, 0
                places[row] = number
                held += length
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places)], names=["value", "archive"])

    return run


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Headers (names in lower case), HTTP headers and payload of each record of an archive.

    Lengths, not separators, end a record, so a payload may hold anything. Archives may be
    compressed as a whole or record by record.
    """
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = _headers(stream)
        length = int(head.get("content-length", "0"))
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"{head.get('warc-record-id')} has {len(block)} of {length} bytes")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield head, _headers(io.BytesIO(http.partition(b"\r\n")[2])), payload


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


ARCHIVED = (
    "key string, url string, record_type string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record; ``payload`` is null for revisits, or everywhere without ``payloads``.

    ``refers_to`` is the key of the record that a revisit refers to. An archive is one task's.
    Length and digest of a response are those of its payload; a header that says otherwise is an
    error, as are archives that end within a record.
    """
    common.prepare_workers(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ARCHIVED.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for head, http, payload in parse_records(content.as_buffer().to_pybytes()):
                    revisit = head["warc-type"] == "revisit"
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = http.get("content-length")
                    if not revisit:
                        digest, length = _checked(head, digest, length, payload)
                    refers = head.get("warc-refers-to", "").removeprefix("<urn:record:")
                    rows.append(
                        (
                            head.get("x-record-key"),
                            head.get("warc-target-uri"),
                            head["warc-type"],
                            refers.removesuffix(">") if revisit else None,
                            digest,
                            None if length is None else int(length),
                            payload if payloads and not revisit else None,
                        )
                    )
                    held += len(payload)
                    if held > 8 << 20:
                        yield _batch(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.select("content").mapInArrow(run, ARCHIVED)


def _checked(head: dict[str, str], digest: str, length: str | None, payload: bytes) -> tuple[str, int]:
    """Digest and length of a stored payload, which must be what its headers say, if they do."""
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest not in ("", found) or length not in (None, str(len(payload))):
        name = head.get("warc-record-id", head.get("warc-target-uri"))
        raise ValueError(f"payload of {name} has {len(payload)} bytes and digest {found}, not {length} and {digest}")
    return found, len(payload)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)
