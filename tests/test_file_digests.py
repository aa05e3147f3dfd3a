"""Digests in chunks, and of parts, against whole files."""

import hashlib
import random

import pytest

from tidegate.sources import file_digests, inventory


def multi(data, size):
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    if len(parts) == 1:
        return 1, hashlib.md5(data).hexdigest()
    joined = b"".join(hashlib.md5(p).digest() for p in parts)
    return len(parts), f"{hashlib.md5(joined).hexdigest()}-{len(parts)}"


@pytest.fixture
def binaries(spark, tmp_path, monkeypatch):
    """Bytes of any kind, with and without a line feed at the end, over splits of 700 bytes."""
    draw = random.Random(4)
    data = {
        "text": b"a line\n" * 400, "open": b"a line\r\nand more\n" * 300 + b"end", "bytes": draw.randbytes(5000),
        "more": draw.randbytes(4096) + b"\n", "feeds": b"\n" * 1500, "one": b"x", "line": b"y" * 2500, "empty": b"",
    }
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(file_digests, "CHUNK_BYTES", 300)
    yield str(tmp_path), {k: v for k, v in data.items() if v}
    for k, v in before.items():
        spark.conf.set(k, v)


def test_chunks_are_the_bytes_of_the_file(spark, binaries):
    path, data = binaries
    rows = sorted(file_digests.chunks(spark, path, 1000).collect(), key=lambda r: (r.path, r["at"]))
    joined = {}
    for r in rows:
        name = r.path.rsplit("/", 1)[1]
        assert len(joined.get(name, b"")) == r["at"] and r["part"] == r["at"] // 1000 and len(r["data"]) <= 300
        assert (r["at"] + len(r["data"]) - 1) // 1000 == r["part"]
        joined[name] = joined.get(name, b"") + bytes(r["data"])
    assert joined == data


def test_digests_of_files_beyond_a_value(spark, binaries):
    path, data = binaries
    for most in (10, 2500, 1 << 30):
        found = {r["path"].rsplit("/", 1)[1]: r for r in inventory.digests(spark, path, most_bytes=most).collect()}
        assert set(found) == set(data)
        for name, content in data.items():
            r = found[name]
            assert r["size"] == len(content) and r["unread"] is None
            for kind in ("md5", "sha1", "sha256"):
                assert r[kind] == getattr(hashlib, kind)(content).hexdigest(), (most, name)


@pytest.mark.parametrize("size", [256, 1000, 1 << 20])
def test_etags_of_parts(spark, binaries, size):
    path, data = binaries
    found = file_digests.part_etags(spark, path, size).collect()
    got = {r["path"].rsplit("/", 1)[1]: (r["parts"], r["etag"]) for r in found}
    assert got == {name: multi(content, size) for name, content in data.items()}
