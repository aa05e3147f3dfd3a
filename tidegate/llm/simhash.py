"""Near duplicates by SimHash fingerprints, with candidates by pigeonring filtering.

A fingerprint of 64 bits is cut into segments that form a ring. If two fingerprints differ in
at most RADIUS bits, then from some segment on every chain of l segments differs in at most
l * RADIUS / segments bits (the pigeonring principle). The first segments of such a chain have a
budget below one, so they are equal: they are the key by which candidates meet. The longer chains
are tested on each candidate, then the whole distance.

Where very many different fingerprints share a key (a large group of near copies), comparing them
in pairs would grow with the square of the group. There each fingerprint is listed under itself
and under every fingerprint one bit away, among the bits that differ at all in the group: two are
within two bits exactly if they share an entry, and an entry holds at most 65 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidegate.llm import common
from tidegate.llm.components import components

BITS = 64
SEED = 42
#: Differing bits up to which two fingerprints are linked.
RADIUS = 2
#: Segments of the ring; more make longer keys and more of them.
SEGMENTS = 5
#: Different fingerprints under one key from which entries take the place of pairs.
DENSE = 64


def shingles(words: list[bytes], size: int) -> list[bytes]:
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [joined[i:j] for i, j in zip(starts, ends[size - 1 :], strict=False)]


def hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; A-Z in lower case, words between ASCII white space."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = [digest(s, SEED) for s in shingles((text or "").encode().lower().split(), size)]
    return np.array(found, dtype="<u8")


def fingerprint(hashed: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit integer; zero for none."""
    if not len(hashed):
        return 0
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    above = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashed)
    return int(np.packbits(above, bitorder="little").view("<i8")[0])


def with_fingerprints(
    df: DataFrame, key: str, text: str, size: int = 3, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``key``, ``keep`` and ``fp``, the fingerprint over shingles of ``size`` words."""
    common.prepare_workers(df.sparkSession)
    names = [key, *keep]
    schema = StructType([*[df.schema[n] for n in names]]).add("fp", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(hashes(t, size)) for t in batch.column(len(names)).to_pylist()]
            kept = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.int64())], names=schema.fieldNames()
            )

    return df.select(*names, F.col(text).alias("__text")).mapInArrow(run, schema)


def ring_masks(segments: int) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """For each segment of the ring: the bits of the equal head, and (bits, budget) of each chain."""
    if not RADIUS < segments <= BITS:
        raise ValueError("a ring needs more segments than bits may differ")
    edges = [round(i * BITS / segments) for i in range(segments + 1)]
    parts = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(segments)]
    heads, chains = [], []
    for start in range(segments):
        bits, head, chain = 0, 0, []
        for length in range(1, segments):
            bits |= parts[(start + length - 1) % segments]
            budget = length * RADIUS // segments
            if budget == 0:
                head = bits
            else:
                chain.append((bits, budget))
        heads.append(head)
        chains.append(chain)
    return heads, chains


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def candidate_links(rows: DataFrame, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Pairs ``a, b`` of ids within RADIUS bits that connect all rows within RADIUS bits.

    ``rows`` has ``tab`` (fingerprints of different tables are not compared), ``id`` and ``fp``.
    Rows within the radius are joined by a path of pairs, and a group gives at most 65 pairs for
    each of its rows beyond ``dense``.
    """
    heads, chains = ring_masks(segments)
    places = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(_long(head)).alias("k"))
            for i, head in enumerate(heads)
        ]
    )
    keyed = rows.select("tab", "id", "fp", F.explode(places).alias("place"))
    keyed = keyed.select("tab", "id", "fp", "place.i", "place.k")
    groups = keyed.groupBy("tab", "i", "k").agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_or(fp) & ~bit_and(fp)").alias("varying")
    )
    members = keyed.join(groups.where("n > 1"), ["tab", "i", "k"])
    members = common.written(members, "ring")

    few = members.where(F.col("n") <= dense).select("tab", "i", "k", "id", "fp")
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    on_ring = F.lit(False)
    for i, chain in enumerate(chains):
        fits = F.col("l.i") == i
        for bits, budget in chain:
            fits = fits & (F.bit_count(differ.bitwiseAND(_long(bits))) <= budget)
        on_ring = on_ring | fits
    met = (F.col("l.id") < F.col("r.id")) & on_ring & (F.bit_count(differ) <= RADIUS)
    for name in ("tab", "i", "k"):
        met = met & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    pairs = few.alias("l").join(few.alias("r"), met)
    pairs = pairs.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))

    many = members.where(F.col("n") > dense).groupBy("tab", "id", "fp")
    many = many.agg(F.bit_or("varying").alias("varying"))
    flips = f"filter(sequence(-1, {BITS - 1}), b -> b < 0 or getbit(varying, b) = 1)"
    entry = F.expr("if(b < 0, fp, fp ^ shiftleft(1L, b))").alias("entry")
    listed = many.select("tab", "id", "fp", F.explode(F.expr(flips)).alias("b"))
    listed = listed.select("tab", "id", entry)
    first = listed.groupBy("tab", "entry").agg(F.min("id").alias("first"))
    stars = listed.join(first, ["tab", "entry"]).where("id != first")
    stars = stars.select(F.col("id").alias("a"), F.col("first").alias("b"))
    return pairs.union(stars).distinct()


def fingerprint_components(
    df: DataFrame, key: str, text: str, size: int = 3, segments: int = SEGMENTS
) -> DataFrame:
    """One row per row of ``df``: the key, ``fp``, and ``component_id``.

    Rows whose fingerprints differ in RADIUS bits or fewer are linked; the component is named by
    the smallest key that can be reached over links, the row's own included. Null and empty texts
    have the fingerprint zero, which links like any other. A row without a key takes part and
    names a component only if none of its rows has a key (then null). Rows with equal keys each
    stay. Equal fingerprints are one node, so a group of copies costs one row.
    """
    prints = common.written(with_fingerprints(df, key, text, size), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min(key).alias("first"))
    nodes = common.written(nodes, "nodes")
    rows = nodes.select(F.lit(0).alias("tab"), F.col("fp").alias("id"), "fp")
    found = components(candidate_links(rows, segments))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(key, "fp", "component_id")
