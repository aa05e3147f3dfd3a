"""Near copies of documents: SimHash fingerprints, pruned by pigeonring, then exact similarity.

Texts are cut into chunks at places that their words choose, so that an edit changes the chunks
around it and no others; texts that share a key, two chunks in a row, are candidates. Each text
has one fingerprint of BITS bits over its different shingles. A candidate pair has to pass the
ring: from some segment on, the differences of every chain of consecutive segments stay within
their share of RADIUS (the pigeonring principle). Then the whole distance is taken, and what is
within RADIUS is compared by its shingles: sketches settle the clear cases, whole sets the others.

Equal texts are one text. Under a key all texts meet two of them, the same for all keys as far as
possible, so a group of any size gives two rows for each of its texts and keys. What that leaves
apart meets again: under a key of up to FEW texts all whose groups differ. Texts under keys of more
are joined by their rarest shingles (prefix filtering): sets with a similarity of t share one of the
n - ceil(t n) + 1 first of either, in any order of shingles that is the same for all. Which are
frequent is learned from some of the texts, and decides the order alone, so no pair is lost. Keys and
shingles that hold much the same texts are one, and the texts of one are dealt to squares of BLOCK by
BLOCK. In these fingerprints pick the texts that may have links, whole sets decide all their pairs,
and what comes out is a forest of the groups, not the pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from tidegate.llm import common
from tidegate.llm.components import components
from tidegate.llm.decontaminate import Alphabet, shingle_hashes

BITS, SEGMENTS = 128, 8
#: Differing bits of candidates: at a similarity of 0.8 fingerprints differ in 19 of 128 bits on
#: average, with a deviation of 4; those of unrelated texts in 64.
RADIUS = 40
#: Words of a chunk on average in texts from one to another number of words, and whether chunks
#: are keys alone. Near copies differ by a quarter in length at most, so that they share a way to
#: be cut: the ranges overlap by as much.
CHUNKS = ((2, 0, 30, True), (4, 24, 80, True), (8, 64, 200, True), (16, 160, 1 << 62, False))
#: Texts under a key up to which all of different groups are compared at once.
FEW = 64
#: Texts under a shingle that are compared at once with as many others; of more, block by block.
BLOCK = 256
#: Values of sets of a block that are sorted at once, and of these that are compared by at once.
VALUES, COLUMNS = 4_000_000, 4096
#: Texts from which frequent shingles are learned, and how many of these: an order, never a choice.
LEARN, FREQUENT = 20_000, 500_000
#: Keys of texts that are broadcast to pick them from the documents (some 16 MB).
MOST_BROADCAST = 1_000_000
#: Shingle hashes in a sketch, and how near to the threshold its estimate decides nothing (four
#: standard errors there).
SKETCH, DOUBT = 256, 0.1
#: Characters of texts that are hashed at once, if it is not one text alone.
TEXT_CHARS = 400_000
_word = re.compile(r"\w+").findall
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_alphabet: list[Alphabet] = []


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * by
    return x ^ (x >> np.uint64(29))


def hashed_words(texts: list[str]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text, in lower case."""
    if not _alphabet:
        _alphabet.append(Alphabet("_"))
    at = 0
    while at < len(texts):
        end, chars = at + 1, len(texts[at])
        while end < len(texts) and chars + len(texts[end]) <= TEXT_CHARS:
            chars += len(texts[end])
            end += 1
        words, bounds = _alphabet[0].word_hashes(texts[at:end])
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield words[low:high]
        at = end


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The different hashes of the shingles, ascending."""
    return np.unique(shingle_hashes(words, size))


def fingerprint(shingles: np.ndarray) -> np.ndarray:
    """BITS bits as two integers: those that over half of the shingles have."""
    if not len(shingles):
        return np.zeros(2, dtype=np.int64)
    both = np.stack((_mixed(shingles, _M1), _mixed(shingles, _M2)), axis=1)
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(both), 255):  # sums of 255 bits fit a byte
        bits = np.unpackbits(both[at : at + 255].view(np.uint8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(total * 2 > len(both), bitorder="little").view("<i8")


def chunk_keys(words: np.ndarray) -> np.ndarray:
    """A hash of each two chunks in a row; of short texts also of each chunk alone."""
    size, out = len(words), []
    if not size:
        return np.zeros(0, dtype=np.int64)
    ends = words.copy()
    ends[1:] += words[:-1] * _M1
    ends = _mixed(ends, _M2)
    terms = _mixed(words, _M1)
    for length, least, most, alone in CHUNKS:
        if not least <= size <= most:
            continue
        starts = np.flatnonzero(ends % np.uint64(length) == 0) + 1
        starts = np.concatenate(([0], starts[starts < size]))
        # words of a chunk count by their place in it
        place = np.arange(size) - np.repeat(starts, np.diff(starts, append=size))
        powers = np.cumprod(np.full(int(place.max()) + 1, _M2, dtype=np.uint64))
        chunks = _mixed(np.add.reduceat(terms * powers[place], starts), _M2)
        if alone or len(chunks) == 1:
            out.append(chunks)
        out.append(_mixed(chunks[:-1] * _M1 + chunks[1:] + np.uint64(1), _M1))
    return np.unique(np.concatenate(out)).view(np.int64)


def on_ring(differ: np.ndarray) -> np.ndarray:
    """Whether differing bits (two integers a row) stay within the budgets from some segment on.

    A chain of l segments may differ in l * RADIUS / SEGMENTS bits; if the whole distance is
    within RADIUS there is a segment from which all chains do.
    """
    parts = np.bitwise_count(np.ascontiguousarray(differ).view(np.uint16)).reshape(len(differ), SEGMENTS)
    around = np.concatenate((parts, parts), axis=1).astype(np.int64)
    budget = np.arange(1, SEGMENTS + 1) * RADIUS
    found = np.zeros(len(differ), dtype=bool)
    for start in range(SEGMENTS):
        chains = np.cumsum(around[:, start : start + SEGMENTS], axis=1) * SEGMENTS
        found |= (chains <= budget).all(axis=1)
    return found


def within_radius(differ: np.ndarray) -> np.ndarray:
    """Whether RADIUS bits (of two integers a row) or fewer differ."""
    return np.bitwise_count(differ.view(np.uint64)).sum(axis=1) <= RADIUS


def near(differ: np.ndarray) -> np.ndarray:
    """Whether fingerprints are within RADIUS; the ring spares most pairs the whole distance."""
    out = on_ring(differ)
    out[out] = within_radius(differ[out])
    return out


def sketch(shingles: np.ndarray) -> bytes:
    """The smallest hashes of a set, of 32 bits each: all of them up to SKETCH."""
    return np.unique(_mixed(shingles, _M1) >> np.uint64(32))[:SKETCH].astype("<u4").tobytes()


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two sets from their sketches; 1 for two empty ones."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    both = np.intersect1d(x, y, assume_unique=True)
    if max(len(x), len(y)) < SKETCH:
        total = len(x) + len(y) - len(both)
        return len(both) / total if total else 1.0
    union = np.union1d(x, y)[:SKETCH]
    return float(np.isin(union, both, assume_unique=True).mean())


def jaccard(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    both = len(np.intersect1d(x, y, assume_unique=True))
    total = len(x) + len(y) - both
    return both / total if total else 1.0


# -- tables ---------------------------------------------------------------------------------


def _pairs(a: str, b: str) -> tuple:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def first_candidates(met: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of ``place, node, c, low, high``: each node with the two of its place."""
    ends = met.select("node", F.explode(F.array_distinct(F.array("low", "high"))).alias("other"))
    return ends.where("node != other").select(*_pairs("node", "other")).distinct()


def more_links(
    met: DataFrame, prints: DataFrame, roots: DataFrame, source: DataFrame, size: int, least: float
) -> DataFrame:
    """Links ``a, b`` of keys that share a place and are in different groups (``node, root``).

    As many as connect all such groups that are linked: a block of texts gives a forest of its
    groups, never its pairs. Texts under a place of over FEW meet if they share a shingle among the
    first of either (:func:`first_shingles`), as all with a similarity of ``least`` do.
    """
    known = met.select("place", "node", "c").join(roots, "node", "left")
    known = known.withColumn("root", F.coalesce("root", "node"))
    split = known.groupBy("place").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
    open_ = known.join(split.where("r0 != r1").select("place"), "place")
    open_ = common.written(open_, "open-places")

    places = open_.groupBy("node").agg(
        F.first("root").alias("root"), F.collect_set("place").alias("places"), F.max("c").alias("most")
    )
    places = common.written(places, "places")
    shared = open_.where(F.col("c") <= FEW).select("place", "node", "root")
    crowded = places.where(F.col("most") > FEW)
    if not crowded.isEmpty():
        firsts = first_shingles(crowded.join(prints, "node").select("node", "id"), source, size, least)
        shared = shared.union(firsts.join(crowded, "node").select("shingle", "node", "root"))
    blocks = squares(shared)
    meeting = common.written(_meeting(blocks.join(prints.drop("id"), "node")), "meeting")

    key, kind = source.columns[0], source.schema[0]
    wanted = meeting.select("node").distinct().join(prints, "node").select(F.col("id").alias(key))
    sets = _drawn_of(wanted, source, lambda words: shingle_set(words, size).tobytes())
    sets = sets.select(F.xxhash64(key).alias("node"), F.col(key).alias("id"), F.col("drawn").alias("set"))
    rows = meeting.join(sets, "node").join(places.select("node", "places"), "node")
    rows = rows.repartition("at", "i", "j").sortWithinPartitions("at", "i", "j")
    linked = rows.mapInArrow(_linker(least), StructType([StructField(n, kind.dataType) for n in ("a", "b")]))
    return linked.distinct()


def squares(shared: DataFrame) -> DataFrame:
    """Blocks ``at, i, j, part, node, root`` in which the texts of each place meet, BLOCK by BLOCK.

    Places (``place, node, root``) whose texts have the same smallest hash are one: they hold the
    same texts for the most part, which then meet once. Left out are those of one group alone.
    """
    smallest = shared.groupBy("place").agg(
        F.min(F.xxhash64("node", F.lit(2))).alias("at"), F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    shared = shared.join(smallest.where("r0 != r1").select("place", "at"), "place")
    shared = common.written(shared.select("at", "node", "root").distinct(), "shared")
    counts = shared.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # a text meets its own block and each other one, in the square of both
    shared = shared.join(counts, "at").withColumn("part", F.expr("int(pmod(xxhash64(node), blocks))"))
    shared = shared.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    square = [F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")]
    return shared.select("at", *square, "part", "node", "root")


def first_shingles(wanted: DataFrame, source: DataFrame, size: int, least: float) -> DataFrame:
    """``node, shingle`` of the texts of ``wanted`` (node, id): of each the first of its shingles in
    the order of their frequency, as many as sets with a similarity of ``least`` have to share one.

    Frequencies are learned from LEARN texts, those whose hashes are smallest by a remainder. What
    they lack comes first, in the order of the hashes; the order is the same for all texts.
    """
    key, kind = source.columns[0], source.schema[0]
    spark = source.sparkSession
    every = max(1, -(-wanted.count() // LEARN))
    some = wanted.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(every)) == 0).select(F.col("id").alias(key))
    sets = _drawn_of(some, source, lambda words: shingle_set(words, size).tobytes())
    seen = _unpacked(sets, kind).groupBy("shingle").count().where("count > 1")
    seen = seen.orderBy(F.desc("count"), "shingle").limit(FREQUENT).select("shingle").collect()
    frequent = np.array([r.shingle for r in seen], dtype=np.int64).view(np.uint64)
    order = np.argsort(frequent)
    shared = spark.sparkContext.broadcast((frequent[order], len(frequent) - order))

    def firsts(words: np.ndarray) -> bytes:
        found = shingle_set(words, size)
        known, places = shared.value
        rank = np.zeros(len(found), dtype=np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            rank = np.where(known[at] == found, places[at], 0)
        count = len(found) - int(np.ceil(least * len(found) - 1e-6)) + 1
        return found[np.lexsort((found, rank))[:count]].tobytes()

    drawn = _drawn_of(wanted.select(F.col("id").alias(key)), source, firsts)
    found = _unpacked(drawn, kind).select(F.xxhash64(key).alias("node"), "shingle")
    return common.written(found, "first-shingles")


def _unpacked(drawn: DataFrame, kind: StructField) -> DataFrame:
    """``key, shingle``: a row for each hash of the bytes ``drawn``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, "<i8") for x in batch.column(1).to_pylist()]
            made = [batch.column(0), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, names=[kind.name, "shingles"])

    lists = drawn.mapInArrow(run, StructType([kind]).add("shingles", ArrayType(LongType())))
    return lists.select(kind.name, F.explode("shingles").alias("shingle"))


_MEETING = "at long, i int, j int, part int, node long, root long, n int, f1 long, f2 long"


def _meeting(rows: DataFrame) -> DataFrame:
    """Of the rows of each block (``at, i, j``) those near some other by fingerprint and size."""
    one = F.struct("part", "node", "root", "n", "f1", "f2")
    lists = rows.groupBy("at", "i", "j").agg(F.collect_list(one).alias("all"))
    return lists.mapInArrow(_meet, _MEETING)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list, what is near by fingerprint to one of another group; of another part if there
    are two."""
    for batch in batches:
        lists = batch.column(3)
        offsets, flat = lists.offsets.to_numpy(), lists.values
        part, _, root, size, *prints = (flat.field(i).to_numpy() for i in range(6))
        prints = np.stack(prints, axis=1).reshape(-1, 2)
        found = np.zeros(len(part), dtype=bool)
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            i, j = np.triu_indices(high - low, 1)
            i, j = i + low, j + low
            apart = (root[i] != root[j]) & _same_size(size[i], size[j])
            if (part[low:high] != part[low]).any():
                apart &= part[i] != part[j]
            i, j = i[apart], j[apart]
            fits = near(prints[i] ^ prints[j])
            found[i[fits]] = found[j[fits]] = True
        which = pa.array(np.repeat(np.arange(len(batch)), np.diff(offsets))[found[offsets[0] : offsets[-1]]])
        kept = pa.array(np.flatnonzero(found))
        columns = [batch.column(k).take(which) for k in range(3)]
        columns += [flat.field(k).take(kept) for k in range(6)]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _MEETING.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, from rows in the order of ``at, i, j``."""
    held, last = [], None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("at", "i", "j")], axis=1)
        cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if low == high:
                continue
            now = tuple(keys[low].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def in_common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share; VALUES or so of all at once."""
    pieces = sum(map(len, sets)) // VALUES + 1
    if pieces > 1:
        return sum(in_common([x[x % pieces == k] for x in sets]) for k in range(pieces))
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
    starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))[: len(flat)]
    held = np.diff(starts, append=len(flat))
    several = np.repeat(held > 1, held)  # values of one set alone count for no two
    row, held = row[several], held[held > 1]
    column = np.repeat(np.arange(len(held)), held)
    for low in range(0, len(held), COLUMNS):
        at, end = np.searchsorted(column, (low, low + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, len(held) - low)), dtype=np.float32)
        has[row[at:end], column[at:end] - low] = 1
        out += has @ has.T
    return out


def forest(linked: np.ndarray, groups: np.ndarray) -> list[tuple[int, int]]:
    """Of the links of a block (a matrix) as many as connect what all connect, groups being so."""
    edges, seen = [], np.zeros(int(groups.max()) + 1, dtype=bool)
    for start in range(len(linked)):
        if seen[groups[start]]:
            continue
        seen[groups[start]] = True
        todo = np.flatnonzero(groups == groups[start]).tolist()
        while todo:
            i = todo.pop()
            new = np.flatnonzero(linked[i] & ~seen[groups])
            reached, first = np.unique(groups[new], return_index=True)
            edges += [(i, j) for j in new[first].tolist()]
            seen[reached] = True
            if len(reached):
                todo += np.flatnonzero(np.isin(groups, reached)).tolist()
    return edges


def _linker(least: float) -> Callable:
    """The function that gives links ``a, b`` of keys, a forest of the groups of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            column = lambda name: block.column(name).to_numpy()  # noqa: B023, E731
            sets = [np.frombuffer(x, "<u8") for x in block.column("set").to_pylist()]
            size = np.array([len(x) for x in sets], dtype=np.float64)
            both = in_common(sets).astype(np.float64)
            total = size[:, None] + size - both
            linked = np.divide(both, total, out=np.ones_like(both), where=total > 0) >= least
            linked &= column("root")[:, None] != column("root")
            part = column("part")
            if (part != part[0]).any():
                linked &= part[:, None] != part
            if not linked.any():
                continue
            linked &= in_common([np.array(x) for x in block.column("places").to_pylist()]) > 0
            prints = np.stack((column("f1"), column("f2")), axis=1)
            i, j = np.nonzero(linked)
            linked[i, j] = within_radius(prints[i] ^ prints[j])
            edges = forest(linked, np.unique(column("root"), return_inverse=True)[1])
            if edges:
                ends = np.array(edges)
                ids = block.column("id").combine_chunks()
                made = [ids.take(pa.array(ends[:, k])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(made, ["a", "b"])

    return run


LEAST = 0.8


def _same_size(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return np.minimum(n, m) >= np.maximum(n, m) * LEAST - 1e-6


def _ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = lambda name: batch.column(name).to_numpy()  # noqa: B023, E731
        differ = np.stack((column("f1a") ^ column("f1b"), column("f2a") ^ column("f2b")), axis=1)
        fits = near(differ) & _same_size(column("na"), column("nb"))
        yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))


def ring_pairs(pairs: DataFrame, prints: DataFrame, key: StructField) -> DataFrame:
    """Of pairs ``a, b`` of nodes those near by fingerprint and size, as pairs of keys."""
    side = lambda s: prints.select(
        F.col("node").alias(s), F.col("id").alias(f"id{s}"),
        *[F.col(c).alias(f"{c}{s}") for c in ("n", "f1", "f2")],
    )
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.select(F.col("ida").alias("a"), F.col("idb").alias("b"), "na", "nb", "f1a", "f1b", "f2a", "f2b")
    ends = StructType([StructField(n, key.dataType) for n in ("a", "b")])
    return met.mapInArrow(_ring, ends)


def alike(pairs: DataFrame, source: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs ``a, b`` of keys of ``source`` (key, text) with a similarity of ``least`` or more.

    Sketches settle the pairs whose estimate is DOUBT or more away from ``least``, and texts that
    fit a sketch; the others are compared by all their shingles.
    """
    ends = [StructField(n, source.schema[0].dataType) for n in ("a", "b")]
    both = _drawn(pairs, source, lambda words: sketch(shingle_set(words, size)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = np.array([similarity(p, q) for p, q in zip(x, y, strict=True)])
            whole = np.array([max(len(p), len(q)) < 4 * SKETCH for p, q in zip(x, y, strict=True)])
            sure = whole | (np.abs(found - least) >= DOUBT)
            out = batch.select(["a", "b"]).append_column("sure", pa.array(sure, pa.bool_()))
            yield out.filter(pa.array((found >= least) | ~sure, pa.bool_()))

    judged = both.mapInArrow(judge, StructType([*ends]).add("sure", BooleanType()))
    judged = common.written(judged, "judged")
    both = _drawn(
        judged.where("not sure").select("a", "b"),
        source,
        lambda words: shingle_set(words, size).tobytes(),
    )

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [jaccard(p, q) >= least for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return judged.where("sure").select("a", "b").union(both.mapInArrow(exact, StructType(ends)))


def _drawn(pairs: DataFrame, source: DataFrame, draw: Callable[[np.ndarray], bytes]) -> DataFrame:
    """``a, b, x, y``: the pairs with what ``draw`` makes of the words of either text."""
    key = source.columns[0]
    wanted = pairs.select(F.col("a").alias(key)).union(pairs.select(F.col("b").alias(key)))
    drawn = _drawn_of(wanted.distinct(), source, draw)
    left = drawn.select(F.col(key).alias("a"), F.col("drawn").alias("x"))
    right = drawn.select(F.col(key).alias("b"), F.col("drawn").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _drawn_of(wanted: DataFrame, source: DataFrame, draw: Callable[[np.ndarray], bytes]) -> DataFrame:
    """The keys of ``wanted`` with ``drawn``, what ``draw`` makes of the words of their texts.

    Only these texts are read on; up to MOST_BROADCAST keys, counted first, go to the texts, and
    beyond that texts are shuffled to them. Of rows with one key the text with the smallest digest
    counts.
    """
    key, kind = source.columns[0], source.schema[0]
    wanted = common.written(wanted, "wanted")
    if wanted.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    wanted = source.join(wanted, key, "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(hashed_words([t or "" for t in batch.column(1).to_pylist()]))
            digests = [hashlib.md5(w.tobytes()).digest() for w in words]
            made = [pa.array(digests, pa.binary()), pa.array([draw(w) for w in words], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], names=[key, "digest", "drawn"]
            )

    schema = StructType([kind]).add("digest", BinaryType()).add("drawn", BinaryType())
    drawn = wanted.mapInArrow(run, schema).groupBy(key)
    drawn = drawn.agg(F.min(F.struct("digest", "drawn")).getField("drawn").alias("drawn"))
    return common.written(drawn, "drawn")


def near_copies(
    df: DataFrame, key: str, text: str, size: int = 5, least: float = LEAST
) -> DataFrame:
    """``key, component_id`` of each key that has a smaller key among its near copies.

    Texts are compared by their words in lower case without punctuation. Equal texts are copies.
    Different ones are linked if they share a chunk key, their fingerprints are within RADIUS and
    their shingles of ``size`` words have a Jaccard similarity of ``least`` or more. Groups are
    connected by links and named by their smallest key. Null texts count as empty, and empty texts
    are copies of each other. Rows without a key are left out; rows with one key are one document,
    of which the text with the smallest digest counts. Tables made on the way are removed.
    """
    common.prepare_workers(df.sparkSession)
    source = df.where(F.col(key).isNotNull()).select(key, F.col(text).alias("__text"))
    find = lambda: _near_copies(source, key, size, least)
    return common.without_scratch(find, df.sparkSession, "copies")


def _near_copies(source: DataFrame, key: str, size: int, least: float) -> DataFrame:
    kind = source.schema[0]

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(hashed_words([t or "" for t in batch.column(1).to_pylist()]))
            sets = [shingle_set(w, size) for w in words]
            found = np.array([fingerprint(s) for s in sets], dtype=np.int64).reshape(-1, 2)
            made = [
                pa.array([hashlib.md5(w.tobytes()).digest() for w in words], pa.binary()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array(found[:, 0].copy()),
                pa.array(found[:, 1].copy()),
                pa.array([chunk_keys(w) for w in words], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.fieldNames())

    schema = StructType([kind]).add("digest", BinaryType()).add("n", IntegerType())
    schema = schema.add("f1", LongType()).add("f2", LongType()).add("places", ArrayType(LongType()))
    made = common.written(source.mapInArrow(prints, schema), "prints")
    first = [F.first(c).alias(c) for c in ("n", "f1", "f2", "places")]
    texts = made.groupBy("digest").agg(F.min(key).alias("id"), *first)
    texts = common.written(texts.withColumn("node", F.xxhash64("id")), "texts")
    # rows of one key with different texts are one node
    own = F.min(F.struct("digest", "id", "n", "f1", "f2")).alias("p")
    nodes = texts.groupBy("node").agg(own).select("node", "p.id", "p.n", "p.f1", "p.f2")
    nodes = common.written(nodes, "nodes")

    members = texts.select("node", F.explode("places").alias("place"))
    groups = members.groupBy("place").agg(
        F.count(F.lit(1)).alias("c"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    met = members.join(groups.where("low != high"), "place")
    met = common.written(met.select("place", "node", "c", "low", "high"), "met")
    pairs = common.written(ring_pairs(first_candidates(met), nodes, kind), "candidates")
    links = common.written(alike(pairs, source, size, least), "links")
    found = common.written(components(links), "groups")
    roots = found.select(F.xxhash64("node").alias("node"), F.xxhash64("root").alias("root"))
    more = common.written(more_links(met, nodes, roots, source, size, least), "more-links")
    if not more.isEmpty():
        found = components(links.union(more))
    named = texts.select("digest", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("digest", F.coalesce("root", "id").alias("component_id"))
    grouped = made.select(key, "digest").join(named, "digest")
    lowest = grouped.groupBy(key).agg(F.min("component_id").alias("component_id"))
    return lowest.where(F.col(key) != F.col("component_id"))


def without_near_copies(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` without the documents that :func:`near_copies` names a smaller one for.

    Up to MOST_BROADCAST keys, counted first, are broadcast, so that no text is shuffled; beyond
    that the texts are joined with them by key.
    """
    copies = near_copies(df, key, text).select(key)
    if copies.count() <= MOST_BROADCAST:
        copies = F.broadcast(copies)
    return df.join(copies, key, "left_anti").select(df.columns)
