"""Benchmark items in documents, by SimHash over windows of an item's size.

A document's windows of as many words as an item has are fingerprinted over their shingles,
weighted by the root of how rare a shingle is among the items, so that bits differ as the similarity
below does (the weights themselves would let a single rare shingle decide them). A fingerprint has
BITS bits in BLOCKS blocks. Within RADIUS differing bits at most RADIUS blocks differ, so all others
agree; windows and items with fewer equal blocks are passed over, and no pair within the radius is
missed. The pairs left are compared exactly, by the weighted Jaccard similarity of the shingles
with repeats.

Windows are taken where they can match. A window of the similarity LEAST misses 1 - LEAST of an
item's weight at most, so of an item's anchors, its rarest shingles with ANCHORED of its weight, it
holds all but so much. Anchors are looked up for every place of every document, and a window meets
the items of whose anchors it holds enough.

How rare shingles are is counted by Spark over all items. Items are broadcast in sets of up to
BROADCAST_CHARS of text, and documents pass each set; with each go the counts of the shingles that
several items hold, so that the sets do not show in the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidegate.llm import common

SHINGLE = 2
LEAST = 0.8
#: Share of an item's weight that its anchors have.
ANCHORED = 0.6
BITS, BLOCKS = 256, 128
#: At the similarity of 0.8 fingerprints differ in 39 bits on average, with a deviation of 6 to 8;
#: those of unrelated windows in 128, with a deviation of 8 or more.
RADIUS = 76
#: Windows fingerprinted at once.
CHUNK = 4096
#: Characters of texts that are hashed at once, if it is not one text alone.
TEXT_CHARS = 200_000
#: Text of items that one broadcast holds.
BROADCAST_CHARS = 16 << 20
_MASK = (1 << 20) - 1
_POINTS = 0x110000


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Alphabet:
    """Which characters make words, and a number for each."""

    def __init__(self, more: str = ""):
        self.inside = np.zeros(_POINTS, dtype=bool)
        self.inside[[i for i in range(_POINTS) if chr(i).isalnum()]] = True
        self.inside[[ord(c) for c in more]] = True
        self.codes = _mixed(np.arange(1, _POINTS + 1, dtype=np.uint64))
        self.powers = self._powers(64)

    @staticmethod
    def _powers(count: int) -> np.ndarray:
        base = np.full(count, 0x9E3779B97F4A7C15, dtype=np.uint64)
        base[0] = 1
        return np.cumprod(base)

    def word_hashes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word of all texts (letters and digits in a row, in lower case), and
        the places among them at which each text begins and the last one ends."""
        lowered = [t.lower() for t in texts]
        points = "\n".join(lowered).encode("utf-32-le", "replace")
        points = np.frombuffer(points, dtype=np.uint32)
        begins = np.cumsum([0, *(len(t) + 1 for t in lowered)])
        inside = self.inside[points]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts = np.flatnonzero(edge == 1)
        if not len(starts):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
        lengths = np.flatnonzero(edge == -1) - starts
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(first[-1] + lengths[-1])) - np.repeat(first, lengths)
        if len(self.powers) < int(lengths.max()):
            self.powers = self._powers(int(lengths.max()))
        terms = self.codes[points[inside]] * self.powers[place]
        return _mixed(np.add.reduceat(terms, first)), np.searchsorted(starts, begins)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; of all of them if there are fewer."""
    size = min(size, len(words))
    count = len(words) - size + 1 if size else 0
    total = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0xD1342543DE82EF95) + words[i : i + count]
    return _mixed(total)


_STREAMS = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_FIRST_OF_BLOCKS = np.uint64(0x5555555555555555)


def equal_blocks(differ: np.ndarray) -> np.ndarray:
    """Blocks of two bits that agree, from the differing bits of fingerprints (four words a row)."""
    either = (differ | (differ >> np.uint64(1))) & _FIRST_OF_BLOCKS
    return BLOCKS - np.bitwise_count(either).sum(axis=-1, dtype=np.int64)


def within_radius(differ: np.ndarray) -> np.ndarray:
    """Whether fingerprints are within RADIUS: by their equal blocks first, then by all bits."""
    near = equal_blocks(differ) >= BLOCKS - RADIUS
    near[near] = np.bitwise_count(differ[near]).sum(axis=-1, dtype=np.int64) <= RADIUS
    return near


def item_shingles(alphabet: Alphabet, text: str) -> tuple[int, np.ndarray]:
    """How many words an item has, and its shingles."""
    words = alphabet.word_hashes([text])[0]
    return len(words), shingle_hashes(words, SHINGLE)


class Items:
    """What documents are compared with, made from ``(item id, text)``.

    ``total`` items of all sets have words; ``known`` (ascending) are the shingles that several
    items hold, in ``counts`` items each. Without these the given items are all there are.
    """

    def __init__(
        self,
        items: list[tuple[int, str | None]],
        total: int | None = None,
        known: np.ndarray | None = None,
        counts: np.ndarray | None = None,
    ):
        self.alphabet = Alphabet()
        found = [(i, *item_shingles(self.alphabet, t or "")) for i, t in items]
        found = [f for f in found if f[1]]  # an item without words matches nothing
        self.ids = [i for i, _, _ in found]
        self.sizes = np.array([n for _, n, _ in found], dtype=np.int64)
        self.shingles = [s for _, _, s in found]
        if known is None:
            total = len(found)
            each = [np.unique(s) for s in self.shingles]
            known, counts = np.unique(np.concatenate([*each, np.zeros(0, np.uint64)]), return_counts=True)
        self.rarest = 1.0 + np.log(max(1, total))
        self.known = known.astype(np.uint64)
        self.weights = 1.0 + np.log(np.maximum(1, total) / np.maximum(1, counts))
        anchors = [self._anchors(s) for s in self.shingles]
        self.need = np.array([need for _, _, need in anchors])
        flat = np.concatenate([*(a for a, _, _ in anchors), np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(anchors)), [len(a) for a, _, _ in anchors])
        weigh = np.concatenate([*(w for _, w, _ in anchors), np.zeros(0)])
        order = np.argsort(flat, kind="stable")
        self.owner, self.weigh = owner[order], weigh[order]
        self.anchor, first = np.unique(flat[order], return_index=True)
        self.begin = np.concatenate((first, [len(flat)])).astype(np.int64)
        self.maybe = np.zeros(_MASK + 1, dtype=bool)
        self.maybe[self.anchor & np.uint64(_MASK)] = True
        prints = [self._windows(s, len(s))[0] for s in self.shingles]
        self.fingerprints = np.array(prints, dtype=np.uint64).reshape(-1, BITS // 64)

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), self.rarest)
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes, self.weights[at], self.rarest)

    def _anchors(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """The rarest shingles, their weights, and how much of that a similar window has."""
        own, repeats = np.unique(shingles, return_counts=True)
        weights = self.weight(own)
        order = np.argsort(-weights, kind="stable")
        summed = np.cumsum((weights * repeats)[order])
        enough = int(np.searchsorted(summed, summed[-1] * ANCHORED)) + 1
        chosen = order[:enough]
        need = summed[min(enough, len(summed)) - 1] - summed[-1] * (1 - LEAST)
        # each place where a shingle stands counts once, so of repeats one weighs as all
        return own[chosen], (weights * repeats)[chosen], float(need) * (1 - 1e-9)

    def _windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of each run of ``size`` shingles: bits that hold over half the weight."""
        weights = np.sqrt(self.weight(hashes))
        wide = _mixed(hashes[:, None] * _STREAMS[None, :])
        bits = np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little")
        signed = (bits.astype(np.float64) * 2 - 1) * weights[:, None]
        total = np.concatenate((np.zeros((1, BITS)), np.cumsum(signed, axis=0)))
        above = (total[size:] - total[:-size]) > 1e-9
        return np.packbits(above, axis=1, bitorder="little").view(np.uint64)

    def similarity(self, window: np.ndarray, item: np.ndarray) -> float:
        """Weighted Jaccard similarity of two lists of shingles, repeats counted."""
        hashes, place = np.unique(np.concatenate((window, item)), return_inverse=True)
        mine = np.bincount(place[: len(window)], minlength=len(hashes))
        other = np.bincount(place[len(window) :], minlength=len(hashes))
        weights = self.weight(hashes)
        return float((np.minimum(mine, other) @ weights) / (np.maximum(mine, other) @ weights))

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[float, int, int]]]:
        """Per text, for each item found: similarity, first word and words of its best window."""
        out: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
        at = 0
        while at < len(texts) and self.ids:
            end, chars = at + 1, len(texts[at] or "")
            while end < len(texts) and chars + len(texts[end] or "") <= TEXT_CHARS:
                chars += len(texts[end] or "")
                end += 1
            words, bounds = self.alphabet.word_hashes([t or "" for t in texts[at:end]])
            for text, starts, items in self._met(words, bounds):
                self._compare(words[bounds[text] : bounds[text + 1]], starts, items, out[at + text])
            at = end
        return out

    def _hits(self, words, bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of anchors among the words of all texts: text, item, place and weight, in order."""
        found = []
        for length in (1, SHINGLE):  # items of one word have shingles of one word
            hashes = shingle_hashes(words, length) if length <= len(words) else words[:0]
            at = np.flatnonzero(self.maybe[hashes & np.uint64(_MASK)])
            place = np.searchsorted(self.anchor, hashes[at])
            place[place == len(self.anchor)] = 0
            hit = self.anchor[place] == hashes[at]
            at, place = at[hit], place[hit]
            text = np.searchsorted(bounds, at, side="right") - 1
            whole = at + length <= bounds[text + 1]  # else it goes on into the next text
            at, place, text = at[whole], place[whole], text[whole]
            counts = self.begin[place + 1] - self.begin[place]
            within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            entry = np.repeat(self.begin[place], counts) + within
            fits = np.minimum(self.sizes[self.owner[entry]], SHINGLE) == length
            entry = entry[fits]
            found.append((np.repeat(text, counts)[fits], self.owner[entry], np.repeat(at, counts)[fits], self.weigh[entry]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        return tuple(c[order] for c in columns)

    def _met(self, words, bounds) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Texts, with first words of windows and the items of whose anchors they hold enough.

        A window is looked at by the first anchor of an item in it; if all that follow within the
        item's size weigh too little, so do those in any window that begins with this one.
        """
        text, item, at, weight = self._hits(words, bounds)
        if not len(at):
            return
        reach = self.sizes[item] - np.minimum(self.sizes[item], SHINGLE)
        group = np.cumsum(np.concatenate(([0], (np.diff(text) != 0) | (np.diff(item) != 0))))
        spread = int(at[-1] if len(at) == 1 else at.max()) + int(self.sizes.max()) + 1
        line = group * spread + at
        summed = np.concatenate(([0.0], np.cumsum(weight)))
        end = np.searchsorted(line, line + reach, side="right")
        rich = summed[end] - summed[:-1] >= self.need[item] - 1e-9 * summed[-1]
        before = np.concatenate(([-1], at[:-1]))
        before = np.where(np.concatenate(([False], np.diff(group) == 0)), before, -1)
        low = np.maximum(np.maximum(before + 1, at - reach), bounds[text])
        high = np.minimum(at, np.maximum(bounds[text], bounds[text + 1] - self.sizes[item]))
        keep = rich & (low <= high)
        text, item, low, high = text[keep], item[keep], low[keep], high[keep]
        counts = high - low + 1
        within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(low - bounds[text], counts) + within
        text, item = np.repeat(text, counts), np.repeat(item, counts)
        for one in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1):
            if len(one):
                yield int(text[one[0]]), starts[one], item[one]

    def _compare(self, own, starts, items, found) -> None:
        """Windows of one text with the items they may be alike to."""
        for size in np.unique(self.sizes[items]).tolist():
            some = self.sizes[items] == size
            length = min(SHINGLE, size)
            pairs = np.unique(starts[some] * len(self.ids) + items[some])
            first, who = pairs // len(self.ids), pairs % len(self.ids)
            shingles = shingle_hashes(own, length)
            wide = max(1, min(size - length + 1, len(shingles)))
            for one in np.split(np.arange(len(first)), np.flatnonzero(np.diff(first) > CHUNK) + 1):
                for at in range(0, len(one), CHUNK):
                    part = one[at : at + CHUNK]
                    self._near(shingles, wide, size, first[part], who[part], found)

    def _near(self, shingles, wide: int, size: int, starts, who, found) -> None:
        first, end = int(starts[0]), int(starts[-1]) + wide
        prints = self._windows(shingles[first:end], wide)
        differ = prints[starts - first] ^ self.fingerprints[who]
        for i in np.flatnonzero(within_radius(differ)).tolist():
            start, k = int(starts[i]), int(who[i])
            alike = self.similarity(shingles[start : start + wide], self.shingles[k])
            if alike >= LEAST and (k not in found or (-alike, start) < (-found[k][0], found[k][1])):
                found[k] = (alike, start, size)


_items: dict[int, Items] = {}


def _built(shared) -> Items:
    rows, total, known, counts = shared.value
    key = hash(tuple(rows))
    if key not in _items:
        _items.clear()
        _items[key] = Items(rows, total, known, counts)
    return _items[key]


def repeated_shingles(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Of ``id, text`` how many have words, and the shingles that several hold, with how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                own = np.unique(item_shingles(alphabet, text or "")[1]).view(np.int64)
                first = np.arange(len(own)) == 0
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(first)], ["shingle", "first"])

    each = items.select("id", "text").mapInArrow(run, "shingle long, first boolean")
    counted = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.count_if("first").alias("n"))
    counted = common.written(counted, "shingles")
    total = counted.agg(F.sum("n")).first()[0] or 0
    rows = counted.where("c > 1").select("shingle", "c").toArrow()
    known = rows.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    return int(total), known[order], rows.column("c").to_numpy()[order]


def _item_sets(benchmark: DataFrame, key: str, text: str) -> list:
    """Broadcasts of the items, each of a bounded size, with the counts over all of them."""
    rows = benchmark.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(text).alias("text")
    )
    rows = rows.distinct()
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    sets = max(1, -(-chars // BROADCAST_CHARS))
    counts = repeated_shingles(rows)
    shared = []
    for i in range(sets):
        part = rows.where(F.pmod(F.xxhash64("id"), F.lit(sets)) == i)
        found = sorted((r["id"], r["text"]) for r in part.collect())
        shared.append(benchmark.sparkSession.sparkContext.broadcast((found, *counts)))
    return shared


def find_leaks(
    documents: DataFrame,
    key: str,
    text: str,
    benchmark: DataFrame,
    item_key: str,
    item_text: str,
) -> DataFrame:
    """``key, item_id, similarity, first_word, words``: a row for each item a document holds.

    Documents without any item give no row, repeated documents a row each. Null and empty texts
    hold nothing, and items without words, without a key or with a null text are in no document.
    A document shorter than an item is one window. Of windows that are alike the first counts.
    """
    common.prepare_workers(documents.sparkSession)
    schema = StructType(
        [
            documents.schema[key],
            StructField("item_id", LongType()),
            StructField("similarity", DoubleType()),
            StructField("first_word", LongType()),
            StructField("words", LongType()),
        ]
    )
    source = documents.select(F.col(key), F.col(text).alias("__text"))
    out = None
    for shared in _item_sets(benchmark, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _built(shared)
            for batch in batches:
                rows = []
                for at, found in enumerate(items.matches(batch.column(1).to_pylist())):
                    for k, match in sorted(found.items()):
                        rows.append((at, items.ids[k], *match))
                if not rows:
                    continue
                at, *columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                made = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), *made], names=schema.fieldNames()
                )

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def without_leaks(
    documents: DataFrame, text: str, benchmark: DataFrame, item_key: str, item_text: str
) -> DataFrame:
    """The documents in which :func:`find_leaks` finds no item, unchanged and without a shuffle."""
    common.prepare_workers(documents.sparkSession)
    place = documents.columns.index(text)
    for shared in _item_sets(benchmark, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = _built(shared)
            for batch in batches:
                keep = [not found for found in items.matches(batch.column(place).to_pylist())]
                yield batch.filter(pa.array(keep, pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
