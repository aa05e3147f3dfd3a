"""Periodic runs of words: stretches that repeat a short piece several times.

A run of period q is a longest stretch in which words q apart are identical; it has at least
LEAST_WORDS words and LEAST_POWER times q, and q is its smallest period. Periods are taken by
octaves, from L to 2L - 1 for each power of two L. A tile of an octave is the words around a
boundary, a multiple of L: any run of the octave matches itself q words later over at least two
whole blocks of L words beside some boundary. Rolling hashes of the blocks tell which boundaries
and periods these can be; the Z-functions of the tile, forward and backward from its boundary,
then give exactly how far the words match on either side. These fragments overlap for boundaries
of one run; they are shuffled by document and period, and stitched.

Tiles of ordinary texts are solved where the text is read. Longer texts are cut into pieces that
hold the tiles of all low octaves, and for each higher octave into pieces in proportion to it;
pieces are dealt to all tasks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructType,
)

from tidegate.llm import common

LEAST_WORDS, LEAST_POWER = 6, 4
#: Words of a text that is solved in one task, and of a piece of a longer one.
PIECE_WORDS = 65_536
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
#: A change of the words of a row before runs are looked for: (key, words) to words.
Change = Callable[[object, list[bytes]], list[bytes]]


def least_matches(period):
    """Words that must equal those a period later, so that the stretch is long enough."""
    return np.maximum(LEAST_WORDS - period, (LEAST_POWER - 1) * period)


def octaves(words: int) -> int:
    """How many octaves hold a period that fits LEAST_POWER times into so many words."""
    return (words // LEAST_POWER).bit_length()


def z_function(values: list, upto: int) -> list[int]:
    """For each i below ``upto``, how many values from i on equal those from the start."""
    size = len(values)
    z, left, right = [size] + [0] * (upto - 1), 0, 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < size and values[k] == values[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def boundary_matches(words: list, boundary: int, step: int) -> tuple[list[int], list[int]]:
    """Matches forward and backward from a boundary, at most 2 * step, for periods below 2 * step.

    Forward, the words from the boundary on against those a period later; backward, the words
    before it against those a period later.
    """
    reach = 2 * step
    ahead = words[boundary : boundary + 2 * reach]
    forward = z_function(ahead, min(reach, len(ahead)))
    forward = [min(x, reach) for x in forward] + [0] * (reach - len(forward))
    before = words[max(0, boundary - reach) : boundary][::-1]
    both = words[max(0, boundary - reach) : boundary + reach][::-1]
    after = len(both) - len(before)
    # words up to ``q`` after the boundary, read backward, begin at place ``after - q`` of ``both``
    found = z_function([*before, None, *both], len(before) + 2 + after)[len(before) + 1 :]
    backward = [found[after - q] if q <= after else 0 for q in range(reach)]
    return forward, backward


class Hashed:
    """Rolling hashes of word numbers, for blocks of any length."""

    def __init__(self, words: np.ndarray):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
        size = len(words)
        powers = np.full(size, _BASE, dtype=np.uint64)
        self.back = np.full(size + 1, _BACK, dtype=np.uint64)
        powers[:1] = self.back[0] = 1
        np.cumprod(powers, out=powers)
        np.cumprod(self.back, out=self.back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * powers)))

    def candidates(self, step: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries and periods from ``step`` on whose blocks on both sides match by hash."""
        size = upto - step + 1
        if upto < LEAST_POWER * step:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        blocks = self.sums[step : upto + 1] - self.sums[:size]
        blocks *= self.back[:size]
        blocks = np.concatenate((blocks, np.zeros(-size % step, np.uint64))).reshape(-1, step)
        match = blocks[1:] == blocks[:-1, :1]
        k, j = np.nonzero(match[:-1] & match[1:])
        return (k + 1) * step, j + step


def stitched(
    periods: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of one period that touch or overlap are one."""
    if not len(periods):
        return periods, starts, ends
    order = np.lexsort((starts, periods))
    periods, starts, ends = periods[order], starts[order], ends[order]
    # periods are shifted apart so that one running maximum serves all of them
    apart = periods * (int(ends.max()) + 2)
    reached = np.maximum.accumulate(ends + apart)
    new = np.concatenate(([True], (starts + apart)[1:] > reached[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(new)])) - 1
    return periods[first], starts[first], reached[last] - apart[first]


def fragments(
    words: np.ndarray, levels: range, sizes: Callable[[int], int] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Periods of the octaves ``levels``, and where words match those a period later: start, end.

    Fragments of this array that touch are one. ``sizes`` tells how many of the first words
    count in an octave. A tile within a fragment of a smaller octave is passed over: its matches
    are multiples of that period.
    """
    hashed, parts = Hashed(words), []
    lower = np.zeros((2, 0), dtype=np.int64)  # stretches of words with a period of an octave before
    for level in levels:
        step, upto = 1 << level, len(words) if sizes is None else sizes(level)
        at, periods = hashed.candidates(step, upto)
        if lower.shape[1]:
            farthest = np.concatenate(([-1], np.maximum.accumulate(lower[1])))
            begun = np.searchsorted(lower[0], at - 2 * step, side="right")
            inside = farthest[begun] >= at + 4 * step
            at, periods = at[~inside], periods[~inside]
        if not len(at):
            continue
        found = []
        places, first = np.unique(at, return_index=True)
        for place, own in zip(places.tolist(), np.split(periods, first[1:]), strict=True):
            low, high = max(0, place - 2 * step), min(upto, place + 4 * step)
            forward, backward = boundary_matches(words[low:high].tolist(), place - low, step)
            for q in own.tolist():
                if forward[q] + backward[q] >= 2 * step:
                    found.append((q, place - backward[q], place + forward[q]))
        if found:
            q, low, high = stitched(*np.array(found, dtype=np.int64).T)
            parts.append((q, low, high))
            long = high - low >= least_matches(q)
            lower = np.concatenate((lower, (low[long], (high + q)[long])), axis=1)
            lower = lower[:, np.argsort(lower[0], kind="stable")]
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def primitive(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of runs (start, length, period) those within no run of a period that divides theirs, sorted.

    Such a run has the smaller period throughout.
    """
    kept: dict[int, tuple[list[int], list[int]]] = {}
    out = []
    for start, length, period in sorted(runs, key=lambda r: (r[2], r[0])):
        for q, (starts, ends) in kept.items():
            i = bisect_right(starts, start) - 1
            if q < period and period % q == 0 and i >= 0 and ends[i] >= start + length:
                break
        else:
            starts, ends = kept.setdefault(period, ([], []))
            starts.append(start)
            ends.append(start + length)
            out.append((start, length, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth[:-1]).tolist(), strict=True) if not d]


def _numbers(texts: list[list[bytes]]) -> list[np.ndarray]:
    known = defaultdict(count().__next__)
    return [np.fromiter(map(known.__getitem__, t), np.int64, len(t)) for t in texts]


def batch_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Fragments (period, start, end) of each text that are long enough for a run.

    The texts are laid end to end, longest first, with a number of its own after each, so that an
    octave looks at those it fits into.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    numbers = _numbers([texts[i] for i in order])
    flat[ends - 1] = -1 - np.arange(len(order))
    for n, end in zip(numbers, ends.tolist(), strict=True):
        flat[end - 1 - len(n) : end - 1] = n
    fit = [int((lengths >= LEAST_POWER << level).sum()) for level in range(octaves(int(lengths.max(initial=0))))]
    upto = [int(ends[n - 1]) if n else 0 for n in fit]
    q, low, high = fragments(flat, range(len(fit)), upto.__getitem__)
    whole = high - low >= least_matches(q)
    q, low, high = q[whole], low[whole], high[whole]
    owner = np.searchsorted(ends, low, side="right")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for period, a, b, i in zip(q.tolist(), low.tolist(), high.tolist(), owner.tolist(), strict=True):
        begin = int(ends[i] - lengths[i] - 1)
        out[order[i]].append((period, a - begin, b - begin))
    return out


def pieces(size: int, piece: int) -> Iterator[tuple[int, int, int, int]]:
    """First octave, octave after the last, start and end of the pieces of a text."""
    levels = octaves(size)
    low = min(levels, max(1, octaves(piece) - 4))
    bounds = [(0, low, piece), *((o, o + 1, max(piece, 32 << o)) for o in range(low, levels))]
    for first, after, stride in bounds:
        margin = 8 << (after - 1)
        for start in range(0, size, stride):
            yield first, after, max(0, start - margin), min(size, start + stride + margin)
            if start + stride + margin >= size:
                break


def _fragment_array(found: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = [f for own in found for f in own]
    names = ("period", "low", "high")
    columns = list(zip(*flat, strict=True)) or [(), (), ()]
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
    offsets = np.concatenate(([0], np.cumsum([len(own) for own in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _words(column: pa.Array, keys: pa.Array, change: Change | None) -> list[list[bytes]]:
    """``[^\\x20\\x09-\\x0D]+`` of each text, which are the bytes that bytes.split() parts."""
    texts = [(t or b"").split() for t in column.cast(pa.binary()).to_pylist()]
    if change:
        texts = [change(k, w) for k, w in zip(keys.to_pylist(), texts, strict=True)]
    return texts


def _sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def with_runs(
    df: DataFrame,
    key: str,
    text: str,
    change: Change | None = None,
    digest: bool = False,
    piece: int = PIECE_WORDS,
) -> DataFrame:
    """One row per row of ``df``: the key, its runs, and the text without their repetitions.

    ``runs`` is an array of ``start, length, period`` by start, then period (words count from
    zero); ``kept`` has the words that no run contains after its first period, joined by one
    space, or with ``digest`` the SHA-256 of that in hex digits, so that texts without runs are not
    written once more. ``change`` gives the words that take the place of a row's own. Null and
    empty texts have no words and no runs; rows without a key and rows with equal keys each stay, and an empty
    table gives no rows. Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    common.prepare_workers(spark)
    kind = df.schema[key].dataType
    texts = df.select(F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("t"))
    schema = StructType().add("k", kind).add("mark", LongType()).add("words", BinaryType())
    schema = schema.add("size", LongType()).add("found", _array_type())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(batch.column(2), batch.column(0), change)
            short = [i for i, w in enumerate(words) if len(w) <= piece]
            found: list = [[] for _ in words]
            texts = [b" ".join(w) for w in words]
            for i, own in zip(short, batch_runs([words[i] for i in short]), strict=True):
                found[i] = own
                if digest and not own:
                    texts[i] = _sha(texts[i])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.binary()),
                    pa.array([len(w) for w in words], pa.int64()),
                    _fragment_array(found),
                ],
                names=schema.fieldNames(),
            )

    solved = texts.mapInArrow(read, schema)
    solved = common.written(solved, "words")
    open_ = (F.size("found") > 0) | (F.col("size") > piece)
    done = solved.where(~open_).select(
        "k", F.array().cast(_runs_type()).alias("runs"), F.col("words").alias("kept")
    )

    short = solved.select("k", "mark", F.explode("found").alias("f")).select("k", "mark", "f.*")
    long = solved.where(F.col("size") > piece).dropDuplicates(["k", "mark"]).select("k", "mark", "words")
    cut = long.mapInArrow(_cut(kind, piece), _cut_schema(kind))
    dealt = cut.repartition(F.xxhash64("k", "mark", "first", "start"))
    far = dealt.mapInArrow(_solve(kind), _far_schema(kind))
    found = short.union(far).distinct()

    order = Window.partitionBy("k", "mark", "period").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = found.withColumn("new", F.when(F.col("low") <= reached, 0).otherwise(1))
    parted = parted.withColumn("run", F.sum("new").over(order))
    runs = parted.groupBy("k", "mark", "period", "run")
    runs = runs.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    enough = F.greatest(LEAST_WORDS - F.col("period"), (LEAST_POWER - 1) * F.col("period"))
    runs = runs.where(F.col("high") - F.col("low") >= enough)
    one = F.struct(
        F.col("low").alias("start"),
        (F.col("high") - F.col("low") + F.col("period")).alias("length"),
        "period",
    )
    each = runs.groupBy(F.col("k").alias("rk"), F.col("mark").alias("rmark"))
    each = each.agg(F.collect_list(one).alias("runs"))
    same = F.col("k").eqNullSafe(F.col("rk")) & (F.col("mark") == F.col("rmark"))
    met = solved.where(open_).join(each, same, "left").select("k", "runs", "words")
    schema = StructType().add("k", kind).add("runs", _runs_array()).add("kept", BinaryType())
    ended = met.mapInArrow(_collapse(schema, digest), schema)
    out = done.union(ended)
    return out.select(F.col("k").alias(key), "runs", F.col("kept").cast("string").alias("kept"))


def _array_type() -> ArrayType:
    fields = StructType().add("period", LongType()).add("low", LongType()).add("high", LongType())
    return ArrayType(fields)


def _runs_array() -> ArrayType:
    fields = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
    return ArrayType(fields)


def _runs_type() -> str:
    return _runs_array().simpleString()


def _cut_schema(kind) -> StructType:
    schema = StructType().add("k", kind).add("mark", LongType()).add("first", IntegerType())
    return schema.add("after", IntegerType()).add("start", LongType()).add("numbers", BinaryType())


def _cut(kind, piece: int):
    names = _cut_schema(kind).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (numbers,) = _numbers([batch.column(2)[i].as_py().split()])
                numbers = numbers.astype("<i4")
                for first, after, start, end in pieces(len(numbers), piece):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(i, 1),
                            batch.column(1).slice(i, 1),
                            pa.array([first], pa.int32()),
                            pa.array([after], pa.int32()),
                            pa.array([start], pa.int64()),
                            pa.array([numbers[start:end].tobytes()], pa.binary()),
                        ],
                        names=names,
                    )

    return run


def _far_schema(kind) -> StructType:
    schema = StructType().add("k", kind).add("mark", LongType()).add("period", LongType())
    return schema.add("low", LongType()).add("high", LongType())


def _solve(kind):
    names = _far_schema(kind).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first, after, start, data = (batch.column(c)[i].as_py() for c in range(2, 6))
                words = np.frombuffer(data, "<i4").astype(np.int64)
                found = fragments(words, range(first, after))
                rows = pa.array(np.full(len(found[0]), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(found[0]),
                        pa.array(found[1] + start),
                        pa.array(found[2] + start),
                    ],
                    names=names,
                )

    return run


def _collapse(schema: StructType, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for runs, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = primitive([(r["start"], r["length"], r["period"]) for r in runs or []])
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                left = b" ".join(collapsed(words.split(), own))
                kept.append(_sha(left) if digest else left)
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(kept, pa.binary())],
                names=schema.fieldNames(),
            )

    return run
