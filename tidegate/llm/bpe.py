"""Byte-level BPE encoding and decoding by tree concatenation.

A text is halved until its pieces are short. Pieces are encoded alone, and two neighbours are
joined by encoding a window around their border anew: if the window's first token is the left
side's token at that place and its last token the right side's, the left side up to the window,
the window and the right side after it are exactly the encoding of both together. Otherwise the
window grows, in the end to all of both.

Why this is exact: a run of tokens is the encoding of its text if and only if each two
neighbouring tokens are the encoding of theirs. Every neighbouring pair of the result stands in
one of the three encodings. Word borders agree as the pattern reads from left to right and its
words are runs of one kind of character. Where a shorter context could be read as other words a
window neither begins nor ends: at an apostrophe, which may begin a short word of its own, and after
white space, whose last character may belong to the word that follows.

Very long texts are cut by Spark into pieces for different tasks; only the joining of one text's
pieces, short work around the borders, is one task's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import common
from tidegate.llm.words import byte_words, open_tokenizer, token_bytes

#: Bytes up to which a piece is encoded alone.
LEAF_BYTES = 4096
#: Characters from which a text is dealt to several tasks, and those of each of its parts.
LONG_CHARS, PART_CHARS = 262_144, 65_536
#: Tokens on each side of a border that are encoded anew at first.
WINDOW_TOKENS = 6
APOSTROPHE = 0x27

Encode = Callable[[list[str]], list[np.ndarray]]


class Table:
    """One byte string for each id, to be looked up for many ids at once."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[np.arange(ends[-1]) + shift].tobytes()


class Codec:
    """Encodes and decodes with one tokenizer file, given as its text."""

    def __init__(self, content: str):
        tokenizer = open_tokenizer(content)
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        strings = token_bytes(tokenizer)
        self.bytes = Table(strings)
        self.decimals = Table([b"%d," % i for i in range(len(strings))])
        self.leaves: Encode = byte_words(tokenizer).encode

    def encode(self, texts: list[str], leaf_bytes: int = LEAF_BYTES) -> list[np.ndarray]:
        return encode_tree(texts, self.leaves, self.bytes.lengths, self.special, leaf_bytes)

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes.join(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """Decimal ids, joined by commas."""
        return self.decimals.join(ids)[:-1]


def halves(start: int, end: int, data: bytes, leaf_bytes: int) -> list[tuple[int, int]]:
    """Borders of the leaves of ``data[start:end]``, each at the begin of a character."""
    if end - start <= leaf_bytes:
        return [(start, end)]
    middle = (start + end) // 2
    while middle < end and data[middle] & 0xC0 == 0x80:
        middle += 1
    if middle == end:
        return [(start, end)]
    return halves(start, middle, data, leaf_bytes) + halves(middle, end, data, leaf_bytes)


def _spaced(end: bytes) -> bool:
    return end.decode("utf-8", "ignore")[-1:].isspace()


def joined(
    data: bytes,
    left: tuple[int, int, np.ndarray],
    right: tuple[int, int, np.ndarray],
    encode: Encode,
    lengths: np.ndarray,
) -> tuple[int, int, np.ndarray]:
    """The encoding of two neighbouring pieces from the encodings of each."""
    (start, border, a), (_, end, b) = left, right
    if not len(a) or not len(b):
        return start, end, a if len(a) else b
    count = WINDOW_TOKENS
    while True:
        i = max(0, len(a) - count)
        begin = border - int(lengths[a[i:]].sum())
        while i and (data[begin] & 0xC0 == 0x80 or data[begin] == APOSTROPHE):
            i -= 1
            begin -= int(lengths[a[i]])
        j = min(len(b), count)
        stop = border + int(lengths[b[:j]].sum())
        while j < len(b) and (data[stop] & 0xC0 == 0x80 or _spaced(data[max(0, stop - 3) : stop])):
            stop += int(lengths[b[j]])
            j += 1
        window = encode([data[begin:stop].decode("utf-8")])[0]
        same_left = i == 0 or (len(window) and window[0] == a[i])
        apostrophe = data[stop - int(lengths[b[j - 1]])] == APOSTROPHE
        same_right = j == len(b) or (
            len(window) and window[-1] == b[j - 1] and not apostrophe
        )
        if same_left and same_right:
            return start, end, np.concatenate((a[:i], window, b[j:]))
        count *= 2


def tree(data: bytes, pieces: list[tuple[int, int, np.ndarray]], encode: Encode, lengths):
    """Ids of neighbouring pieces, joined in pairs level by level."""
    while len(pieces) > 1:
        paired = [
            joined(data, pieces[k], pieces[k + 1], encode, lengths)
            for k in range(0, len(pieces) - 1, 2)
        ]
        pieces = paired + pieces[2 * len(paired) :]
    return pieces[0][2]


def encode_tree(
    texts: list[str], encode: Encode, lengths: np.ndarray, special: dict[str, int], leaf_bytes: int
) -> list[np.ndarray]:
    """Ids of each text; ``special`` strings in a text are their ids, and split it."""
    plans, leaves = [], []
    for text in texts:
        if any(s in text for s in special):
            parts = split_special(text, special)
        else:
            parts = [text]
        plan = []
        for part in parts:
            if isinstance(part, int):
                plan.append(part)
                continue
            data = part.encode("utf-8")
            borders = halves(0, len(data), data, leaf_bytes)
            plan.append((data, borders, len(leaves)))
            if len(borders) == 1:
                leaves.append(part)
            else:
                leaves.extend(data[i:j].decode("utf-8") for i, j in borders)
        plans.append(plan)
    encoded = encode(leaves)
    out = []
    for plan in plans:
        runs = []
        for part in plan:
            if isinstance(part, int):
                runs.append(np.array([part], dtype="<u4"))
                continue
            data, borders, at = part
            pieces = [(i, j, encoded[at + k]) for k, (i, j) in enumerate(borders)]
            runs.append(tree(data, pieces, encode, lengths))
        out.append(runs[0] if len(runs) == 1 else np.concatenate(runs))
    return out


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """Text between special strings, and their ids; the leftmost goes first, then the longest."""
    parts: list[str | int] = []
    while True:
        found = [(at, -len(s), s) for s in special if (at := text.find(s)) >= 0]
        if not found:
            return [*parts, text]
        at, _, string = min(found)
        parts += [text[:at], special[string]]
        text = text[at + len(string) :]


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """This worker's codec for a broadcast tokenizer file."""
    content = shared.value
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def share_file(spark, path: str):
    """Broadcast a tokenizer file, a few MB whatever the input."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def encode_texts(df: DataFrame, text: str, path: str, ids: str = "ids") -> DataFrame:
    """Add the ids of each row's text as a list; a null text counts as empty, all rows stay.

    The column must not be there already. Repeated rows each get their ids, an empty table stays
    empty, and the ids of a text do not depend on how it was cut.
    """
    if ids in df.columns:
        raise ValueError(f"the table has a column {ids} already")
    spark = df.sparkSession
    common.prepare_workers(spark)
    shared, long = share_file(spark, path), _is_long(text)
    short = _map_ids(df.where(~long), text, shared, ids)
    return short.union(_long_ids(df.where(long), text, shared, ids))


def _is_long(text: str):
    return F.coalesce(F.length(F.col(text)), F.lit(0)) > LONG_CHARS


def _long_ids(df: DataFrame, text: str, shared, ids: str) -> DataFrame:
    """As :func:`encode_texts`, each text cut into parts for several tasks; equal texts once."""
    fields = df.schema.fieldNames()
    long = df.withColumn("__digest", F.sha2(F.col(text), 256))
    texts = long.select("__digest", F.col(text).alias("__text")).dropDuplicates(["__digest"])
    count = F.expr(f"int((length(__text) - 1) div {PART_CHARS})")
    parts = texts.select(
        "__digest", "__text", F.explode(F.sequence(F.lit(0), count)).alias("__part")
    ).select(
        "__digest",
        "__part",
        F.expr(f"substring(__text, __part * {PART_CHARS} + 1, {PART_CHARS})").alias("__text"),
    )
    encoded = _map_ids(parts.repartition("__digest", "__part"), "__text", shared, "__ids")
    gathered = encoded.groupBy("__digest").agg(
        F.sort_array(F.collect_list(F.struct("__part", "__text", "__ids"))).alias("__parts")
    )

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        schema = pa.schema([("__digest", pa.string()), ("__ids", pa.list_(pa.int32()))])
        for batch in batches:
            for digest, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = join_encoded(codec, [(p["__text"], p["__ids"]) for p in parts])
                yield _rows(schema, [[digest], [found.astype(np.int32)]])

    whole = gathered.mapInArrow(join_parts, "__digest string, __ids array<int>")
    return long.join(whole, "__digest").select(*fields, F.col("__ids").alias(ids))


def join_encoded(codec: Codec, parts: list[tuple[str, list[int]]]) -> np.ndarray:
    """Ids of a text from those of its parts."""
    if any(s in (whole := "".join(t for t, _ in parts)) for s in codec.special):
        return codec.encode([whole])[0]  # a special string may lie across a border
    data, pieces, at = whole.encode("utf-8"), [], 0
    for text, ids in parts:
        end = at + len(text.encode("utf-8"))
        pieces.append((at, end, np.array(ids, dtype="<u4")))
        at = end
    return tree(data, pieces, codec.leaves, codec.bytes.lengths)


def _map_ids(df: DataFrame, text: str, shared, ids: str) -> DataFrame:
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    schema = StructType([*df.schema.fields]).add(ids, ArrayType(IntegerType()))
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            found = codec.encode(texts)
            flat = np.concatenate(found) if found else np.zeros(0, "<u4")
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, column], names=[*batch.schema.names, ids]
            )

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, ids: str, path: str, text: str = "decoded") -> DataFrame:
    """Add the text of each row's ids; null ids give the empty text, unknown ids nothing."""
    from pyspark.sql.types import StringType, StructType

    if text in df.columns:
        raise ValueError(f"the table has a column {text} already")
    spark = df.sparkSession
    common.prepare_workers(spark)
    shared, place = share_file(spark, path), df.columns.index(ids)
    schema = StructType([*df.schema.fields]).add(text, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        size = len(codec.bytes.lengths)
        for batch in batches:
            texts = []
            for row in batch.column(place).to_pylist():
                found = np.array([i for i in row or [] if i is not None and 0 <= i < size], dtype=np.int64)
                texts.append(codec.decode(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text]
            )

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, key: str, text: str, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: key, ``keep``, ``n_tokens``, and digests of its ids and of the text decoded from them.

    ``ids_sha256`` is that of the decimal ids joined by commas, ``decoded_sha256`` that of the
    decoded text in UTF-8. Null texts count as empty; rows, repeated or without a key, all stay.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    spark = df.sparkSession
    common.prepare_workers(spark)
    names = [key, *keep]
    source = df.select(*[F.col(n) for n in names], F.col(text).alias("__text"))
    long = _is_long("__text")
    shared = share_file(spark, path)
    digests = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    schema = StructType([*[source.schema[n] for n in names], *digests])

    def digest(codec: Codec, ids: np.ndarray) -> tuple[int, str, str]:
        return (
            len(ids),
            hashlib.sha256(codec.decimal(ids)).hexdigest(),
            hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest(),
        )

    def out(batch: pa.RecordBatch, rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
        kept = [batch.column(i) for i in range(len(names))]
        made = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        return pa.RecordBatch.from_arrays([*kept, *made], names=schema.fieldNames())

    def from_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names)).to_pylist()]
            yield out(batch, [digest(codec, ids) for ids in codec.encode(texts)])

    def from_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            lists = batch.column(len(names))
            yield out(
                batch,
                [digest(codec, lists[i].values.to_numpy().astype("<u4")) for i in range(len(lists))],
            )

    short = source.where(~long).mapInArrow(from_texts, schema)
    dealt = _long_ids(source.where(long), "__text", shared, "__ids")
    return short.union(dealt.drop("__text").mapInArrow(from_ids, schema))
