"""Files whose records may span lines, read by many tasks: quoted CSV and JSON arrays.

Where a split starts, only what came before tells whether it starts inside quotes. Each split is
scanned once for what it does to either state: it ends inside quotes or not when it starts inside,
and when it starts outside. These functions are composed in the order of the splits of a file,
which is a row a split, and give every split its state. Then splits are cut into records alone.
The record across the border of two splits (or of more) comes in fragments, which are put together.

For a split the lines of text of Spark's own text reader are taken in their order; no text is
shuffled but the fragments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.functions.jsontext import is_json
from tidegate.session import work_folder

#: A piece of a record: whole, begun and not ended in its split, ended there, or neither.
WHOLE, BEGUN, ENDED, WITHIN = 0, 1, 2, 3
_PLACE = ["path", "block"]
_RECORDS = "path string, block long, kind int, first boolean, value string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def start_states(splits: DataFrame) -> DataFrame:
    """``start`` (0 or 1) of each split ``path, block, end0, end1``.

    A split either sets the state, whatever it was, or keeps it or turns it around. The state
    before a split is what the last split that sets it left, turned around as often as since then.
    """
    turns = F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0)
    order = Window.partitionBy("path").orderBy("block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.withColumn("_turns", F.sum(turns).over(upto))
    plain = F.when(F.col("end0") == F.col("end1"), (F.col("end0") + F.col("_turns")) % 2)
    since = F.coalesce(F.lag("_turns").over(order), F.lit(0))
    start = (F.coalesce(F.last(plain, ignorenulls=True).over(before), F.lit(0)) + since) % 2
    return counted.withColumn("start", start.cast("int")).drop("_turns")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _joined(fragments: DataFrame, glue: str) -> DataFrame:
    """Records of the fragments, from where one begins to where it ends."""
    order = Window.partitionBy("path").orderBy("block", F.desc(F.col("kind") != BEGUN))
    number = F.sum(F.when(F.col("kind") == BEGUN, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    parts = F.sort_array(F.collect_list(F.struct("block", (F.col("kind") == BEGUN).alias("late"), "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"]), glue)
    grouped = fragments.withColumn("_number", number).groupBy("path", "_number")
    joined = grouped.agg(F.min("block").alias("block"), F.max("first").alias("first"), text.alias("value"))
    return joined.select("path", "block", "first", "value")


# -- quoted CSV -------------------------------------------------------------------------------


def ends_quoted(line: Column, delimiter: str, quote: str, escape: str) -> Column:
    """Whether a line that starts outside quotes ends inside them.

    A quote opens a field only at its start. What follows a closing quote belongs to the field up
    to the delimiter, as in Spark's reader.
    """
    d, q, e = (re.escape(x) for x in (delimiter, quote, escape))
    if escape == quote:
        body = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    else:
        body = f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
    plain = f"(?:(?!{d}).)*+" if len(delimiter) > 1 else f"[^{d}]*+"
    field = f"(?:{q}{body}{q}{plain}|(?!{q}){plain})"
    return F.rlike(line, F.lit(f"(?s)^(?:{field}{d})*+{q}{body}$"))


def csv_records(
    spark: SparkSession, path: str | list[str], delimiter: str = ",", quote: str = '"', escape: str = '"'
) -> DataFrame:
    """``path, block, first, value``: records of CSV files, with the line breaks inside quotes.

    ``first`` marks the first record of a file. Line breaks are line feeds, with or without a
    carriage return before them; empty lines outside quotes give no record. A file that ends
    inside quotes ends its last record. Files must be UTF-8 and not compressed.
    """
    lines = _lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    inside = F.concat(F.lit(quote), "value")
    flagged = lines.select(
        "path",
        "block",
        ends_quoted(F.col("value"), delimiter, quote, escape).cast("tinyint").alias("end0"),
        ends_quoted(inside, delimiter, quote, escape).cast("tinyint").alias("end1"),
        "value",
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, end0, end1 = None, 0, 1

        def row():
            columns = [[place[0]], [place[1]], [end0], [end1]]
            types = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["path", "block", "end0", "end1"],
            )

        for batch in batches:
            blocks = batch.column(1).to_numpy()
            paths = batch.column(0)
            f0, f1 = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            names = np.asarray(paths.dictionary_encode().indices)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(names) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if low == high:
                    continue
                here = (paths[int(low)].as_py(), int(blocks[low]))
                if here != place:
                    if place is not None:
                        yield row()
                    place, end0, end1 = here, 0, 1
                a, b = f0[low:high], f1[low:high]
                sets = np.flatnonzero(a == b)
                if len(sets):
                    end0 = end1 = int(a[sets[-1]])
                    a, b = a[sets[-1] + 1 :], b[sets[-1] + 1 :]
                turns = int(((a == 1) & (b == 0)).sum()) % 2
                end0, end1 = end0 ^ turns, end1 ^ turns
        if place is not None:
            yield row()

    schema = "path string, block long, end0 int, end1 int"
    splits = flagged.drop("value").mapInArrow(fold, schema)
    splits = _written(splits, "split-states")
    started = start_states(splits)
    ends = F.when(F.col("start") == 1, F.col("end1")).otherwise(F.col("end0"))
    odd = started.select(*_PLACE, "start", ends.alias("end")).where("start = 1 or end = 1")
    odd = _written(odd, "open-splits")  # a row a split at most

    def cut(fragments: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["path", "block", "kind", "first", "value"]
            place, state, held, kind, is_first, seen = None, 0, [], WHOLE, False, False

            def out(rows):
                columns = list(zip(*rows, strict=True)) or [()] * 5
                types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

            def ended():
                """What is held when a split ends."""
                if place is None or not (state or held) or not fragments:
                    return []
                return [(*place, WITHIN if kind == ENDED else BEGUN, is_first, "\n".join(held))]

            for batch in batches:
                blocks, paths = batch.column(1).to_numpy(), batch.column(0)
                f0, f1 = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                starts, values = batch.column(5), batch.column(4)
                order = np.asarray(paths.dictionary_encode().indices)
                cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(order) != 0)) + 1
                rows, whole = [], np.zeros(len(blocks), dtype=bool)
                firsts = np.zeros(len(blocks), dtype=bool)
                for low, high in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                    if low == high:
                        continue
                    here = (paths[int(low)].as_py(), int(blocks[low]))
                    if here != place:
                        rows += ended()
                        place, state = here, starts[int(low)].as_py() or 0
                        held, kind, is_first, seen = [], ENDED if state else WHOLE, False, here[1] > 0
                    a, b = f0[low:high], f1[low:high]
                    # the state before each line: of the last that sets it, turned since
                    turns = np.concatenate(([0], np.cumsum((a == 1) & (b == 0))))
                    last = np.maximum.accumulate(np.where(a == b, np.arange(len(a)), -1))
                    after = np.where(last >= 0, a[last] + turns[1:] - turns[last + 1], state + turns[1:]) % 2
                    before = np.concatenate(([state], after[:-1]))
                    single = (before == 0) & (after == 0)
                    whole[low:high] = single
                    if not seen and single[0]:
                        firsts[low] = seen = True
                    for i in np.flatnonzero(~single).tolist():
                        if before[i] == 0:
                            held, kind, is_first = [], WHOLE, not seen and i == 0
                        held.append(values[int(low) + i].as_py())
                        if after[i] == 0:
                            if (kind == ENDED) == fragments:
                                rows.append((*place, kind, is_first, "\n".join(held)))
                            held, kind = [], WHOLE
                    seen, state = True, int(after[-1])
                if not fragments:
                    kept = batch.select([0, 1, 4]).filter(pa.array(whole))
                    kinds = pa.array(np.zeros(kept.num_rows, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(0), kept.column(1), kinds, pa.array(firsts[whole]), kept.column(2)],
                        names=names,
                    )
                yield out(rows)
            yield out(ended())

        return run

    marked = flagged.select(*_PLACE, "end0", "end1", "value")
    started = F.broadcast(odd.select(*_PLACE, "start"))
    records = marked.join(started, _PLACE, "left").mapInArrow(cut(False), _RECORDS)
    records = records.select("path", "block", "first", "value")
    if not odd.isEmpty():
        some = marked.join(started, _PLACE).mapInArrow(cut(True), _RECORDS)
        records = records.union(_joined(some, "\n"))
    return records.where("value != ''")


def read_quoted_csv(
    spark: SparkSession,
    path: str | list[str],
    options: dict[str, str],
    schema: StructType | str | None = None,
) -> DataFrame:
    """CSV files whose quoted values may hold line breaks, each read by many tasks.

    ``options`` are those of Spark's reader; ``sep``, ``quote``, ``escape`` and ``header`` are
    used here as well. Column names come from the header of the first file that has one.
    """
    quote = options.get("quote", '"')
    records = csv_records(spark, path, options.get("sep", ","), quote, options.get("escape", "\\"))
    plain = {k: v for k, v in options.items() if k not in ("header", "multiLine", "inferSchema")}
    names = None
    if options.get("header", "false") == "true":
        first = records.where("first").select("path", "value").orderBy("path").limit(1)
        head = _parsed(spark.read.options(**plain, header="true"), first.select("value"))
        names = head.columns
        records = records.where("not first")
    reader = spark.read.options(**plain, header="false")
    if schema is not None:
        return _parsed(reader.schema(schema), records.select("value"))
    read = _parsed(reader.option("inferSchema", "true"), records.select("value"))
    if names is not None and not read.columns:  # no record at all
        return spark.createDataFrame([], StructType().add("x", "string")).select(
            *(F.col("x").alias(n) for n in names)
        )
    return read.toDF(*names) if names is not None else read


def _parsed(reader, texts: DataFrame) -> DataFrame:
    """Spark's own parser over records held as text."""
    encoder = texts.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING()
    return DataFrame(reader._jreader.csv(getattr(texts._jdf, "as")(encoder)), texts.sparkSession)


# -- JSON arrays ------------------------------------------------------------------------------

#: Text before or after an array, and where an array ends.
OUTSIDE, CLOSED = 4, 5


def _pieces(spark: SparkSession, path: str | list[str], only: DataFrame | None) -> DataFrame:
    """``path, block, value, octets, size``: text up to each closing brace, in its order."""
    read = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    pieces = read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        (F.octet_length("value") + 1).cast("long").alias("octets"),
        F.col("_metadata.file_size").alias("size"),
    )
    if only is not None:  # a row a file at most; a join by broadcast keeps the order
        pieces = pieces.join(F.broadcast(only.select("path").distinct()), "path", "left_semi")
    return pieces


def _brackets(pieces: DataFrame) -> DataFrame:
    """What each split does: its last state for either first one, how much deeper it ends, its
    bytes and those of the file."""
    names = ["path", "block", "end0", "end1", "deep0", "deep1", "octets", "size"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        string = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
        place, state, deep, octets, size = None, [0, 1], [0, 0], 0, 0

        def effect(text: str) -> tuple[int, int]:
            """Whether a text ends inside a string, and how much deeper, with the brace after it."""
            bare = string.sub("", text)
            at = bare.find('"')
            if at >= 0:
                bare = bare[:at]
            deeper = bare.count("[") + bare.count("{") - bare.count("]") - bare.count("}")
            return int(at >= 0), deeper - (at < 0)

        def row():
            values = [*place, *state, *deep, octets, size]
            types = [pa.string(), *[pa.int64()] * 7]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names
            )

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for path, block, text, length, whole in zip(*columns, strict=True):
                if (path, block) != place:
                    if place is not None:
                        yield row()
                    place, state, deep, octets, size = (path, block), [0, 1], [0, 0], 0, whole
                octets += length
                effects: dict[int, tuple[int, int]] = {}
                for i in (0, 1):
                    s = state[i]
                    if s not in effects:
                        effects[s] = effect('"' + text if s else text)
                    state[i], deep[i] = effects[s][0], deep[i] + effects[s][1]
        if place is not None:
            yield row()

    schema = "path string, " + ", ".join(f"{n} long" for n in names[1:])
    return pieces.mapInArrow(fold, schema)


def _elements(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """``path, block, kind, first, value``: elements of the arrays, whole or in fragments, what is
    OUTSIDE, and a row where an array is CLOSED."""
    started = start_states(splits)
    deeper = F.when(F.col("start") == 1, F.col("deep1")).otherwise(F.col("deep0"))
    order = Window.partitionBy("path").orderBy("block")
    depth = F.coalesce(F.sum(deeper).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    started = _written(started.select(*_PLACE, "start", depth.alias("depth")), "split-starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[\[\]{},]', re.S)
        # an object without others in it, after the comma that ends the element before
        flat = re.compile(r'\s*,(\s*\{[^"{}\[\]]*(?:"(?:[^"\\]|\\.)*"[^"{}\[\]]*)*\})\Z', re.S)
        names = ["path", "block", "kind", "first", "value"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        place, depth, held, open_, inside = None, 0, [], False, 0
        rows: list[tuple] = []

        def out():
            columns = list(zip(*rows, strict=True)) or [()] * 5
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        def border(last: bool = False):
            """Between two elements, or where the split ends."""
            kind = (BEGUN if last else WHOLE) if open_ else (WITHIN if last else ENDED)
            rows.append((*place, kind, False, "".join(held)))
            held.clear()

        def outside(text: str):
            if text.strip():
                rows.append((*place, OUTSIDE, False, text))

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for path, block, text, start, at_depth in zip(*columns, strict=True):
                if (path, block) != place:
                    if place is not None and depth > 0:
                        border(True)
                    held.clear()
                    place, depth, open_, inside = (path, block), at_depth, False, start
                text += "}"
                if depth == 1 and not inside and (found := flat.match(text)):
                    border()
                    held.append(found.group(1))
                    open_ = True
                    continue
                # inside a string the text is read as if its quote stood before it
                done, shown = inside, '"' + text if inside else text
                inside = 0
                for found in token.finditer(shown):
                    sign = found.group()
                    if sign[0] == '"':
                        inside = int(found.end() == len(shown))
                    elif sign in "[{":
                        if depth == 0 and sign == "[":
                            outside(shown[done : found.start()])
                            done, open_ = found.end(), True
                        depth += 1
                    elif sign == ",":
                        if depth == 1:
                            held.append(shown[done : found.start()])
                            border()
                            done, open_ = found.end(), True
                    elif depth > 0:
                        depth -= 1
                        if depth == 0 and sign == "]":
                            held.append(shown[done : found.start()])
                            border()
                            rows.append((*place, CLOSED, False, ""))
                            done, open_ = found.end(), False
                if depth > 0:
                    held.append(shown[done:])
                else:
                    outside(shown[done:])
                if len(rows) >= 4096:
                    yield out()
        if place is not None and depth > 0:
            border(True)
        yield out()

    begun = pieces.join(F.broadcast(started), _PLACE)  # a row a split
    return begun.select(*_PLACE, "value", "start", "depth").mapInArrow(cut, _RECORDS)


def count_arrays(spark: SparkSession, path: str | list[str], only: DataFrame | None = None) -> DataFrame:
    """``path, records, broken`` of files that hold one JSON array each.

    Files are cut at closing braces, so an array of objects is read by many tasks, on one line or
    on many. An array is ``broken``, and its records null, if an element is no JSON value, the
    file ends within the array, or there is anything but white space around it. ``only`` has the
    paths that count.
    """
    pieces = _pieces(spark, path, only)
    splits = _written(_brackets(pieces), "split-states")
    blank = F.btrim("value", F.lit(" \t\r\n")) == ""
    whole = F.col("kind") == WHOLE
    found = _elements(pieces, splits).groupBy("path", "block", "kind")
    found = found.agg(
        F.count_if(whole).alias("n"),
        F.count_if(whole & blank).alias("blank"),
        F.count_if(whole & ~blank & ~is_json(F.col("value"))).alias("bad"),
        F.collect_list(F.when(~whole, F.col("value"))).alias("values"),
    )
    found = _written(found, "array-splits")  # texts of fragments only
    parts = found.where(F.col("kind").isin(BEGUN, ENDED, WITHIN))
    parts = parts.select("path", "block", "kind", F.lit(False).alias("first"), F.explode("values").alias("value"))
    joined = _joined(parts, "").groupBy("path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & ~is_json(F.col("value"))).alias("bad"),
    )
    closed = F.sum(F.when(F.col("kind") == CLOSED, F.size("values")).otherwise(0))
    around = F.flatten(F.collect_list(F.when(F.col("kind") == OUTSIDE, F.col("values"))))
    per_file = found.groupBy("path").agg(
        *(F.sum(c).alias(c) for c in ("n", "blank", "bad")), closed.alias("closed"), around.alias("around")
    )
    # a brace was put after the last piece of a file that does not end with one
    octets = splits.groupBy("path").agg((F.sum("octets") - F.max("size")).alias("more"))
    both = per_file.join(octets, "path").join(
        joined.toDF("path", "jn", "jblank", "jbad"), "path", "left"
    ).fillna(0, ["jn", "jblank", "jbad"])
    n, blanks = F.col("n") + F.col("jn"), F.col("blank") + F.col("jblank")
    empty = (n == 1) & (blanks == 1)
    own = F.transform("around", lambda t: F.btrim(t, F.lit(" \t\r\n")))
    alone = (F.col("more") == 1) & (F.array_join(own, "") == "}")
    right = (F.col("closed") == 1) & alone & (F.col("bad") + F.col("jbad") == 0) & (empty | (blanks == 0))
    records = F.when(right, F.when(empty, 0).otherwise(n)).cast("bigint")
    return both.select("path", records.alias("records"), records.isNull().alias("broken"))


def read_json_arrays(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of files that hold one JSON array each, by many tasks a file.

    Elements that are no JSON are read as Spark's reader reads broken records, by its ``mode``.
    """
    pieces = _pieces(spark, path, None)
    splits = _written(_brackets(pieces), "split-states")
    found = _elements(pieces, splits)
    whole = found.where(F.col("kind") == WHOLE).select("value")
    parts = found.where(F.col("kind").isin(BEGUN, ENDED, WITHIN))
    texts = whole.union(_joined(parts, "").select("value"))
    texts = texts.where(F.btrim("value", F.lit(" \t\r\n")) != "")
    plain = {k: v for k, v in (options or {}).items() if k != "multiLine"}
    reader = spark.read.options(**plain)
    if schema is not None:
        reader = reader.schema(schema)
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    return DataFrame(reader._jreader.json(getattr(texts._jdf, "as")(encoder)), spark)
