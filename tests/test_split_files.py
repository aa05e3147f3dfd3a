"""Quoted CSV and JSON arrays over many splits, against Spark's own readers of whole files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegate.sources import inventory, split_files


@pytest.fixture
def small_splits(spark):
    """Splits of few bytes, each a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(draw):
    """A value, and how a file may spell it."""
    kind = draw.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return f'5" pipe {draw.randrange(9)}'
    if kind == 2:
        return "\n".join(f"line {draw.randrange(99)}, of" for _ in range(draw.randint(2, 6)))
    if kind == 3:
        return f'said "no", then\n\n"yes" {draw.randrange(9)}'
    if kind == 4:
        return "\n".join(["a very long value", *(f"with line {i} of many" for i in range(60))]) if draw.random() < 0.1 else "x"
    if kind == 5:
        return '"'
    return "".join(draw.choice("abc ,;ü") for _ in range(draw.randint(1, 9))).strip() or "v"


def spell(value, draw, escape):
    special = any(c in value for c in ',;"\n')
    bare = not special or value.startswith("5")
    if bare and draw.random() < 0.6:
        return value
    return '"' + value.replace('"', escape + '"') + '"'


def files(folder, seed, escape='"', breaks="\n", delimiter=","):
    draw = random.Random(seed)
    for n in range(3):
        rows = [["id", "first name", "text"]]
        rows += [[str(n * 1000 + i), field(draw), field(draw)] for i in range(draw.choice([40, 120]))]
        lines = [delimiter.join(spell(v, draw, escape) for v in r) for r in rows]
        body = breaks.join(x.replace("\n", breaks) for x in lines)
        if draw.random() < 0.5:
            body += breaks
        (folder / f"part-{n}.csv").write_bytes(body.encode())
    return str(folder)


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("escape, breaks, delimiter", [('"', "\n", ","), ("\\", "\n", ","), ('"', "\r\n", ";")])
def test_csv_equals_the_whole_file_reader(spark, tmp_path, small_splits, seed, escape, breaks, delimiter):
    path = files(tmp_path, seed, escape, breaks, delimiter)
    options = {"header": "true", "sep": delimiter, "quote": '"', "escape": escape}
    want = spark.read.options(**options, multiLine="true").csv(path)
    schema = "id string, `first name` string, text string"
    got = split_files.read_quoted_csv(spark, path, options, schema)
    records = split_files.csv_records(spark, path, delimiter, '"', escape)
    assert records.select("path", "block").distinct().count() > 9
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want) and got.count() > 100


def test_csv_types_and_names(spark, tmp_path, small_splits):
    path = files(tmp_path, 9)
    options = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
    want = spark.read.options(**options, multiLine="true", inferSchema="true").csv(path)
    got = split_files.read_quoted_csv(spark, path, options)
    assert got.dtypes == want.dtypes and got.dtypes[0] == ("id", "int")
    assert rows_of(got) == rows_of(want)


def test_csv_of_little(spark, tmp_path, small_splits):
    """A header over lines, no rows, no header, a file that ends in quotes, and empty lines."""
    options = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}
    (tmp_path / "a.csv").write_text('"a\nb",c\n\n1,"x\n' + "y\n" * 500 + '"\n\n2,"z\nopen')
    got = split_files.read_quoted_csv(spark, str(tmp_path / "a.csv"), options)
    want = spark.read.options(**options, multiLine="true", inferSchema="true").csv(str(tmp_path / "a.csv"))
    assert got.columns == want.columns == ["a\nb", "c"] and got.count() == 2
    assert rows_of(got)[0] == rows_of(want)[0] and rows_of(got)[1][1] == "z\nopen"
    (tmp_path / "b.csv").write_text("a,c\n")
    got = split_files.read_quoted_csv(spark, str(tmp_path / "b.csv"), options)
    assert got.columns == ["a", "c"] and got.count() == 0
    (tmp_path / "c.csv").write_text('1,"p\nq"\n2,r\n')
    got = split_files.read_quoted_csv(spark, str(tmp_path / "c.csv"), {**options, "header": "false"})
    assert rows_of(got) == [("1", "p\nq"), ("2", "r")]


def test_states_are_composed(spark):
    """Splits that keep, set or turn the state, in every order."""
    draw = random.Random(1)
    rows, want = [], {}
    for path in range(60):
        state = 0
        for block in range(draw.randint(1, 12)):
            ends = draw.choice([(0, 1), (1, 0), (0, 0), (1, 1)])
            rows.append((str(path), block * 100, *ends))
            want[str(path), block * 100] = state
            state = ends[state]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "path string, block long, end0 int, end1 int")
    got = {(r["path"], r["block"]): r["start"] for r in split_files.start_states(df).collect()}
    assert got == want


def test_lines_that_end_quoted(spark):
    cases = {
        "a,b": False, 'a,"b': True, '"a"': False, '"a""': True, '"a"",': True, '"a""b",c': False, 'x"y': False,
        ' "a': False, '"a"b,"c': True, '"a"b"c': False, '"",""': False, '"': True, '""': False, "": False,
        '"' + "a" * 50_000 + ",": True, '"x",' * 20_000 + '"': True, '"' + '""' * 30_000: True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    found = df.select("line", split_files.ends_quoted(F.col("line"), ",", '"', '"').alias("open"))
    assert {r["line"]: r["open"] for r in found.collect()} == cases
    cases = {'"a\\"': True, '"a\\\\"': False, '"a\\",b"': False, '"a""b': False, "\\": False}
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    found = df.select("line", split_files.ends_quoted(F.col("line"), ",", '"', "\\").alias("open"))
    assert {r["line"]: r["open"] for r in found.collect()} == cases


def values(seed, count):
    draw = random.Random(seed)

    def value(depth=0):
        kind = draw.randrange(8 if depth < 3 else 5)
        if kind == 0:
            return draw.randrange(10**6)
        if kind == 1:
            return draw.choice([None, True, 1.5, "", "plain"])
        if kind in (2, 3, 4):
            return "".join(draw.choice('ab{}[]",:\\ \n}ü') for _ in range(draw.randint(0, 30)))
        if kind == 5:
            return [value(depth + 1) for _ in range(draw.randint(0, 4))]
        return {f"k{i}": value(depth + 1) for i in range(draw.randint(0, 4))}

    return [{"id": i, "text": value(3), "more": json.dumps(value())} if i % 5 else {"id": i} for i in range(count)]


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_over_many_splits(spark, tmp_path, small_splits, indent):
    want = {}
    for n, count in enumerate((0, 1, 150, 300)):
        rows = values(n, count)
        want[f"{n}.json"] = count
        (tmp_path / f"{n}.json").write_text(" \n" * (n % 2) + json.dumps(rows, indent=indent) + "\n " * (n % 3))
    counts = split_files.count_arrays(spark, str(tmp_path))
    assert {r["path"].rsplit("/", 1)[1]: r["records"] for r in counts.collect()} == want
    schema = "id long, text string, more string"
    got = split_files.read_json_arrays(spark, str(tmp_path), schema)
    assert rows_of(got) == rows_of(spark.read.schema(schema).json(str(tmp_path), multiLine=True))
    assert got.count() == 451


@pytest.mark.parametrize(
    "text, records",
    [
        ("[]", 0), (" [ ]\n", 0), ("[1, 2,3]", 3), ('["}", "]", "[{\\""]', 3), ("[[1,2],[3]]", 2), ('[{"a":{}}]', 1),
        ("[1,,2]", None), ("[1,]", None), ("[1", None), ("[1] x", None), ("x [1]", None), ("[1][2]", None),
        ("[1]]", None), ("[1]}", None), ('["a]', None), ("[{]}", None), ("[tru]", None), ('[{"a":1}', None), ("]", None),
        ('{"a":[1]}', None), ("[{},{}]}", None), ('[{"a":"\\u00e9"}, null, true, -1.5e3]', 4),
    ],
)
def test_arrays_and_what_is_none(spark, tmp_path, text, records):
    (tmp_path / "a.json").write_text(text)
    (row,) = split_files.count_arrays(spark, str(tmp_path)).collect()
    assert (row["records"], row["broken"]) == (records, records is None)


def test_counts_beside_lines(spark, tmp_path, small_splits):
    """The counter of JSON files of any kind uses splits for arrays over several lines."""
    (tmp_path / "a.json").write_text(json.dumps(values(1, 90), indent=1))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(r) for r in values(2, 50)))
    (tmp_path / "c.json").write_text(json.dumps(values(3, 20)))
    (tmp_path / "d.json").write_text(json.dumps(values(4, 20), indent=1)[:-9])
    found = {r["path"].rsplit("/", 1)[1]: (r["records"], r["error"]) for r in inventory.count_json(spark, str(tmp_path)).collect()}
    assert found == {"a.json": (90, None), "b.json": (50, None), "c.json": (20, None), "d.json": (None, "failed to parse JSON array")}
