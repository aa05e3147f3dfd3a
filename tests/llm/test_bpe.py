import hashlib
import os
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegate.llm import bpe, token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def codec():
    with open(FILE, encoding="utf-8") as file:
        return bpe.Codec(file.read())


ALPHABETS = [
    "ab",
    " a",
    " \n\ta'st",
    "'s ll re!?,",
    "aeiou rstln",
    "0123456789 .",
    "é漢🙂́ \xa0 a",
    "\x1c\x1d\x85​ a\r\n",
    "=-_*#<|>",
]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_tree_equals_whole(codec, whole, alphabet):
    draw = random.Random(alphabet)
    for _ in range(60):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 300)))
        for leaf in (4, 9, 40):
            (ids,) = codec.encode([text], leaf)
            assert ids.tolist() == whole(text), (leaf, text)
            assert codec.decode(ids) == text


def test_unsplit_text(codec, whole):
    draw = random.Random(5)
    text = "".join(draw.choice("acgt") for _ in range(20_000))
    for text in (text, "a" * 5_000, " " * 3_000 + "x", "'" * 700 + "s", "ab" * 2_000):
        assert codec.encode([text], 64)[0].tolist() == whole(text)


def test_special_strings(codec, whole):
    for text in ("<|endoftext|>", "a  <|endoftext|> b<|endoftext|><|endoftext|", "<|endoftext|>" * 40):
        ids = codec.encode([text], 8)[0]
        assert ids.tolist() == whole(text)
        assert codec.decode(ids) == text


def expected(whole, text):
    ids = whole(text or "")
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


@pytest.mark.parametrize("long_chars", [bpe.LONG_CHARS, 50])
def test_round_trip(spark, awkward, nothing, whole, monkeypatch, long_chars):
    monkeypatch.setattr(bpe, "LONG_CHARS", long_chars)
    monkeypatch.setattr(bpe, "PART_CHARS", 13 if long_chars == 50 else bpe.PART_CHARS)
    found = bpe.round_trip(awkward, "doc_id", "text", FILE, keep=("score",))
    assert found.columns == ["doc_id", "score", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [(r["doc_id"], r["score"], *expected(whole, r["text"])) for r in awkward.collect()]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert bpe.round_trip(nothing, "doc_id", "text", FILE).count() == 0


def test_ids_and_back(awkward, whole):
    encoded = bpe.encode_texts(awkward, "text", FILE)
    rows = bpe.decode_ids(encoded, "ids", FILE).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r["ids"] == whole(r["text"] or "")
        assert r["decoded"] == (r["text"] or "")
    with pytest.raises(ValueError):
        bpe.encode_texts(encoded, "text", FILE)


# -- token files --------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_token_files(spark, awkward, tmp_path):
    import zlib

    import numpy as np

    tokenizer = Tokenizer.from_file(WORDS)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(awkward, "doc_id", "text", WORDS, path, end_id=1)
    read = token_files.read_tokens(spark, path)
    rows = sorted(
        read.select("doc_id", "start", "n_tokens", "tokens").collect(), key=lambda r: r["start"]
    )
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    start = 0
    texts = {(r["doc_id"], r["text"]) for r in awkward.collect()}
    ids = {
        (k, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,)) for k, t in texts
    }
    for r in rows:
        assert r["start"] == start and r["n_tokens"] == len(r["tokens"])
        assert (r["doc_id"], tuple(r["tokens"])) in ids
        start += r["n_tokens"]
    sums = token_files.token_digests(read.select("start", "tokens")).collect()
    want = {r["start"]: zlib.crc32(np.array(r["tokens"], "<u4").tobytes()) for r in rows}
    assert {r["start"]: r["ids_crc32"] for r in sums} == want


def test_token_files_of_nothing(spark, nothing, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(nothing, "doc_id", "text", WORDS, path, end_id=1)
    assert token_files.read_tokens(spark, path).count() == 0


def test_counts_are_read_without_tokens(spark, awkward, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(awkward, "doc_id", "text", WORDS, path)
    plan = token_files.read_tokens(spark, path).where("doc_id = 5").select("start")
    scans = [
        line
        for line in plan._jdf.queryExecution().executedPlan().toString().splitlines()
        if "ReadSchema" in line
    ]
    assert scans and not any("tokens:array" in line for line in scans)
    assert any("EqualTo(doc_id,5)" in line for line in scans)


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_words_equal_whole(alphabet):
    from tidegate.llm.words import open_tokenizer, spaced_words

    with open(WORDS, encoding="utf-8") as file:
        tokenizer = open_tokenizer(file.read())
    words, draw = spaced_words(tokenizer), random.Random(alphabet)
    texts = ["".join(draw.choice(alphabet + " \x01A") for _ in range(50)) for _ in range(80)]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_latin_words_are_cut_before_the_tokenizer(monkeypatch):
    """Equal to whole texts for every character of the kind, and none is normalized by the tokenizer."""
    from tidegate.llm import words as words_of

    with open(WORDS, encoding="utf-8") as file:
        tokenizer = words_of.open_tokenizer(file.read())
    words, draw = words_of.spaced_words(tokenizer), random.Random(5)
    codes = [*range(9, 14), *range(32, 127), *range(0xC0, 0x180), *range(0x2010, 0x2028)]
    kind = [chr(c) for c in codes if c not in (0xD7, 0xF7, 0x130)]
    texts = [f"a{c}B{c}{c} '{c}s 12{c}'S.{c}" for c in kind] + ["", "it's IT'S '' 'd.'re", "Élan ŸŸ—“x” 3½"]
    texts += ["".join(draw.choice(kind + ["'", "s", "E", "'re"] * 9) for _ in range(60)) for _ in range(200)]
    odd = ["a<|endoftext|>b ß", "İstanbul ΣΑΣ e\u0301", "x\x1cy", "x\x85y ª² \u202f", "中文 Latin words"]
    for text, ids in zip(texts + odd, words.encode(texts + odd), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    again = words_of.spaced_words(tokenizer)
    monkeypatch.setattr(again, "learn", lambda new: pytest.fail(f"{new} went to the whole tokenizer"))
    monkeypatch.setattr(words_of, "MEMORY_WORDS", 50)
    plain = [t for t in texts if "½" not in t]
    for text, ids in zip(plain, again.encode(plain), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_repeated_keys_are_split_and_in_one_order(spark, tmp_path):
    """A key of half of the rows lies in several files, in the same order however rows come."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    rows = [(7 if i % 2 else i, f"text number {i * 7919 % 1000} of them") for i in range(400)] + [(7, "twice")] * 3
    seen = []
    for turn, parts in enumerate((3, 11)):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        path = str(tmp_path / str(turn))
        token_files.write_tokens(df, "doc_id", "text", WORDS, path, end_id=1)
        hot = spark.read.parquet(path).where("doc_id = 7")
        assert hot.select("part").distinct().count() > 2
        read = token_files.read_tokens(spark, path)
        seen.append(sorted((r["start"], r["doc_id"], tuple(r["tokens"])) for r in read.collect()))
    spark.conf.set(name, "true")
    assert seen[0] == seen[1] and [k for _, k, _ in seen[0]] == sorted(k for k, _ in rows)
    with pytest.raises(ValueError, match="may not be called part"):
        token_files.write_tokens(df.withColumnRenamed("doc_id", "part"), "part", "text", WORDS, path)
