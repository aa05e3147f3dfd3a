"""Registered queries of the subpackage, and the stages of the pipeline."""

import hashlib
import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from agreement import differences, open_tables
from tidegate.llm import queries
from tidegate.llm.common import written

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    unwanted = ("CartesianProduct", "BroadcastNestedLoopJoin")
    found = differences(spark, open_tables(MORE), queries.QUERIES[name], queries.ORACLES[name], MORE, unwanted)
    assert found == []


KEYS = {
    "op1": ("documents", "doc_id"),
    "op2": ("documents", "doc_id"),
    "op4": ("documents", "doc_id"),
    "op5": ("documents", "doc_id"),
    "op6": ("pages", "page_id"),
    "op7": ("documents", "doc_id"),
    "op8": ("pages", "page_id"),
    "op9": ("pages", "page_id"),
    "op12": ("documents", "doc_id"),
    "op13": ("documents", "doc_id"),
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_has_every_row(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    if name.split("_")[0] in KEYS:
        source, key = KEYS[name.split("_")[0]]
        want = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{source}.parquet").select(key).collect())
        assert sorted(r[key] for r in found.select(key).collect()) == want
    else:
        assert found.count() > 0


def test_native_plan(spark):
    plan = queries.QUERIES["op6_url_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_stages(spark):
    """Each stage on all its predecessor kept; the last digests the ids of what is left."""
    documents = spark.read.parquet(f"{MORE}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MORE}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{MORE}/benchmark.parquet").collect()]
    docs, kept = documents, [set(texts)]
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, MORE), name.replace(" ", "-"))
        assert docs.columns == documents.columns
        kept.append({r["doc_id"] for r in docs.collect()})
        assert kept[-1] < kept[-2]
    good = [i for i, r in labels.items() if r["quality"] == 1]
    assert sum(i in kept[1] for i in good) > 0.98 * len(good)
    bad = [i for i, r in labels.items() if r["quality"] == 0]
    assert sum(i in kept[1] for i in bad) < 0.05 * len(bad)
    clean = [i for i, r in labels.items() if r["toxic"] == 0 and i in kept[1]]
    assert sum(i in kept[2] for i in clean) > 0.98 * len(clean)
    plain = [" ".join(texts[i].split()) for i in kept[3]]
    assert len(plain) == len(set(plain))  # no exact copies are left
    assert not any(item in texts[i] for i in kept[4] for item in items)
    assert all(any(item in texts[i] for item in items) for i in kept[3] - kept[4])
    rows = corpus_pipeline.run(spark, MORE).collect()
    assert {r["doc_id"] for r in rows} == kept[4]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stages_of_awkward_documents(spark, awkward, nothing):
    for docs in (awkward.drop("score"), nothing.drop("score")):
        docs = docs.withColumnsRenamed({"n_tokens": "n_chars", "id": "source"})
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, SMALL)
            assert found.columns == docs.columns
            assert found.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
