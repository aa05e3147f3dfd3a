"""The registered queries of this subpackage: each operator over its whole table.

SQL stands beside a query where DuckDB can express it. The other queries are tested against
brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    bpe,
    common,
    decontaminate,
    html_text,
    line_dedup,
    negatives,
    quality,
    runs,
    simhash,
    token_files,
    topk,
    toxicity,
    url_filter,
    warc,
)
from tidegate.llm.common import table
from tidegate.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


@query("op1_bpe_tree")
def bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), "doc_id", "text", BYTE_BPE)


@query("op2_simhash_components")
def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.fingerprint_components(table(spark, folder, "documents"), "doc_id", "text")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op5_token_files")
def token_file_digests(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "token-files")
    documents = table(spark, folder, "documents")
    token_files.write_tokens(documents, "doc_id", "text", WORD_BPE, path, end_id=1)
    read = token_files.read_tokens(spark, path)
    found = token_files.token_digests(read.select("doc_id", "start", "n_tokens", "tokens"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


@query("op6_url_filter")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    weights = url_filter.train(url_filter.labelled_urls(spark))
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, "url", URL_RULES, weights)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_warc_revisits")
def warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path, "page_id", "url", "html")
    read = warc.read_archives(spark, path, payloads=False)
    return read.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


TOP_K_SQL = """
WITH ok AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i,
         CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
  FROM ok
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i
  WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
  GROUP BY ALL
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scores
QUALIFY rank <= 5
"""


@query("op10_bit_sliced_top_k", TOP_K_SQL)
def bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    queries = vectors.where("vec_id % 50 = 0")
    found = topk.top_k(vectors, "vec_id", "embedding", queries, k=5, scale=256)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op3_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, folder, "documents"),
        "doc_id",
        "text",
        table(spark, folder, "benchmark"),
        "item_id",
        "text",
    )
    return found.withColumn("similarity", F.round("similarity", 6))


@query("op4_toxicity_string_kernel")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(documents, labels, "doc_id", "text", "toxic")
    scored = toxicity.with_scores(documents.select("doc_id", "text"), "text", model)
    return common.decided(scored, "doc_id", 0.5)


@query("op7_quality_random_indexing")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(documents, labels, "doc_id", "text", "quality")
    scored = quality.with_scores(documents.select("doc_id", "text"), "text", model)
    return common.decided(scored, "doc_id", 0.3)


@query("op9_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages, "html", "text", "n_chars").drop("html")


NEGATIVES_SQL = """
WITH ok AS (
  SELECT vec_id, embedding,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (
  SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i,
         CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
  FROM ok
),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id AS vec_id, c.label AS label,
         CAST(sum(a.v * c.v) AS BIGINT) AS score
  FROM parts a JOIN parts c ON a.i = c.i
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
  GROUP BY ALL
),
positives AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score
  FROM scores
  WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (
         PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id
       ) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n
  ON p.anchor_id = n.anchor_id AND n.label <> p.own
 AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = F.col("vec_id") % 100 == 0
    vectors = table(spark, folder, "embeddings")
    return negatives.hard_negatives(vectors, "vec_id", "embedding", moved, anchors, k=5, scale=256)


LINES_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
each AS (
  SELECT doc_id, unnest(range(1, len(lines) + 1)) AS n, unnest(lines) AS line FROM split
),
keyed AS (
  SELECT doc_id, n, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM each
),
judged AS (
  SELECT doc_id, n, line,
         length(k) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY k) AS dropped
  FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM judged
GROUP BY doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def line_digests(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    bitmaps = line_dedup.keep_bitmaps(documents, "doc_id", "text")
    kept = line_dedup.with_kept_lines(documents, "doc_id", "text", bitmaps)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def planted_periods(key: int | None, words: list[bytes]) -> list[bytes]:
    """Words that repeat from some place on, in a tenth of the documents, as their ids tell."""
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * (-(-(n - a) // p)))[: n - a]


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = runs.with_runs(documents, "doc_id", "text", planted_periods, digest=True)
    best = F.expr(
        "aggregate(runs, get(runs, 0), (a, r) ->"
        " if(r.length * a.period > a.length * r.period, r, a))"
    )
    line = "concat_ws(',', r.start, r.length, r.period)"
    listed = F.expr(f"array_join(transform(runs, r -> concat({line}, chr(10))), '')")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.col("kept").alias("collapsed_sha256"),
    )
