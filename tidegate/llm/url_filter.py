"""URL filter: rules for hosts and paths, and a logistic regression for all other URLs.

Everything is column expressions. Features are hashed character n-grams of the host and of the
path; the regression is fitted by adaptive gradient descent over a small labelled table, whose
gradient is one aggregate of at most BUCKETS rows a step.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4)
STEPS = 12
RATE = 0.8
DECAY = 1e-3
#: Labelled URLs used at most.
MOST_LABELLED = 10_000
#: Rules that may be one expression.
MOST_RULES = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of the labelled URLs that `labelled_urls` makes.
WANTED = (
    "news science library docs wiki school health research museum weather history garden "
    "recipes travel music books sports law open data"
).split()
UNWANTED = (
    "casino poker bets lottery xxx adult escort pills viagra loans payday crack warez torrent "
    "keygen replica clickbait malware phish spam"
).split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case after the first ``://``, and path after it; empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER)
    return host, F.regexp_extract(text, pattern, 2)


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule is a host, with its subdomains, and a path."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        domain, _, rest = rule.partition("/")
        fits = (host == domain) | F.endswith(host, F.lit("." + domain))
        found = F.when(fits & F.startswith(path, F.lit("/" + rest)), F.lit(rule)).otherwise(found)
    return found


def _grams(name: str, marked: Column, size: int) -> Column:
    count = F.length(marked) - (size - 1)
    places = F.when(count >= 1, F.sequence(F.lit(1), count))
    places = F.coalesce(places, F.array().cast("array<int>"))

    def bucket(i: Column) -> Column:
        gram = F.xxhash64(F.lit(name), marked.substr(i, F.lit(size)))
        return F.pmod(gram, F.lit(BUCKETS)).cast("int")

    return F.transform(places, bucket)


def features(host: Column, path: Column) -> Column:
    """Buckets of the n-grams of host and path, each with marks at its ends, and one for all URLs."""
    marked = {n: F.concat(F.lit("^"), text, F.lit("$")) for n, text in (("h", host), ("p", path))}
    grams = [_grams(n, text, size) for n, text in marked.items() for size in GRAMS]
    return F.concat(F.array(F.lit(BUCKETS)), *grams)


def _array(values: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def probability(grams: Column, weights: list[float]) -> Column:
    """That a URL is unwanted: the scaled sum of its weights, through the logistic function."""
    known = _array(weights)
    total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(known, g))
    return 1 / (1 + F.exp(-total / F.sqrt(F.size(grams).cast("double"))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small table ``url, label``: 1 for unwanted."""
    rows = []
    for i, word in enumerate(WANTED + UNWANTED):
        label = int(word in UNWANTED)
        other = (UNWANTED if label else WANTED)[(i + 7) % 20]
        rows += [
            (f"https://www.{word}.example.net/{other}/{i}", label),
            (f"http://{word}-{other}.example.org/en/{i}", label),
            (f"https://m.example.test/{word}/page?id={i}", label),
        ]
    for i, word in enumerate(WANTED):  # plain URLs are wanted
        for j, (place, end) in enumerate((("www", "org"), ("blog", "net"), ("m", "com"))):
            for language in ("en", "de", "fr", "es"):
                rows.append((f"https://{place}.{word[:4]}.example.{end}/{language}/{i * 31 + j}", 0))
    made = json.dumps([{"url": u, "label": x} for u, x in rows])
    kind = "array<struct<url:string,label:int>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(made), kind)))


def train(labelled: DataFrame) -> list[float]:
    """Weights from ``url, label``; rows without a label are left out.

    At most MOST_LABELLED rows are used, those with the smallest hashes of their URLs. Without
    rows all weights are zero.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where(F.col("label").isNotNull())
    rows = rows.orderBy(F.xxhash64("url")).limit(MOST_LABELLED)
    rows = rows.select(features(host, path).alias("grams"), F.col("label").cast("double").alias("y"))
    rows = rows.cache()
    weights, squares = [0.0] * (BUCKETS + 1), [0.0] * (BUCKETS + 1)
    for _ in range(STEPS):
        error = probability(F.col("grams"), weights) - F.col("y")
        part = error / F.sqrt(F.size("grams").cast("double"))
        each = rows.select(part.alias("part"), F.explode("grams").alias("g"))
        weights = [w * (1 - RATE * DECAY) for w in weights]
        for row in each.groupBy("g").agg(F.sum("part").alias("part")).where("part != 0").collect():
            squares[row["g"]] += row["part"] ** 2
            weights[row["g"]] -= RATE * row["part"] / math.sqrt(squares[row["g"]])
    rows.unpersist()
    return [round(w, 9) for w in weights]


def judge(
    df: DataFrame, url: str, rules: dict[str, str], weights: list[float]
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``score`` and ``verdict`` (allow or block).

    The verdict is that of the longest rule that fits, else block if the score is above a half.
    URLs that are null or without ``://`` have an empty host and path, no rule, and a score from
    no n-gram but the marks. Rows stay, repeated ones too.
    """
    host, path = host_and_path(F.col(url))
    parts = df.withColumns({"host": host, "path": path})
    h, p = F.col("host"), F.col("path")
    score = probability(features(h, p), weights)
    scored = parts.withColumns({"rule": rule_for(h, p, rules), "score": score})
    verdict = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    for text, decision in rules.items():
        verdict = F.when(F.col("rule") == text, F.lit(decision)).otherwise(verdict)
    return scored.withColumn("verdict", verdict)
