"""Quality classifier: random-indexing word vectors, pooled, through a small network.

Tokens are known words, or the shape of other tokens (letters by case, digits, signs as they are).
Each kind of token has a sparse random index vector; its word vector adds those of the tokens that
stood near it in the training texts. A document is the mean of its tokens' vectors, with a mark in
place of a token that repeats the one before, and one more for a token that came earlier. A
network of two layers, in numpy, gives a log-odds that a temperature, fitted on texts set apart,
turns into a probability.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

from tidegate.llm import common

#: Labelled rows learned from at most, and characters of the longest text among them.
TRAINING_ROWS, TRAINING_CHARS = 2_000, 30_000
WORDS, SHAPES = 3_000, 2_000
DIMENSIONS, ONES = 64, 8
HIDDEN, EPOCHS, RATE, DECAY = 24, 150, 0.02, 1e-2
#: Tokens remembered by a worker at most.
MEMORY_TOKENS = 400_000
SAME, EARLIER, OTHER = "<same>", "<earlier>", "<other>"
#: Characters of a token; a longer one is taken in pieces of so many.
TOKEN_CHARS = 64
_letters = re.compile(r"(.)\1{2,}")
_pieces = re.compile(rf"\S{{1,{TOKEN_CHARS}}}").findall


def tokens_of(text: str) -> list[str]:
    """What stands between white space, in pieces where it is very long."""
    tokens = text.split()
    return _pieces(text) if max(map(len, tokens), default=0) > TOKEN_CHARS else tokens


def shape(token: str) -> str:
    """X and x for letters by case, 9 for digits, runs of them once; signs up to three in a row."""
    if token.isalpha():
        if token.islower():
            return "x"
        if token.isupper():
            return "X"
        if token[1:].islower():
            return "Xx"
    kinds = []
    for c in token:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not (kind in "Xx9" and kinds and kinds[-1] == kind):
            kinds.append(kind)
    return _letters.sub(r"\1\1\1", "".join(kinds))[:16]


def index_vector(name: str) -> np.ndarray:
    """A sparse vector of as many 1 as -1, drawn from the name."""
    random = np.random.default_rng(zlib.crc32(name.encode()))
    vector = np.zeros(DIMENSIONS, dtype=np.float32)
    places = random.choice(DIMENSIONS, ONES, replace=False)
    vector[places] = np.where(np.arange(ONES) % 2, 1.0, -1.0)
    return vector / np.sqrt(ONES)


@dataclass
class Model:
    """What scoring needs; ``layers`` is none if the training texts had one label only."""

    kinds: dict[str, int]
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    layers: tuple | None
    temperature: float
    constant: float

    def kind(self, token: str) -> int:
        known = self.kinds.get(token.lower())
        if known is None or token.isupper() and len(token) > 1:
            known = self.kinds.get("shape " + shape(token), self.kinds[OTHER])
        return known

    def pooled(self, text: str | None, memory: dict[str, int]) -> np.ndarray:
        """The mean vector of a text, and the logarithm of its length."""
        tokens = tokens_of(text or "")
        out = np.zeros(DIMENSIONS + 1, dtype=np.float32)
        if not tokens:
            return out
        found = list(map(memory.get, tokens))
        if None in found:
            if len(memory) > MEMORY_TOKENS:
                memory.clear()
            for i, known in enumerate(found):
                if known is None:
                    found[i] = memory[tokens[i]] = self.kind(tokens[i])
        kinds = np.array(found, dtype=np.int64)
        kinds[1:][list(map(str.__eq__, tokens, tokens[1:]))] = self.kinds[SAME]
        if len(kinds) > 2_000:
            total = np.bincount(kinds, minlength=len(self.vectors)) @ self.vectors
        else:
            total = self.vectors[kinds].sum(axis=0)
        earlier = len(tokens) - len(set(tokens))
        total = total + earlier * self.vectors[self.kinds[EARLIER]]
        out[:DIMENSIONS] = total / len(tokens)
        out[DIMENSIONS] = np.log1p(len(tokens)) / 10
        return out

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(pooled), self.constant)
        odds = _forward((pooled - self.mean) / self.spread, self.layers)[1]
        return 1 / (1 + np.exp(-odds / self.temperature))


def _forward(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2


def word_vectors(texts: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Kinds of token and their vectors, from the texts alone."""
    words, shapes, split = Counter(), Counter(), [tokens_of(t) for t in texts]
    for tokens in split:
        words.update({t.lower() for t in tokens if t.isalpha()})
        shapes.update({shape(t) for t in set(tokens)})
    names = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:WORDS]]
    names += ["shape " + s for s, _ in sorted(shapes.items(), key=lambda x: (-x[1], x[0]))[:SHAPES]]
    names += [SAME, EARLIER, OTHER]
    kinds = {n: i for i, n in enumerate(names)}
    index = np.stack([index_vector(n) for n in names])
    bare = Model(kinds, index, index, index, None, 1.0, 0.5)
    memory: dict[str, int] = {}
    near = [np.zeros(0, dtype=np.int64)]
    for tokens in split:
        found = [memory[t] if t in memory else memory.setdefault(t, bare.kind(t)) for t in tokens]
        found = np.array(found, dtype=np.int64)
        near += [found[:-far] * len(names) + found[far:] for far in (1, 2)]
    pairs, times = np.unique(np.concatenate(near), return_counts=True)
    context = np.zeros_like(index)
    left, right = np.divmod(pairs, len(names))
    np.add.at(context, left, times[:, None].astype(np.float32) * index[right])
    np.add.at(context, right, times[:, None].astype(np.float32) * index[left])
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return kinds, (index + context / np.maximum(length, 1e-9)).astype(np.float32)


def train(rows: list[tuple[str, int]]) -> Model:
    """Fit on texts and labels; every fifth text only sets the temperature."""
    kinds, vectors = word_vectors([t for t, _ in rows])
    y = np.array([label for _, label in rows], dtype=np.float64)
    blank = np.zeros(DIMENSIONS + 1)
    constant = float(y.mean()) if len(y) else 0.5
    model = Model(kinds, vectors, blank, blank + 1, None, 1.0, constant)
    if len(y) < 10 or y.min() == y.max():
        return model
    memory: dict[str, int] = {}
    x = np.stack([model.pooled(t, memory) for t, _ in rows]).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 0
    model.mean, model.spread = x[~apart].mean(axis=0), x[~apart].std(axis=0) + 1e-3
    x = (x - model.mean) / model.spread
    model.layers = _fit(x[~apart], y[~apart])
    odds = _forward(x[apart], model.layers)[1]
    tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.logaddexp(0, -(2 * y[apart] - 1) * odds / t).mean() for t in tried]
    model.temperature = float(tried[int(np.argmin(loss))])
    return model


def _fit(x: np.ndarray, y: np.ndarray) -> tuple:
    random = np.random.default_rng(7)
    layers = [
        random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, EPOCHS + 1):
        hidden, odds = _forward(x, tuple(layers))
        error = (1 / (1 + np.exp(-odds)) - y) / len(y)
        back = error[:, None] * layers[2] * (1 - hidden**2)
        slopes = [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
        for i, slope in enumerate(slopes):
            slope = slope + DECAY * layers[i] * (layers[i].ndim > 1)
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            rise = first[i] / (1 - 0.9**step)
            layers[i] = layers[i] - RATE * rise / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def fit(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> Model:
    """Learn from a bounded sample of labelled documents; held-out rows are not looked at."""
    rows = common.training_sample(
        documents, labels, key, text, label, TRAINING_ROWS, TRAINING_CHARS
    )
    return train(rows)


def with_scores(df: DataFrame, text: str, model: Model, score: str = "score") -> DataFrame:
    """Add the probability of good quality, from the whole text alone; all rows stay.

    Null texts are scored as empty ones: a mean of no vector. A column of that name is an error.
    """
    if score in df.columns:
        raise ValueError(f"the table has a column {score} already")
    spark = df.sparkSession
    common.prepare_workers(spark)
    shared, place = spark.sparkContext.broadcast(model), df.columns.index(text)
    schema = StructType([*df.schema.fields]).add(score, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memory = shared.value, {}
        for batch in batches:
            texts = batch.column(place).to_pylist()
            pooled = [model.pooled(t, memory) for t in texts]
            found = model.scores(np.stack(pooled)) if pooled else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.astype(np.float64))], names=schema.fieldNames()
            )

    return df.mapInArrow(run, schema)
