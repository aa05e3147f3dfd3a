"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words is the number of letter sequences of length ORDER that both hold, in order
but with gaps, within SPAN letters, each weighted by GAP to the power of the letters it spans in
both; a letter put into an insult only weakens it. It is divided by the lengths of the words'
vectors of sequences, where a word's sequences count one by one. Words are mapped by their kernels
with a few landmarks: parts of words that tell toxic training sentences from others, and some
common words. A linear machine over that map is trained on sentences: a sentence has its
document's label, the words with such a part stand for a toxic sentence, as they are and with a
letter put in, and words of clean sentences are clean, of which the machine gets those that it
finds hardest.

The machine is a weighted sum of landmark kernels, and a kernel is a sum over sequences, so a word
is scored by adding the weights of its own sequences, without any landmark. A text is judged by
its most toxic words and their share, with weights learned from the same texts.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import nlargest
from itertools import combinations
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

from tidegate.llm import common

#: Labelled rows learned from at most, and characters of the longest text among them.
TRAINING_ROWS, TRAINING_CHARS = 2_500, 30_000
ORDER, SPAN, GAP = 4, 6, 0.75
LANDMARKS, COMMON_WORDS, HARD_WORDS = 72, 24, 60
#: What a clean training text with a landmark costs, against what a toxic one is worth.
PURITY = 6
#: Words of a text that decide.
WORST = 5
#: How likely any of them may be there by chance.
CHANCE = 1e-3
#: Letters of a word scored at once; a longer word has the score of its best piece.
PIECE, STEP = 12, 2
ROUNDS, STEPS, PENALTY = 3, 40, 1e-4
MEMORY_WORDS = 400_000
SYMBOLS = 42
#: Stand for the begin and the end of a word, which are letters of it.
BEGIN, END = "\x02", "\x03"
_sentences = re.compile(r"[.!?\n]+").split
_spelled = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")


def _codes() -> np.ndarray:
    """1 to 39 for letters (those beyond a-z share some), 0 for all else."""
    out = np.zeros(0x110000, dtype=np.int64)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            if "a" <= c <= "z":
                out[point] = point - 96
            else:
                out[point] = 27 + point % 13
    for digit, letter in zip("01345789@", "oieastbga"):
        out[ord(digit)] = ord(letter) - 96
    out[ord(BEGIN)], out[ord(END)] = SYMBOLS - 2, SYMBOLS - 1
    return out


_table: list[np.ndarray] = []


def codes() -> np.ndarray:
    if not _table:
        _table.append(_codes())
    return _table[0]


def words_of(text: str) -> set[str]:
    """Distinct words in lower case; letters spelled one by one are a word too."""
    lowered = text.lower()
    words = set(lowered.split())
    for found in _spelled.findall(lowered):
        words.add("".join(found.split()))
    return words


def pieces(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of words, as matrices by length, and the words' places; long words in pieces.

    Words go from their first to their last letter, and have marks of begin and end around them.
    """
    points = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), dtype=np.uint32)
    coded = np.concatenate(([0], codes()[points], [0]))
    ends = np.append(np.flatnonzero(points == 10), len(points)) + 1
    starts = np.append(1, ends[:-1] + 1)
    solid = np.flatnonzero(coded)
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = np.flatnonzero(first <= last)
    begins, stops = solid[first[some]] - 1, solid[last[some]] + 2
    coded = np.where(coded >= SYMBOLS - 2, 0, coded)  # a text's own characters mark nothing
    sizes = stops - begins
    count = np.maximum(1, -(-(sizes - PIECE) // STEP) + 1)
    place, begin, stop = (np.repeat(x, count) for x in (some, begins, stops))
    turn = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    at = np.maximum(begin, np.minimum(begin + turn * STEP, stop - PIECE))
    letters = np.minimum(stop - begin, PIECE)
    for size in range(ORDER, PIECE + 1):
        chosen = np.flatnonzero(letters == size)
        for i in range(0, len(chosen), 4096):
            part = chosen[i : i + 4096]
            spots = at[part][:, None] + np.arange(size)
            matrix = coded[spots]
            matrix[spots == begin[part][:, None]] = SYMBOLS - 2
            matrix[spots == stop[part][:, None] - 1] = SYMBOLS - 1
            yield place[part], matrix


def raw_pieces(parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As :func:`pieces` for parts of words, which hold their marks if any."""
    for place, part in enumerate(parts):
        matrix = codes()[[ord(c) for c in part[: 2 * PIECE]]][None, :]
        if matrix.shape[1] >= ORDER:
            yield np.array([place]), matrix


def chances(n: int) -> list[tuple[int, ...]]:
    """Places of the letter sequences in a word of n letters."""
    rest = [p for p in combinations(range(1, SPAN), ORDER - 1)]
    return [(i, *(i + p for p in q)) for i in range(n) for q in rest if i + q[-1] < n]


def length(n: int) -> float:
    """Of the vector of sequences of a word of n letters."""
    return float(np.sqrt(sum(GAP ** (2 * (c[-1] - c[0] + 1)) for c in chances(n))))


def sequences(matrix: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """Weight and number of the letter sequence at each choice of places; 0 where one has no letter."""
    columns = np.ascontiguousarray(matrix.T)
    signs = bool((columns == 0).any())
    for places in chances(len(columns)):
        number = columns[places[0]]
        for p in places[1:]:
            number = number * SYMBOLS + columns[p]
        if signs:
            number = np.where((columns[list(places)] > 0).all(axis=0), number, 0)
        yield GAP ** (places[-1] - places[0] + 1), number


@dataclass
class Model:
    """Weights of letter sequences, and of what :meth:`told` makes of a text's words."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(SYMBOLS**ORDER, dtype=np.float32))
    bias: float = 0.0
    text_weights: np.ndarray = field(default_factory=lambda: np.zeros(WORST + 4))

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        for places, matrix in pieces(words):
            total = np.zeros(len(places), dtype=np.float32)
            for weight, number in sequences(matrix):
                total += np.float32(weight) * self.weights[number]
            np.maximum.at(out, places, total / length(matrix.shape[1]) + self.bias)
        return np.where(np.isneginf(out), self.bias, out)

    def told(self, texts: list[str], memory: dict[str, float]) -> np.ndarray:
        """Per text: the scores of its WORST most toxic words, how many and how frequent the
        toxic ones are, its length, and 1. A word counts as often as it stands there."""
        found = [words_of(t) for t in texts]
        new = list(set().union(*found).difference(memory)) if found else []
        if new:
            if len(memory) > MEMORY_WORDS:
                memory.clear()
                new = list(set().union(*found))
            bare = ["".join(filter(str.isalnum, w)) for w in new]  # signs may be put in anywhere
            scores = np.maximum(self.word_scores(new), self.word_scores(bare))
            memory.update(zip(new, scores.tolist(), strict=True))
        out = np.empty((len(texts), WORST + 4))
        for row, text, words in zip(out, texts, found, strict=True):
            scores = [memory[w] for w in words]
            toxic = {w for w, s in zip(words, scores, strict=True) if s > 0}
            count = 0
            if toxic:
                again = Counter(w for w in text.lower().split() if w in toxic)
                scores += [memory[w] for w, times in again.items() for _ in range(min(times, WORST) - 1)]
                count = max(len(toxic), sum(again.values()))
            worst = nlargest(WORST, scores)
            worst += [self.bias] * (WORST - len(worst))
            row[:WORST] = np.clip(worst, -1.5, 1.5)
            length = max(len(words), 1)
            row[WORST:] = np.log1p(count), min(5.0, 100 * count / length), np.log1p(length) / 10, 1
        return out

    def probabilities(self, told: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(told @ self.text_weights, -40, 40)))


def parts_of(word: str) -> set[str]:
    word = BEGIN + word + END
    return {word[i : i + n] for n in (4, 5, 6, 7) for i in range(len(word) - n + 1)}


def choose_landmarks(
    names: list[str], toxic: list[np.ndarray], clean: list[np.ndarray]
) -> tuple[list[str], list[str]]:
    """Parts of words that many toxic texts hold and hardly a clean one, each for other words;
    and words that are common in clean texts. Texts are the places of their words in ``names``."""
    often, in_clean = (
        np.bincount(np.concatenate(bags), minlength=len(names)) for bags in (toxic, clean)
    )
    telling = often * len(clean) > in_clean * len(toxic)
    counts: Counter[str] = Counter()
    for text in toxic:
        counts.update(set().union(*(parts_of(names[w]) for w in text if telling[w])))
    share = len(toxic) / (len(toxic) + len(clean))
    chance = np.log(CHANCE / max(1, len(counts)))  # some part of so many may be found by chance
    limit = int(np.ceil(chance / np.log(share)))
    wanted = {p for p, n in counts.items() if n >= limit}
    del counts
    held = {w: found for w in np.flatnonzero(often + in_clean) if (found := parts_of(names[w]) & wanted)}
    other = Counter(p for text in clean for p in set().union(*(held.get(w, ()) for w in text)))
    holders: dict[str, set[int]] = defaultdict(set)
    texts: dict[int, set[int]] = defaultdict(set)
    for at, text in enumerate(toxic):
        for w in text:
            if telling[w] and w in held:
                texts[w].add(at)
                for part in held[w]:
                    holders[part].add(w)

    def score(part: str) -> float:
        found = len(set().union(*(texts[w] for w in holders[part]))) if holders[part] else 0
        more = other[part]
        ways = lgamma(found + more + 1) - lgamma(found + 1) - lgamma(more + 1)
        if not found or ways + found * np.log(share) >= chance:
            return 0.0
        return found / len(toxic) - PURITY * more / len(clean)

    scores = {p: s for p in wanted if (s := score(p)) > 0}
    chosen: list[str] = []
    while scores and len(chosen) < LANDMARKS:
        part = max(scores, key=lambda p: (scores[p], len(p), p))
        chosen.append(part)
        touched = set()
        for w in list(holders[part]):
            for p in held[w]:
                holders[p].discard(w)
                touched.add(p)
        for p in touched & scores.keys():
            if (s := score(p)) > 0:
                scores[p] = s
            else:
                del scores[p]
    order = sorted(np.flatnonzero(in_clean), key=lambda w: (-in_clean[w], names[w]))
    frequent = [names[w] for w in order if len(names[w]) > 3][:COMMON_WORDS]
    return chosen, [BEGIN + w + END for w in frequent]


class Nystrom:
    """The map of words by their kernels with landmarks."""

    def __init__(self, landmarks: list[str]):
        self.number: dict[int, int] = {}
        rows = []
        for places, matrix in raw_pieces(landmarks):
            for weight, number in sequences(matrix):
                rows += [(p, n, weight) for p, n in zip(places.tolist(), number.tolist()) if n]
        for _, n, _ in rows:
            self.number.setdefault(n, len(self.number))
        self.column = np.full(SYMBOLS**ORDER, -1, dtype=np.int32)
        for n, at in self.number.items():
            self.column[n] = at
        self.parts = np.zeros((len(landmarks), max(1, len(self.number))))
        for p, n, weight in rows:
            self.parts[p, self.number[n]] += weight
        size = np.sqrt((self.parts**2).sum(axis=1))
        self.parts /= np.maximum(size, 1e-9)[:, None]
        values, vectors = np.linalg.eigh(self.parts @ self.parts.T)
        root = np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0.0)
        self.whiten = vectors * root @ vectors.T

    def features(self, words: list[str]) -> np.ndarray:
        found = [self._some(words[i : i + 1_000]) for i in range(0, len(words), 1_000)]
        return np.concatenate(found or [np.zeros((0, len(self.parts)))])

    def _some(self, words: list[str]) -> np.ndarray:
        held = np.zeros((len(words), self.parts.shape[1]))
        for places, matrix in pieces(words):
            scale = 1 / length(matrix.shape[1])
            for weight, number in sequences(matrix):
                column = self.column[number]
                known = column >= 0
                np.add.at(held, (places[known], column[known]), weight * scale)
        return held @ self.parts.T @ self.whiten

    def weights(self, machine: np.ndarray) -> np.ndarray:
        """The machine over the map as weights of letter sequences."""
        out = np.zeros(SYMBOLS**ORDER, dtype=np.float32)
        share = (self.whiten @ machine) @ self.parts
        for n, at in self.number.items():
            out[n] = share[at]
        return out


def _machine(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton's method."""
    x1 = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x1.shape[1])
    for step in range(STEPS):
        inside = y * (x1 @ w) < 1  # the others add nothing to the loss
        part = x1[inside] * share[inside, None]
        bend = part.T @ x1[inside] + PENALTY * np.eye(len(w))
        new = np.linalg.solve(bend, part.T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = w + (new - w) * (0.5 if step > 20 else 1.0)
    return w[:-1], float(w[-1])


def train(rows: list[tuple[str, int]]) -> Model:
    """Fit on texts and labels; with one label only, scores are its share for all texts."""
    labels = np.array([label for _, label in rows])
    share = float(labels.mean()) if len(rows) else 0.5
    flat = Model()
    flat.text_weights[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
    number: dict[str, int] = {}
    bags: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for text, label in rows:
        words = {
            w.strip(".,;:!?\"'()[]") for s in _sentences(text) for w in (words_of(s) if s.strip() else ())
        }
        found = sorted(number.setdefault(w, len(number)) for w in words - {""})
        bags[int(label > 0)].append(np.array(found, dtype=np.int32))
    clean, toxic = bags
    if not toxic or not clean:
        return flat
    names = list(number)
    telling, frequent = choose_landmarks(names, toxic, clean)
    if not telling:
        return flat
    random = np.random.default_rng(3)
    witnesses = Counter(
        w
        for bag in toxic
        for w in (names[i] for i in bag)
        if any(part in BEGIN + w + END for part in telling)
    )
    found = sorted(witnesses)
    good = np.sqrt([witnesses[w] for w in found])
    good /= good.sum()
    split = [_with_letter(w, random) for w in found]
    pool = sorted(names[i] for i in np.unique(np.concatenate(clean)))
    pool = [pool[i] for i in random.permutation(len(pool))[:40_000]]
    whole = [max((w for w in found if part in BEGIN + w + END), key=witnesses.get) for part in telling]
    landmarks = telling + frequent + [BEGIN + w + END for w in whole]
    del number, names, bags, clean, toxic
    model, hard = flat, set(pool[:4_000])
    for turn in range(ROUNDS):  # each with the clean words that the last machine found most toxic
        order = np.argsort(-model.word_scores(pool), kind="stable").tolist() if turn else []
        hard.update(pool[i] for i in order[:4_000])
        landmarks += [BEGIN + pool[i] + END for i in order[:HARD_WORDS]]
        space = Nystrom(list(dict.fromkeys(landmarks)))
        bad = sorted(hard)
        y = np.array([1.0] * (len(found) + len(split)) + [-1.0] * len(bad))
        each = (0.3 * good, 0.2 * good, np.full(len(bad), 0.5 / len(bad)))
        machine, bias = _machine(space.features(found + split + bad), y, np.concatenate(each))
        model = Model(weights=space.weights(machine), bias=bias)
    texts = [t for t, _ in rows]
    told = [model.told(texts[i : i + 256], {}) for i in range(0, len(texts), 256)]
    model.text_weights = _logistic(np.concatenate(told), labels)
    return model


def _with_letter(word: str, random: np.random.Generator) -> str:
    """The word with a sign or letter put into it, as insults are disguised."""
    at = int(random.integers(1, max(2, len(word))))
    return word[:at] + str(random.choice(list(".-_*xaeio"))) + word[at:]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method with a little damping."""
    a = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * a
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(a))
        step = np.linalg.solve(bend, slope)
        a = a - step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return a


def fit(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> Model:
    """Learn from a bounded sample of labelled documents; held-out rows are not looked at."""
    rows = common.training_sample(
        documents, labels, key, text, label, TRAINING_ROWS, TRAINING_CHARS
    )
    return train(rows)


def with_scores(df: DataFrame, text: str, model: Model, score: str = "score") -> DataFrame:
    """Add the probability that a text is toxic, from its whole text alone; all rows stay.

    Null texts count as empty; a text without words is scored by its length and the bias alone. A column
    of that name is an error.
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
            texts = [t or "" for t in batch.column(place).to_pylist()]
            found = model.probabilities(model.told(texts, memory))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.astype(np.float64))], names=schema.fieldNames()
            )

    return df.mapInArrow(run, schema)
