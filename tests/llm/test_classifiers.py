import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import common, quality, toxicity

INSULTS = "idiot moron loser scum worthless pathetic".split()


def sentence(draw, count):
    words = ["".join(draw.choice(["an", "be", "or", "ti", "sa", "lo", "men"]) for _ in range(draw.randint(1, 4))) for _ in range(count)]
    return " ".join(words).capitalize() + "."


def texts(kind, count, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        body = " ".join(sentence(draw, draw.randint(3, 12)) for _ in range(draw.randint(1, 8)))
        label = int(draw.random() < 0.3)
        if kind == "toxic" and label:
            words = body.split()
            for _ in range(draw.randint(2, 4)):
                words.insert(draw.randrange(len(words) + 1), draw.choice(INSULTS))
            body = " ".join(words)
        if kind == "quality" and not label:
            body = draw.choice(
                [
                    body.upper().replace(" ", "!! "),
                    " ".join(w + draw.choice(["###", "%%%"]) for w in body.split()),
                    " ".join([body.split()[0]] * 60),
                ]
            )
        rows.append((body, label))
    return rows


def test_toxicity_of_new_texts():
    model = toxicity.train(texts("toxic", 900, 1))
    rows = texts("toxic", 300, 2)
    found = model.probabilities(model.told([t for t, _ in rows], {})) >= 0.5
    wanted = np.array([label == 1 for _, label in rows])
    assert (found == wanted).mean() > 0.98
    plain = sentence(random.Random(3), 20)
    score = lambda extra: model.probabilities(model.told([f"{plain} {extra}"], {}))[0]
    assert score("idiot moron") > 0.5 > score("")
    for disguised in ("i.d.i.o.t m-o-r-o-n", "i d i o t so m o r o n", "1d1ot m0ron"):
        assert score(disguised) > 0.5, disguised
    for close in ("idxiot morxon", "idiiot mororn"):  # a letter put in weakens, but is felt
        assert score(close) > score("table chair")


def kernel(a, b):
    """Sequences of ORDER letters within SPAN, by definition."""
    from collections import Counter
    from itertools import combinations

    def parts(word):
        word = toxicity.BEGIN + word + toxicity.END
        out = Counter()
        for places in combinations(range(len(word)), toxicity.ORDER):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN:
                out["".join(word[p] for p in places)] += toxicity.GAP**span
        return out

    x, y = parts(a), parts(b)
    return sum(x[k] * y[k] for k in x)


def test_kernel_by_definition():
    """A word's score by sequence weights is the sum over landmarks of the kernel."""
    landmarks = [toxicity.BEGIN + w + toxicity.END for w in ("idiot", "moron", "thing", "lose")]
    space = toxicity.Nystrom(landmarks)
    words = ["idiot", "idixot", "morons", "anything", "zzzzz", "ab", "lose"]
    found = space.features(words)
    own = np.array([[kernel(a[1:-1], b[1:-1]) for b in landmarks] for a in landmarks])
    size = np.sqrt(np.diag(own))
    values, vectors = np.linalg.eigh(own / size / size[:, None])
    whiten = vectors / np.sqrt(values) @ vectors.T
    for word, row in zip(words, found, strict=True):
        scale = toxicity.length(len(word) + 2) or 1
        raw = np.array([kernel(word, b[1:-1]) for b in landmarks]) / size / scale
        assert row == pytest.approx(raw @ whiten, abs=1e-5)
    machine = np.array([1.0, -0.5, 0.3, 2.0])
    model = toxicity.Model(weights=space.weights(machine))
    assert model.word_scores(words) == pytest.approx(found @ machine, abs=1e-5)


def test_long_words_are_scored_in_pieces():
    model = toxicity.train(texts("toxic", 600, 4))
    long = "".join(random.Random(1).choice("bcdfg") for _ in range(500))
    alone, inside = model.word_scores([long, long[:250] + "idiot" + long[250:]])
    assert inside > alone


def test_quality_of_new_texts():
    model = quality.train(texts("quality", 800, 5))
    rows, memory = texts("quality", 300, 6), {}
    found = model.scores(np.stack([model.pooled(t, memory) for t, _ in rows])) >= 0.3
    assert (found == np.array([label == 1 for _, label in rows])).mean() > 0.98


def test_probabilities_are_calibrated():
    """Labels turned at random: the mean probability follows their share."""
    draw = random.Random(9)
    rows = [(t, label if draw.random() < 0.8 else 1 - label) for t, label in texts("quality", 2500, 7)]
    model, memory = quality.train(rows[:2000]), {}
    found = model.scores(np.stack([model.pooled(t, memory) for t, _ in rows[2000:]]))
    labels = np.array([label for _, label in rows[2000:]])
    for low, high in ((0.0, 0.5), (0.5, 1.0)):
        inside = (found >= low) & (found < high)
        assert abs(found[inside].mean() - labels[inside].mean()) < 0.1


@pytest.mark.parametrize("rows", [[], [("a b", 1)], [("a b", 0), ("c", 0)], [("", 1), ("", 0)]])
def test_too_little_to_learn(rows):
    for module in (quality, toxicity):
        model = module.train(rows)
        found = (
            model.scores(np.stack([model.pooled(t, {}) for t in ("", "x y")]))
            if module is quality
            else model.probabilities(model.told(["", "x y"], {}))
        )
        assert np.isfinite(found).all() and (0 <= found).all() and (found <= 1).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_awkward_rows(spark, awkward, nothing, module):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (None, 1), (4, None), (7, 0), (7, 1)], "doc_id long, mark int"
    )
    model = module.fit(awkward, labels, "doc_id", "text", "mark")
    plain = awkward.drop("score")
    scored = common.decided(module.with_scores(plain, "text", model), "doc_id", 0.5)
    rows = scored.collect()
    assert len(rows) == awkward.count() and scored.columns == ["doc_id", "held_out", "score", "predicted"]
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and common.is_held_out(r["doc_id"]))
    assert module.with_scores(nothing.drop("score"), "text", model).count() == 0
    with pytest.raises(ValueError):
        module.with_scores(awkward, "text", model)


def test_held_out_rows_are_not_learned_from(spark):
    documents = spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")
    )
    labels = documents.select("doc_id", F.lit(1).alias("mark"))
    rows = common.training_sample(documents, labels, "doc_id", "text", "mark", 1000, 100)
    found = {int(t.split()[1]) for t, _ in rows}
    assert found == {i for i in range(400) if not common.is_held_out(i)}
    few = common.training_sample(documents, labels, "doc_id", "text", "mark", 25, 100)
    assert len(few) == 25 and set(few) <= set(rows)


@pytest.mark.parametrize(
    ("name", "label", "least"),
    [("op4_toxicity_string_kernel", "toxic", 0.95), ("op7_quality_random_indexing", "quality", 0.98)],
)
def test_held_out_accuracy(spark, name, label, least):
    from tidegate.llm import queries

    folder = "/root/testdata/sf0.1"
    found = queries.QUERIES[name](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(f"{label} is not null")
    right = found.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("int")))
    assert right.first()[0] > least


def test_sample_has_one_text_a_key(spark):
    """A repeated id brings one text to the driver, the smallest, wherever its rows are."""

    rows = [(1, f"text {i:03d}") for i in range(300)] + [(3, "third"), (4, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    labels = labels.where(~common.held_out(F.col("doc_id")))
    assert labels.count() == 4
    found = common.training_sample(documents, labels, "doc_id", "text", "toxic", 10, 1000)
    assert found == [("text 000", 1), ("third", 0)]


def test_text_without_white_space_is_read_whole():
    long = "a" * 64 + "1" * 64 + "?" * 10
    assert quality.tokens_of(f"x {long} y") == ["x", "a" * 64, "1" * 64, "?" * 10, "y"]
    assert quality.tokens_of(" ab  " + "c" * 64) == ["ab", "c" * 64] and quality.tokens_of(" ") == []
    texts = ["good words here " * 9, "BAD!!1 " * 20, "more good words " * 9, "X9#X9# " * 20, "plain words too " * 9]
    model = quality.train([(t, int(t[0].islower())) for t in texts])
    start = "words" * 13
    pooled = [model.pooled(start + end * 900, {}) for end in ("words", "!?1#@")]
    assert not np.allclose(*pooled)
