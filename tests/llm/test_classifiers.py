"""The learned operators: held-out accuracy on made-up texts, parts of the models, odd documents."""

import random

import numpy as np
import pytest

from sondage.llm import quality_gam as G
from sondage.llm import toxicity as T

SYLLABLES = ["an", "er", "tion", "the", "ou", "re", "st", "le", "in", "ka", "mo", "dri", "ul", "pe"]
BAD = ["grumpf", "blorket", "zwanky", "snivelor", "quarbit"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def document(rng, good, toxic):
    words = [word(rng) for _ in range(rng.randint(30, 150))]
    for _ in range(rng.randint(2, 5) if toxic else 0):
        words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", "s", word(rng)]))
    if not good:
        return " | ".join(words) if rng.random() < 0.5 else " ".join(w + rng.choice(["###", "$$$"]) for w in words)
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(15)
    rows = [(k, rng.random() < 0.8, rng.random() < 0.3) for k in range(1500)]
    docs = spark.createDataFrame([(k, document(rng, q, t), "c", "c", "c") for k, q, t in rows], "doc_id bigint, text string, x string, y string, score string")
    labels = spark.createDataFrame([(k, int(q), int(t)) for k, q, t in rows], "doc_id bigint, quality int, toxic int")
    return docs.repartition(4), labels, {k: (int(q), int(t)) for k, q, t in rows}


def accuracy(rows, truth, at_least):
    held = [r for r in rows if r["held_out"]]
    assert held and all(0 <= r["score"] <= 1 for r in rows)
    return np.mean([(r["score"] >= at_least) == truth[r["doc_id"]] for r in held])


def test_quality_of_held_out_documents(tables):
    rows = G.learn_and_score(*tables[:2]).collect()
    assert len(rows) == 1500
    assert accuracy(rows, {k: q for k, (q, _) in tables[2].items()}, 0.3) > 0.97


def test_toxicity_of_held_out_documents(tables):
    rows = T.learn_and_score(*tables[:2]).collect()
    assert accuracy(rows, {k: t for k, (_, t) in tables[2].items()}, 0.7) > 0.95


def test_interactions_are_learned():
    """An exclusive or of two features has no main effects at all."""
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = G.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert len(model.tables) == 3 and all(len(t) == len(e) + 1 for t, e in zip(model.tables, model.edges, strict=True))


def test_distances_tell_toxic_words_from_others():
    rng = random.Random(16)
    usual = T.Counter(f" {word(rng)} ".encode() for _ in range(20_000))
    toxic = T.Counter({f" {w} ".encode(): 9 for w in BAD})
    saved = T.Distances(T.dictionary(toxic, 4096), T.dictionary(usual, 8192))
    assert all(saved[w.encode()] >= 3 for w in BAD)
    assert np.mean([saved[word(rng).encode()] < 3 for _ in range(2000)]) > 0.99


def test_logistic_weights_are_not_negative():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, (2000, 3)).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(2 - 1.5 * x[:, 0] + x[:, 1]))).astype(float)
    base, weights = T.logistic(x, y)
    assert weights[1] == 0 and weights[0] > 1 and base < 0


@pytest.mark.parametrize("operator", [G, T])
def test_odd_documents_and_labels(odd_docs, no_docs, tables, spark, operator):
    label = "quality" if operator is G else "toxic"
    docs, labels, _ = tables
    # repeated and null labels and ids change nothing for the rest
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (10**9, 1, 1)], labels.schema)).unionByName(labels.limit(50))
    assert operator.learn_and_score(docs, odd).count() == 1500
    for some in (labels.where("false"), labels.where(f"{label} = 1")):
        assert {r["score"] for r in operator.learn_and_score(docs, some).collect()} == {0.5}
    model = operator.train(docs, labels, label)
    scored = operator.score(odd_docs, model)
    assert scored.count() == odd_docs.count()
    assert len({r["score"] for r in scored.where("doc_id in (2, 3, 4)").collect()}) == 1
    assert operator.score(no_docs, model).count() == 0
    assert operator.learn_and_score(no_docs, labels).count() == 0
