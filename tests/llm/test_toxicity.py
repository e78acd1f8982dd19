import random

import pytest

from divtide.llm import toxicity
from divtide.llm.toxicity import Flags, features_of, FEATURES
from tests.llm.conftest import EDGES

STEMS = ["zorg", "plax", "vunt"]


def corpus(n=2400):
    """Toxic texts have a stem with varying endings, each text in words of its own."""
    rng = random.Random(3)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(20, 120))
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(STEMS) + rng.choice(plain))
        texts.append((i, " ".join(words)))
        labels.append((i, toxic, "x"))
    return texts, labels


@pytest.fixture(scope="module")
def model(spark, request):
    texts, labels = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return toxicity.Model(docs, spark.createDataFrame(labels, "doc_id long, toxic int, text string")), docs, dict((i, t) for i, t, _ in labels)


def test_held_out_accuracy(model):
    fitted, docs, toxic = model
    rows = [r for r in fitted.score(docs).collect() if r["held_out"]]
    assert len(rows) > 400
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in rows)
    assert right / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_learns_beginnings(model):
    strong = model[0].lexicon[0]
    assert {"zorg*", "plax*", "vunt*"} <= strong


def test_scores_edges(model, frame):
    rows = model[0].score(frame(EDGES)).collect()
    assert len(rows) == len(EDGES)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)


@pytest.mark.parametrize("toxic", [[], [0, 0, 0]])
def test_without_labels_of_both_kinds(spark, frame, toxic):
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.Model(frame(EDGES), labels).score(frame(EDGES)).collect()} == {0.0}


def test_features():
    flags = Flags(frozenset(["vunt*"]), frozenset())
    at = dict(zip(FEATURES, features_of("You st*pid idiot!! nice vunting day", flags)))
    assert at["any_insult"] == 1 and at["any_strong"] == 1 and at["near_person"] > 0
    assert at["hidden"] > 0 and at["shouted"] == 0 and at["marks"] > 0
    assert features_of("", flags) == [0.0] * len(FEATURES)
