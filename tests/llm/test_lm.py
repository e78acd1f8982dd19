import math
import random
from collections import Counter

import numpy as np
import pytest

from divtide.llm import maxent_lm as lm
from tests.llm.conftest import EDGES


def corpus(n=400):
    """Two made-up languages, so that the words before tell much about the next."""
    rng = random.Random(4)
    words = [[a + b + end for a in "bcdfg" for b in "aeiou" for end in ends] for ends in (["st", "nd", "ly"], ["os", "ar", "ez"])]
    return [(i, " ".join(rng.choices(words[i % 2], k=rng.randint(10, 80)))) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    return lm.Model(docs), docs


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def check_base(model, rows, out):
    learned = [t for i, t in corpus() if __import__("zlib").crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learned for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (-1 if i is None else i, len(tokens(t)), sum(w in counts for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for i, t in rows
    )
    given = sorted(
        (-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out
    )
    assert [x[:4] for x in given] == [x[:4] for x in expected]
    # Sums of tens of thousands of logarithms, in another order.
    assert all(math.isclose(x[4], y[4], rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(given, expected))


def test_base_and_gain(model):
    out = model[0].score(model[1]).collect()
    check_base(model, corpus(), out)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 30
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > 0.1  # of at most log10(2) for the language and a little for the end


def test_edges_and_unseen_words(model, frame):
    rows = [*EDGES, (90, "NEW words ÀÉ bast bast BAST")]
    out = model[0].score(frame(rows)).collect()
    check_base(model, rows, out)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_tail_words_count_like_head_words(model, monkeypatch):
    """With hardly a word sent to the workers, the join gives the same scores."""
    fitted, docs = model
    whole = {r["doc_id"]: r for r in fitted.score(docs).collect()}
    monkeypatch.setattr(fitted, "head", lm.head_words(fitted.counts, 5))
    for r in fitted.score(docs).collect():
        assert r["n_known"] == whole[r["doc_id"]]["n_known"]
        assert abs(r["score"] - whole[r["doc_id"]]["score"]) < 1e-6
        assert abs(r["base_score"] - whole[r["doc_id"]]["base_score"]) < 1e-6


def test_probabilities_sum_to_one(model):
    """Over all known words and one unseen word per class, after any history."""
    fitted, _ = model
    rows = np.random.default_rng(1).integers(1, lm.ROWS, (50, 5)).astype(np.uint16)
    classes = lm.probabilities(fitted.weights, rows)
    words = [(bytes(r["word"]), r["n"]) for r in fitted.counts.collect()]
    inside = 10.0 ** fitted.unseen()
    for word, n in words:
        c = fitted.class_of_ending(word)
        inside[c] += (n - fitted.discount) / fitted.mass[c]
    assert np.allclose(classes @ inside, 1, atol=1e-5)


def test_token_run_agrees_with_words():
    texts = [t or "" for _, t in EDGES]
    seen = 0
    for first, run in lm.token_runs(texts):
        for i in range(len(run.starts) - 1):
            assert run.starts[i + 1] - run.starts[i] == len(tokens(texts[first + i]))
            seen += 1
    assert seen == len(texts)


def test_nothing_to_learn_from(spark, frame):
    fitted = lm.Model(frame([]))
    out = fitted.score(frame(EDGES)).collect()
    assert len(out) == len(EDGES)
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in out)
