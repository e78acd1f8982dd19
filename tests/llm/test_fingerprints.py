"""Fingerprints against texts edited and compared by hand."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from divtide.llm import fingerprints as fp
from divtide.llm.shingles import shingle_sets
from tests.llm.conftest import EDGES, prose


def exact(one: str, other: str) -> float:
    a, b = (dict(shingle_sets([x])).get(0, np.zeros(0)) for x in (one, other))
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b))
    return both / (len(a) + len(b) - both)


def in_order(spark, rows):
    """The rows as the operator orders them."""
    df = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string")
    return [tuple(r) for r in df.orderBy("doc_id", F.xxhash64("text")).collect()]


@pytest.mark.parametrize("partitions", [1, 3])
def test_every_text_with_its_next(spark, frame, partitions):
    rows = [*EDGES, *[(100 + s, prose(s, s * 17 % 400)) for s in range(80)], (90, "x" * 9), (91, "y")]
    expected = []
    ordered = in_order(spark, rows)
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        own, edited, next_one = fp.fingerprints([text, changed, following])
        near = fp.likeness(own, edited), fp.likeness(own, next_one)
        expected.append((i, len(text), hashlib.sha256(changed.encode()).digest(), fp.packed(own), fp.packed(edited), *near))
    made = fp.fingerprint_documents(frame(rows, partitions))
    assert made.columns == list(fp.RESULT)
    out = [(*r[:2], *map(bytes, r[2:5]), *r[5:]) for r in made.collect()]
    assert sorted(map(repr, out)) == sorted(map(repr, expected))


def test_one_and_none(frame):
    [row] = fp.fingerprint_documents(frame([(7, "a b c d e f g h")])).collect()
    assert row["n_chars"] == 15 and row["near_next"] == 1.0
    assert bytes(row["edited_sha256"]) == hashlib.sha256(b"a b c d e f a b").digest()
    assert fp.fingerprint_documents(frame([])).count() == 0


def test_copies_of_one_id(spark, frame):
    """A common row and many texts of one id neither fail nor get lost."""
    rows = [(5, "same words in all of these rows")] * 400 + [(5, prose(s, 20)) for s in range(200)] + [(6, "end")]
    out = fp.fingerprint_documents(frame(rows, 4)).collect()
    assert len(out) == len(rows)
    assert sum(r["near_next"] == 1.0 for r in out) >= 399


def test_likeness_estimates_jaccard():
    """Over texts of any length, the mean error is small and no error is beyond what 256 bins explain."""
    random.seed(3)
    errors = []
    for k in range(300):
        words = prose(k, random.choice([40, 200, 800, 3000])).split()
        changed = list(words)
        for _ in range(len(words) * (k % 8) // 100):
            changed[random.randrange(len(words))] = f"new{random.random()}"
        one, other = " ".join(words), " ".join(changed)
        a, b = fp.fingerprints([one, other])
        errors.append(fp.likeness(a, b) - exact(one, other))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.05 and max(map(abs, errors)) < 0.2


def test_equal_texts_and_empty_bins():
    few = "just six words are in here"
    a, b, c = fp.fingerprints([few, few, few + " more"])
    assert (a == b).all() and fp.likeness(a, b) == 1.0
    assert abs(fp.likeness(a, c) - 2 / 3) < 0.2
    assert fp.fingerprints(["", " \n"]) == [None, None]
    assert fp.likeness(None, None) == 1.0 and fp.likeness(None, a) == 0.0
    assert len(fp.packed(a)) == 128 and fp.packed(None) == b""


def test_densification_by_hand():
    """Every bin holds the least hash of its own or of the first bin that answers it."""
    shingles = dict(shingle_sets([prose(5, 60)]))[0]
    least = {}
    for value in shingles.tolist():
        least[value >> 56] = min(value, least.get(value >> 56, value))
    bins = fp.bins_of(shingles)
    for b in range(256):
        donor, k = b, 0
        while donor not in least:
            donor, k = int(fp.donors(k // fp.ATTEMPTS)[k % fp.ATTEMPTS, b]), k + 1
        assert bins[b] == least[donor] & 15
