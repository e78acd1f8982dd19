"""Jaccard join and containment search against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from divtide.llm import decontaminate, jaccard_join
from divtide.llm.components import components
from divtide.llm.shingles import shingle_sets
from tests.llm.conftest import EDGES, prose


def shingles(text):
    words = [w for w in __import__("re").findall(r"[^ \t-\r]+", text or "")]
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def edited(text, n, rng):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_shingle_sets_count_like_sets():
    texts = [t or "" for _, t in EDGES] + ["a b c d e " * 9, "x" * 3_000_000 + " y"]
    for i, found in shingle_sets(texts):
        assert len(found) == len(shingles(texts[i])), i


@pytest.fixture
def near(frame):
    rng = random.Random(5)
    rows = list(EDGES)
    for group in range(6):
        base = prose(50 + group, 120)
        rows += [(100 * group + 200 + k, edited(base, k % 7, rng)) for k in range(9)]
        rows.append((None, base))
    rows += [(900 + i, prose(500 + i, 40)) for i in range(10)] + [(950, "a b c"), (951, "a  b\nc"), (952, "a b")]
    return rows


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    roots = list(range(len(rows)))
    for _ in rows:
        roots = [min([roots[i], *(roots[j] for j in links[i])]) for i in roots and range(len(rows))]
    return links, roots


def test_links_and_classes(frame, near):
    links, roots = brute(near)
    least = {r: min((near[i][0] for i in range(len(near)) if roots[i] == r and near[i][0] is not None), default=None) for r in set(roots)}
    expected = Counter((near[i][0], least[roots[i]], len(links[i])) for i in range(len(near)))
    out = jaccard_join.near_duplicates(frame(near)).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == expected


def test_blocks_lose_nothing(frame, near, monkeypatch):
    """Units of a few nodes each give what one unit gives."""
    links, _ = brute(near)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    out = jaccard_join.near_duplicates(frame(near)).collect()
    assert sorted(r["n_links"] for r in out) == sorted(map(len, links.values()))


def test_keep_one(frame, near):
    _, roots = brute(near)
    wordless = {(i, t) for i, t in near if not shingles(t)}
    docs = frame(near)
    kept = jaccard_join.keep_one(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len({r for r, (_, t) in zip(roots, near) if shingles(t)}) + len(wordless)
    assert jaccard_join.keep_one(frame([])).count() == 0


def test_pruning_keeps_what_reaches_the_threshold():
    fewest = jaccard_join.fewest_matches(0.8, 1e-9)
    assert list(fewest) == sorted(fewest) and fewest[-1] < 0.8 * jaccard_join.VALUES
    rng = np.random.default_rng(1)
    for _ in range(2000):
        hits = np.cumsum(rng.random(jaccard_join.VALUES) < 0.8)[jaccard_join.STEP - 1 :: jaccard_join.STEP]
        assert all(h >= m for h, m in zip(hits, fewest))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_containment(spark, frame):
    rng = random.Random(9)
    items = [(k, prose(3000 + k, 5 + 4 * k)) for k in range(14)] + [(90, "too short"), (91, None), (None, prose(4000, 20)), (3, prose(3003, 17))]
    long = prose(77, 20_000).split(" ")
    rows = list(EDGES)
    for k, text in items:
        if text:
            for n_edits in (0, 1, 2, 5):
                at = rng.randrange(len(long))
                part = edited(text, n_edits, rng).upper() if n_edits == 1 else edited(text, n_edits, rng)
                rows.append((1000 + len(rows), " ".join([*long[:at], part, *long[at:]])))
    expected = Counter()
    for i, text in rows:
        own = shingles((text or "").lower())
        if "too short" in (text or ""):
            expected[i, 90, 1, 1] += 1
        for k, item in items:
            wanted = shingles((item or "").lower())
            if len((item or "").split()) >= 5 and len(own & wanted) >= 0.8 * len(wanted) - 1e-9:
                expected[i, k, len(wanted), len(own & wanted)] += 1
    table = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    out = decontaminate.contained(frame(rows), table).collect()
    assert Counter((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in out) == expected
    docs = frame(rows)
    clean = decontaminate.drop_contaminated(docs, table)
    assert clean.schema == docs.schema
    bad = {i for i, *_ in expected}
    assert sorted(r["doc_id"] or 0 for r in clean.collect()) == sorted(i or 0 for i, _ in rows if i not in bad)
    assert decontaminate.contained(frame([]), table).count() == 0
    assert decontaminate.contained(docs, table.where("item_id < 0")).count() == 0


def test_short_items_are_found_by_their_own_length(spark, frame):
    """Items of one to four words, and of five with a blank of another kind, against a search word by word."""
    items = ["zebra", "Lone Wolf", "a b c", "four little words here", "one two three four\u00a0five", "\u3000", "", None, "x"]
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["the ZEBRA and the zebra", "a lone\twolf, lone\nWolf", "c a b c", "a b", "one two three four\u00a0five", "zebras", "four little words", None, "\u3000 here x"]
    rows = list(enumerate(texts + [prose(4, 50) + " four little words here " + prose(5, 50)]))
    expected = set()
    for i, text in rows:
        words = (text or "").lower().encode().split()
        for k, item in enumerate(items):
            wanted = (item or "").lower().encode().split()
            if wanted and any(words[j : j + len(wanted)] == wanted for j in range(len(words))):
                expected.add((i, k, 1, 1, 1.0))
    out = decontaminate.contained(frame(rows), table).drop("doc_key").collect()
    assert sorted(map(tuple, out)) == sorted(expected) and len(expected) >= 7


def test_boilerplate_is_not_compared_on_its_texts(frame):
    """Texts that share a third of their shingles meet in bands, but only near copies reach the exact comparison."""
    common = prose(8000, 60)
    rows = [(k, f"{common} {prose(8100 + k, 60)}") for k in range(240)]
    near = rows[7][1].split(" ")
    near[-1] = "changed"
    rows.append((500, " ".join(near)))
    nodes = jaccard_join.signatures(frame(rows)).withColumn("node", F.col("doc_id")).select("node", "signature", "bands")
    shared = nodes.select("node", F.explode("bands").alias("band")).groupBy("band").count().where("count > 1")
    assert shared.count() > 20
    ties = jaccard_join.candidate_ties(nodes, 0.8, jaccard_join.TOLERANCE).collect()
    assert {tuple(sorted(t)) for t in ties} == {(7, 500)}
    out = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.near_duplicates(frame(rows)).collect()}
    assert out == {k: (7, 1) if k in (7, 500) else (k, 0) for k, _ in rows}


def test_groups_form_like_by_all_pairs():
    """Nodes that hang together, in one block or across two, are those that pairs connect."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (6, jaccard_join.VALUES), dtype=np.uint8)
    values = base[rng.integers(0, 6, 60)]
    values = np.where(rng.random(values.shape) < 0.12, rng.integers(0, 256, values.shape), values).astype(np.uint8)
    fewest = jaccard_join.fewest_matches(0.8, 1e-9)
    for across in (False, True):
        parent = list(range(60))
        for a in range(60):
            for b in range(a + 1, 60):
                counts = [(values[a, : (k + 1) * 32] == values[b, : (k + 1) * 32]).sum() for k in range(4)]
                if all(c >= f for c, f in zip(counts, fewest)) and (not across or a < 25 <= b):
                    parent = [parent[a] if p == parent[b] else p for p in parent]
        group = jaccard_join.hang_together(values, 25 if across else 60, across, fewest).tolist()
        assert {frozenset(np.flatnonzero(np.array(g) == x)) for g in [group] for x in g} == {
            frozenset(np.flatnonzero(np.array(g) == x)) for g in [parent] for x in g
        }
