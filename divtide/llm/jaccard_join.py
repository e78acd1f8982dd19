"""Joins documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. Each text gets 128 MinHash values and from them 32 band keys of four values. Texts at the threshold share a
   band with a probability above 1 - 10^-7; equal texts are one node from here on.
2. Nodes that share a band key are compared 32 MinHash values at a time; after each step those pairs are dropped
   whose posterior probability of reaching the threshold, from a uniform prior, is below a tolerance. Only the low
   byte of each value is sent for that, which lets a few pairs more through and none less. Pairs that already
   hang together by others are not compared. A unit of work returns for each node the least one that it hangs
   together with, so a group of thousands of near copies never becomes a table of pairs.
3. The connected components of these ties hold every pair that may reach the threshold. They are cut into blocks
   of nodes, and each pair of blocks is one unit of work. There pairs are pruned again, now on whole values, and
   the rest verified exactly on their shingles. Texts are sent to these units only. A unit returns for each node
   the number of its links and the least node it hangs together with.
4. Classes are the connected components of verified links.

Defined cases: a text without words has no links and a class of its own; texts with one to four words have one
shingle. Repeated rows and equal texts are linked to each other. A class is named by the least doc_id of its
members, NULL if all are NULL. Other columns of the input are not read.
"""

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored, whole_text
from divtide.llm.components import components
from divtide.llm.shingles import mix, shingle_runs, shingle_sets

THRESHOLD = 0.8
TOLERANCE = 1e-9
VALUES, BANDS, STEP = 128, 32, 32
BLOCK = 1024  # nodes that a unit of work has from each side
SLICE = 1 << 15  # shingles that are hashed together, to stay in cache

RNG = np.random.default_rng(20_240_501)
FACTORS = RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def min_hashes(prints: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values of runs of shingles (a row per text, a column per hash); every run has a shingle."""
    out = np.empty((VALUES, len(starts)), np.uint32)
    bounds = np.append(starts, len(prints))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE, "right")) - 1)
        part = prints[bounds[first] : bounds[last]]
        at = bounds[first:last] - bounds[first]
        for k in range(VALUES):
            hashed = ((part * FACTORS[k] + TERMS[k]) >> np.uint64(32)).astype(np.uint32)
            out[k, first:last] = np.minimum.reduceat(hashed, at)
        first = last
    return out.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    bands = values.reshape(len(values), BANDS, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
    for k in range(bands.shape[2]):
        key = mix(key * FACTORS[0] + bands[:, :, k])
    return key


@lru_cache
def fewest_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """After each step, the least number of matches with which a pair stays.

    With m of n values equal, the posterior of the similarity is Beta(m + 1, n - m + 1); that it reaches the
    threshold t is as likely as at most m successes in n + 1 trials of probability t.
    """
    fewest = []
    for n in range(STEP, VALUES + 1, STEP):
        likely, m = 0.0, -1
        while likely < tolerance:
            m += 1
            likely += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        fewest.append(m)
    return tuple(fewest)


SIGNATURE_SCHEMA = "doc_id long, doc_key binary, n_shingles long, signature binary, bands array<long>"


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the MD5 of the text as `doc_key`."""
    text = whole_text("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("doc_key"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document row; signature and bands are NULL where there is no shingle."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts, signed, bands = [], [], []
            for _, prints, starts in shingle_runs(texts):
                n = np.diff(starts)
                some = np.flatnonzero(n)
                values = min_hashes(prints, starts[:-1][some])
                keys = band_keys(values).view(np.int64)
                row_of = dict(zip(some.tolist(), range(len(some))))
                for i in range(len(n)):
                    row = row_of.get(i)
                    counts.append(int(n[i]))
                    signed.append(None if row is None else values[row].tobytes())
                    bands.append(None if row is None else keys[row])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(signed, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "doc_key", "n_shingles", "signature", "bands"],
            )

    return keyed(docs).mapInArrow(sign, SIGNATURE_SCHEMA)


def pair_links(left: list, right: list | None, threshold: float, tolerance: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each node and ties (position, least position) between nodes that hang together.

    Nodes are (copies, values, shingles); positions count `left` first. With `right`, only pairs across.
    """
    nodes = left + (right or [])
    copies = np.array([x[0] for x in nodes], np.int64)
    values = np.stack([x[1] for x in nodes])
    _, ids = np.unique(np.concatenate([x[2] for x in nodes]), return_inverse=True)
    sizes = np.array([len(x[2]) for x in nodes])
    bounds = np.append(0, np.cumsum(sizes))
    fewest = fewest_matches(threshold, tolerance)
    links = np.zeros(len(nodes), np.int64)
    parent = np.arange(len(nodes))
    held = np.zeros(int(ids.max()) + 1, bool)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(left)):
        others = np.arange(len(left) if right is not None else a + 1, len(nodes))
        matches = np.zeros(len(others), np.int64)
        for step, least in enumerate(fewest):
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (values[others, part] == values[a, part]).sum(axis=1)
            stay = matches >= least
            others, matches = others[stay], matches[stay]
        # What is left is verified on the shingles themselves.
        others = others[np.minimum(sizes[others], sizes[a]) >= threshold * np.maximum(sizes[others], sizes[a]) - 1e-9]
        if not len(others):
            continue
        own = ids[bounds[a] : bounds[a + 1]]
        held[own] = True
        common = np.array([np.count_nonzero(held[ids[bounds[b] : bounds[b + 1]]]) for b in others])
        held[own] = False
        linked = others[common >= threshold * (sizes[others] + sizes[a] - common) - 1e-9]
        links[a] += copies[linked].sum()
        links[linked] += copies[a]
        for b in linked:
            x, y = root(a), root(int(b))
            parent[max(x, y)] = min(x, y)
    return links, [(i, root(i)) for i in np.flatnonzero(links).tolist()]


def units_of(batches: Iterator[pa.RecordBatch], width: int = 3) -> Iterator[tuple[tuple, list[tuple]]]:
    """Key and rows of each unit of work; units arrive whole, one behind the other. The key is the first columns."""
    current, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:width] != current:
                if held:
                    yield current, held
                current, held = row[:width], []
            held.append(row[width:])
    if held:
        yield current, held


def in_units(members: DataFrame, key: str) -> DataFrame:
    """Members of groups, dealt so that each pair of blocks of a group is a unit: `key`, low, high, side first.

    `members` have the size `n` of their group; each comes once for every block of it.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    side = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = (
        members.withColumn("blocks", blocks)
        .withColumn("side", side)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(key, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", *[c for c in members.columns if c not in (key, "n")])
    )
    keys = [key, "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def hang_together(values: np.ndarray, split: int, across: bool, fewest: tuple[int, ...]) -> np.ndarray:
    """For each node the least position it hangs together with, by pairs that pruning leaves.

    With `across`, only pairs between the nodes before `split` and those from there on.
    """
    group = np.arange(len(values))
    for a in range(split):
        others = np.arange(split if across else a + 1, len(values))
        others = others[group[others] != group[a]]
        matches = np.zeros(len(others), np.int64)
        for step, least in enumerate(fewest):
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (values[others, part] == values[a, part]).sum(axis=1)
            stay = matches >= least
            others, matches = others[stay], matches[stay]
        if len(others):
            merged = np.append(group[others], group[a])
            group[np.isin(group, merged)] = merged.min()
    return group


TIE_SCHEMA = "a long, b long"


def candidate_ties(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Ties (a, b) between nodes that share a band and whose signatures may belong to texts at the threshold."""
    fewest = fewest_matches(threshold, tolerance)
    low_bytes = F.expr(f"unhex(array_join(transform(sequence(0, {VALUES - 1}), i -> substr(hex(signature), 8 * i + 1, 2)), ''))")
    placed = nodes.select("node", F.explode("bands").alias("band"))
    # Written, so that the join can split a band with very many nodes.
    shared = stored(placed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "bands")
    placed = stored(placed.join(shared, "band"), "band-members")
    few = nodes.join(placed.select("node").distinct(), "node", "left_semi").select("node", low_bytes.alias("low_bytes"))
    units = in_units(placed.join(stored(few, "low-bytes"), "node").select("band", "n", "node", "low_bytes"), "band")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), held in units_of(batches):
            held.sort()
            values = np.frombuffer(b"".join(x[2] for x in held), np.uint8).reshape(len(held), VALUES)
            split = sum(side == low for side, *_ in held) if low != high else len(held)
            group = hang_together(values, split, low != high, fewest)
            tied = np.flatnonzero(group != np.arange(len(group)))
            ends = [[held[i][1] for i in places.tolist()] for places in (tied, group[tied])]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], names=["a", "b"])

    return units.mapInArrow(work, TIE_SCHEMA).distinct()


UNIT_SCHEMA = "node long, links long, root long"


def verify(units: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Node, links and root for each unit of work; units arrive whole and in order within a partition."""

    def flush(held: list, low: int, high: int) -> pa.RecordBatch:
        unit = {}
        for side, node, copies, values, text in held:
            unit.setdefault((side, node), (copies, np.frombuffer(values, np.uint32), text))
        keys = sorted(unit)
        sets = dict(shingle_sets([unit[k][2] for k in keys]))
        nodes = [(unit[k][0], unit[k][1], sets[i]) for i, k in enumerate(keys)]
        split = sum(side == low for side, _ in keys)
        links, ties = pair_links(nodes[:split], nodes[split:] if low != high else None, threshold, tolerance)
        # Positions are not in the order of the nodes, so any of them serves as root.
        rows = [(keys[i][1], int(links[i]), keys[r][1]) for i, r in ties]
        columns = list(zip(*rows)) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), held in units_of(batches):
            yield flush(held, low, high)

    return units.mapInArrow(work, UNIT_SCHEMA)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document row: doc_id, doc_key, class_id, n_links (other rows at the threshold or above), class_node.

    `doc_key` is the MD5 of the text. `class_node` tells classes apart even where ids repeat or are NULL; it is
    NULL for texts without words.
    """
    signed = stored(signatures(docs), "signatures")
    # Equal texts become one node. The key is short, so copies are combined before the shuffle.
    copies = signed.where("signature is not null").groupBy("doc_key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    nodes = stored(copies.withColumn("node", F.monotonically_increasing_id()), "nodes")

    group = stored(components(candidate_ties(nodes, threshold, tolerance)), "groups")

    # Written, as are the names below, so that joins with them can split a root with very many nodes.
    sizes = stored(group.groupBy("root").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    member = group.join(sizes, "root").select("node", "root", "n")
    chosen = stored(member.join(nodes.drop("bands", "first_doc"), "node"), "chosen")
    text = (
        keyed(docs).join(chosen.select("doc_key", "node"), "doc_key").groupBy("node").agg(F.first("text").alias("text"))
    )
    units = in_units(chosen.join(text, "node").select("root", "n", "node", "copies", "signature", "text"), "root")
    found = stored(verify(units, threshold, tolerance), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    named = nodes.select("node", "doc_key", "copies", "first_doc").join(classes, "node", "left").join(links, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    named = stored(named, "named")
    names = stored(named.groupBy("root").agg(F.min("first_doc").alias("class_id")), "names")
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    known = stored(named.join(names, "root").select("doc_key", "class_id", n_links.alias("n_links"), F.col("root").alias("class_node")), "classes")
    result = signed.select("doc_id", "doc_key", "n_shingles").join(known, "doc_key", "left")
    return result.select(
        "doc_id",
        "doc_key",
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "class_node",
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the least doc_id (then the least text key), all its columns.

    Rows with the same id and text are one document. Documents without words are classes of their own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # Read twice, so written: a class must not come out differently the second time.
    classes = stored(near_duplicates(docs, threshold).select("doc_id", "doc_key", "class_node"), "memberships")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key")
    first = classes.where("class_node is not null").groupBy("class_node").agg(F.min(order).alias("first"))
    wordless = classes.where("class_node is null").select("doc_id", "doc_key").distinct()
    winners = stored(first.select("first.doc_id", "first.doc_key").unionByName(wordless), "winners")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(whole_text("text"))).alias("doc_key"), row.alias("row")
    )
    same = rows["doc_id"].eqNullSafe(winners["doc_id"]) & (rows["doc_key"] == winners["doc_key"])
    kept = rows.join(winners, same, "left_semi")
    return kept.groupBy("doc_id", "doc_key").agg(F.first("row").alias("row")).select("row.*")
