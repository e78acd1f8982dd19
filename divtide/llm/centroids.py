"""Clustering of integer vectors around centroids; the nearest centroid wins a tournament of bisectors.

A vector is nearer to centroid j than to i < j just where its product with the normal 2 (c_j - c_i) exceeds
the threshold |c_j|^2 - |c_i|^2. Normals and thresholds of all pairs are integers, computed once a round. A
vector starts with centroid 0 as its champion and meets the others in ascending order: k - 1 sign tests, in
which zero favours the smaller number, leave the nearest centroid. Only its distance is then computed.

All numbers are exact. Components below 2**22 run as doubles, in which no sum here can lose a bit; vectors
with larger ones, or rounds with such a centroid, run as Python integers.

A round is one pass over the kept vectors: tasks add up their vectors by cluster, a few tasks add up these
sums, and the driver gets at most `COMBINERS` rows a centroid. No vector is shuffled, so neither clusters
nor equal vectors of any number weigh on one task.

Defined cases: vectors with another number of components, a NULL or a non-finite one, and NULL vectors are
left out. With fewer kept vectors than centroids there are as many centroids as vectors; without any, no
rows. Repeated rows count one by one; vectors of one id start in the order of their bytes. A NULL vec_id is
carried and hashes as if it were empty. Empty clusters keep their centroid. A distance or a sum of distances beyond
a long is NULL. Other columns of the input are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SMALL = 1 << 22  # with 64 components below this, products, thresholds and distances stay below 2**53
ROWS = 4096  # vectors that are tested together
COMBINERS = 8  # tasks that add up the sums of all others
LONG = 1 << 63
KEPT_SCHEMA = "vec_id long, vector binary, wide boolean"
RESULT_SCHEMA = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """The kept vectors as bytes: 32-bit integers floor(64 x), or the doubles x where one of these is too wide."""
    components = F.col("embedding").cast("array<double>")
    finite = F.forall(components, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = vectors.where((F.size("embedding") == dimensions) & finite)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            with np.errstate(over="ignore"):
                scaled = np.floor(SCALE * values)
            wide = (np.abs(scaled) >= SMALL).any(axis=1)
            small = np.where(wide[:, None], 0, scaled).astype("<i4")
            data = [(values[i] if wide[i] else small[i]).tobytes() for i in range(len(values))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary()), pa.array(wide)], names=["vec_id", "vector", "wide"]
            )

    return kept.select(F.col("vec_id").cast("long"), components.alias("vector")).mapInArrow(convert, KEPT_SCHEMA)


def exact_integers(data: bytes, wide: bool) -> list[int]:
    if not wide:
        return np.frombuffer(data, "<i4").tolist()
    # A double of this size is a whole number, so its product is taken where it cannot overflow.
    return [int(np.floor(SCALE * x)) if abs(x) < 1e300 else int(x) * SCALE for x in np.frombuffer(data, "<f8").tolist()]


class Bisectors:
    """Normals and thresholds between all pairs of centroids, given as lists of integers."""

    def __init__(self, centroids: list[list[int]]):
        self.small = all(abs(x) < SMALL for c in centroids for x in c)
        self.points = np.array(centroids, np.float64 if self.small else object)
        self.normals = 2 * (self.points[None, :, :] - self.points[:, None, :])
        squares = (self.points * self.points).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each vector, the smaller one of two at the same distance."""
        champion = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.points)):
            side = (vectors * self.normals[champion, rival]).sum(axis=1) - self.thresholds[champion, rival]
            champion[(side > 0).astype(bool)] = rival
        return champion

    def distances(self, vectors: np.ndarray, clusters: np.ndarray) -> np.ndarray:
        off = vectors - self.points[clusters]
        return (off * off).sum(axis=1)

    def assigned(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places in the batch, integer vectors, and their clusters, a few thousand at a time."""
        data, wide = batch.column(1), np.array(batch.column(2).to_pylist(), bool)
        if not self.small:
            wide[:] = True
        # Doubles hold what is small, Python integers anything.
        for places, slow in ((np.flatnonzero(~wide), False), (np.flatnonzero(wide), True)):
            for at in range(0, len(places), ROWS):
                part = places[at : at + ROWS]
                if slow:
                    rows = [exact_integers(data[i].as_py(), batch.column(2)[i].as_py()) for i in part.tolist()]
                    vectors = np.array(rows, object)
                else:
                    packed = b"".join(data.take(pa.array(part)).to_pylist())
                    vectors = np.frombuffer(packed, "<i4").reshape(len(part), -1).astype(np.float64)
                yield part, vectors, self.exactly(slow).nearest(vectors)

    def exactly(self, slow: bool) -> "Bisectors":
        """The same bisectors in the numbers that the vectors have."""
        if not (slow and self.small):
            return self
        if not hasattr(self, "slow"):
            self.slow = Bisectors.__new__(Bisectors)
            for name in ("points", "normals", "thresholds"):
                whole = getattr(self, name).astype(np.int64).astype(object)
                setattr(self.slow, name, whole)
        return self.slow


def added_up(rows: Iterator[tuple[int, int, list[int]]]) -> dict[int, list]:
    """By cluster: how many vectors, and the sums of their components."""
    totals: dict[int, list] = {}
    for cluster, n, sums in rows:
        if cluster in totals:
            known = totals[cluster]
            known[0] += n
            known[1] = [x + y for x, y in zip(known[1], sums)]
        else:
            totals[cluster] = [n, sums]
    return totals


def sums_batch(totals: dict[int, list]) -> pa.RecordBatch:
    """Sums are written as text, since they may be of any size."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(totals), pa.int32()),
            pa.array([n for n, _ in totals.values()], pa.int64()),
            pa.array([",".join(map(str, sums)) for _, sums in totals.values()], pa.string()),
        ],
        names=["cluster", "n", "sums"],
    )


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[int]]]:
    for cluster, n, sums in zip(*(c.to_pylist() for c in batch.columns)):
        yield cluster, n, [int(x) for x in sums.split(",")]


def cluster_sums(kept: DataFrame, bisectors: Bisectors) -> dict[int, list]:
    """Number and component sums of the vectors nearest to each centroid."""

    def task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for _, vectors, clusters in bisectors.assigned(batch):
                    for cluster in np.unique(clusters).tolist():
                        mine = vectors[clusters == cluster]
                        yield cluster, len(mine), [int(x) for x in mine.sum(axis=0)]

        yield sums_batch(added_up(parts()))

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield sums_batch(added_up(row for batch in batches for row in rows_of(batch)))

    schema = "cluster int, n long, sums string"
    sums = kept.mapInArrow(task_sums, schema).repartition(COMBINERS).mapInArrow(combined, schema)
    return added_up((r["cluster"], r["n"], [int(x) for x in r["sums"].split(",")]) for r in sums.collect())


def first_centroids(kept: DataFrame, clusters: int, salt: str) -> list[list[int]]:
    """The vectors whose salted ids have the smallest SHA-256, in that order."""
    order = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(order.alias("order"), "vec_id", "wide", "vector").orderBy("order", "vec_id", "wide", "vector")
    return [exact_integers(r["vector"], r["wide"]) for r in rows.limit(clusters).collect()]


def assign(kept: DataFrame, bisectors: Bisectors) -> DataFrame:
    """vec_id, cluster and squared distance of each vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances = np.zeros(batch.num_rows, np.int32), [None] * batch.num_rows
            for places, vectors, nearest in bisectors.assigned(batch):
                clusters[places] = nearest
                exact = bisectors.exactly(vectors.dtype == object).distances(vectors, nearest)
                for i, distance in zip(places.tolist(), exact.tolist()):
                    distances[i] = int(distance) if distance < LONG else None
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(clusters), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return kept.mapInArrow(place, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    salt: str = "1:",
) -> DataFrame:
    """Each kept vector (vec_id, embedding) with its cluster after `rounds` rounds, as the contract names it."""
    spark = vectors.sparkSession
    kept = stored(integer_vectors(vectors, dimensions), "vectors", compression="zstd")
    centroids = first_centroids(kept, clusters, salt)
    if not centroids:
        return spark.createDataFrame([], RESULT_SCHEMA)
    for _ in range(rounds):
        for number, (n, sums) in cluster_sums(kept, Bisectors(centroids)).items():
            centroids[number] = [x // n for x in sums]

    placed = stored(assign(kept, Bisectors(centroids)), "clusters", compression="zstd")
    total = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    by_cluster = placed.groupBy("cluster").agg(total.alias("total")).collect()  # a row for each centroid
    sums = {r["cluster"]: None if r["total"] is None else int(r["total"]) for r in by_cluster}

    def fitting(n: int | None) -> int | None:
        return n if n is not None and n < LONG else None

    whole = None if None in sums.values() else fitting(sum(sums.values()))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(number, fitting(sums[number]), whole, digests[number]) for number in sums]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select([c.split()[0] for c in RESULT_SCHEMA.split(", ")])
