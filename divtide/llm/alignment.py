"""Alignment of two tokenizers on whole texts, by skipping along diagonals.

A text is tokenised by a byte-level vocabulary A (the file's merges, run by tiktoken) and by a sentencepiece
vocabulary B. Both see the same bytes, a space and the text. Tokens are known by the offsets at which they
end; offsets where both end cut the tokens into groups.

Most groups hold one token of each side, in long stretches over which the index of B's token is that of A's
plus a fixed shift: a diagonal. From the start of a stretch the two arrays of ends are compared at that
shift, over 1, 2, 4, ... entries while they agree, then over half as many until the first difference is
found. The group there is irregular: the side that ends earlier moves on until both end together. That gives
the links inside the group and the shift for the next stretch.

Counts of id pairs: each task counts in how many of its documents a pair is linked, the counts are summed by
pair, and a pair is best if no other of its A id has more. Documents keep their distinct pairs in compact
form and look the commonest ones up in an array of at most `HEAD` pairs, which is broadcast; all other pairs
are joined with their counts by shuffle. That is one plan for tables of any size.

Defined cases: texts that are NULL, empty or not given back by the tokens of B (such as texts with U+2581)
have no tokens, all their numbers are 0 and their digest is ''. A NULL doc_id is carried. Repeated rows are
documents of their own. An empty table gives no rows. Other columns of the input are not read. A long text
needs memory for its own tokens only.
"""

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored
from divtide.llm.packing import PATTERN, byte_of_character
from divtide.llm.token_counts import MARK, PRE_TOKEN, load

HEAD = 1 << 20  # pairs that are broadcast
HELD = 1 << 21  # pairs that a task holds before it counts them
ROWS = 500  # documents that a worker handles before it hands them on
REMEMBERED = 400_000  # words whose pieces a worker keeps
BUCKETS = 16  # steps of the histogram of counts for each power of two
ALIGNED = {
    "key": pa.int64(),
    "doc_id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "pairs": pa.binary(),
    # Rows of another kind: how many documents of a task hold a pair.
    "pair": pa.int64(),
    "docs": pa.int64(),
}
SUMMED = {
    **{name: kind for name, kind in ALIGNED.items() if name not in ("pairs", "docs")},
    "n_best": pa.int64(),
    "count_sum": pa.int64(),
    "links": pa.int64(),
}
TYPES = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spark_schema(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {TYPES[kind]}" for name, kind in columns.items())


def batch_of(schema: dict[str, pa.DataType], columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in schema.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer rows at a time, since a row's arrays are larger than the row."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


class ByteLevel:
    """Ids of a byte-level vocabulary, special strings as plain text; the bytes and the digits of each id."""

    def __init__(self, model: bytes):
        import tiktoken

        spec = json.loads(model)
        special = {t["content"] for t in spec["added_tokens"]}
        byte = byte_of_character()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.encode = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = 1 + max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])])
        self.lengths = np.zeros(self.size, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)


class Pieces(dict):
    """Ids of a sentencepiece vocabulary, word by word, and the bytes of each id.

    No piece holds a space mark behind another character (checked), so words with the spaces before them are
    independent. The dictionary remembers the ids of words, written without their first space.
    """

    def __init__(self, model: bytes):
        self.library = load(model)
        self.size = self.library.vocab_size()
        self.octets = []
        for i in range(self.size):
            piece = self.library.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"{piece!r} joins two words, so words cannot be encoded one by one")
            self.octets.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(MARK, " ").encode())
        self.lengths = np.array([len(x) for x in self.octets], np.int64)
        self.begins = np.array([x[:1] == b" " and not self.library.is_byte(i) for i, x in enumerate(self.octets)])

    def encoded(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words, encoded as one text; each begins with the only pieces that begin with a space mark."""
        plain = [word for word in words if word and " " not in word]
        ids = np.array(self.library.encode(" ".join(plain), num_threads=1), "<u4")
        data, bounds = ids.tobytes(), [*(4 * np.flatnonzero(self.begins[ids])).tolist(), 4 * len(ids)]
        out = {word: data[start:end] for word, start, end in zip(plain, bounds, bounds[1:])}
        for word in words.difference(plain):
            # The library gives nothing for an empty word; behind its space it is the piece of a space.
            own = self.library.encode(word, num_threads=1) if word else [self.library.piece_to_id(MARK)]
            out[word] = np.array(own, "<u4").tobytes()
        return out

    def ids(self, text: str) -> np.ndarray:
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [x[1:] for x in PRE_TOKEN.findall(" " + text)]
        else:
            words = text.split(" ")
        found = list(map(self.get, words))
        if None in found:
            new = self.encoded({word for word, ids in zip(words, found) if ids is None})
            found = [new[word] if ids is None else ids for word, ids in zip(words, found)]
            if len(self) < REMEMBERED:
                self.update(new)
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64)


def skip_diagonals(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """The links of irregular groups but for the last of each, as places on both sides.

    Both arrays ascend and end with the same offset. In a link found here, the token that ends first is not the
    last of its group; every other token is. What is skipped are groups of one token on each side.
    """
    at, shift, n, inner_a, inner_b = 0, 0, len(ends_a), [], []
    while at < n:
        step = 1
        while ends_a[at : at + step] == ends_b[at + shift : at + shift + step]:
            at += step
            if at >= n:
                return inner_a, inner_b
            step *= 2
        while step > 1:
            step //= 2
            if ends_a[at : at + step] == ends_b[at + shift : at + shift + step]:
                at += step
        # Both sides reach the last offset, so a difference stands before it and the walk below ends.
        i, j = at, at + shift
        end_a, end_b = ends_a[i], ends_b[j]
        while end_a != end_b:
            inner_a.append(i)
            inner_b.append(j)
            if end_a < end_b:
                i += 1
                end_a = ends_a[i]
            else:
                j += 1
                end_b = ends_b[j]
        at, shift = i + 1, j - i
    return inner_a, inner_b


class Aligner:
    def __init__(self, model_a: bytes, model_b: bytes):
        self.a, self.b = ByteLevel(model_a), Pieces(model_b)
        self.width = np.dtype("<u4" if self.a.size * self.b.size < 1 << 32 else "<u8")
        # Each id of A and of B as it is written inside a group and at its side's end.
        self.written = [f"{i}{mark}" for marks, n in ((",|", self.a.size), (",;", self.b.size)) for mark in marks for i in range(n)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, None where the text has no tokens."""
        if not text or MARK in text:
            return None
        b = self.b.ids(text)
        if b"".join(map(self.b.octets.__getitem__, b.tolist())) != (" " + text).encode():
            return None
        return np.array(self.a.encode(" " + text), np.int64), b

    def align(self, text: str | None) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, the groups' digest, the distinct linked pairs and their links."""
        found = self.tokens(text)
        if found is None:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids_a, ids_b = found
        ends_a, ends_b = self.a.lengths[ids_a].cumsum(), self.b.lengths[ids_b].cumsum()
        inner_a, inner_b = (np.array(x, np.int64) for x in skip_diagonals(ends_a.tolist(), ends_b.tolist()))
        last_a, last_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
        a_first = ends_a[inner_a] < ends_b[inner_b]
        last_a[inner_a[a_first]] = False
        last_b[inner_b[~a_first]] = False
        end_a, end_b = np.flatnonzero(last_a), np.flatnonzero(last_b)

        pairs = ids_a[np.concatenate([inner_a, end_a])] * self.b.size + ids_b[np.concatenate([inner_b, end_b])]
        distinct, links = np.unique(pairs, return_counts=True)
        # A token of A stands behind all tokens of B of the groups before its own, and the other way round.
        before_a = np.concatenate([[0], end_b[:-1] + 1])[last_a.cumsum() - last_a]
        before_b = (end_a + 1)[last_b.cumsum() - last_b]
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + before_a] = ids_a + last_a * self.a.size
        order[np.arange(len(ids_b)) + before_b] = ids_b + last_b * self.b.size + 2 * self.a.size
        groups = "".join(map(self.written.__getitem__, order.tolist()))
        digest = hashlib.sha256(groups[:-1].encode()).hexdigest()
        return len(ids_a), len(ids_b), len(end_a), len(pairs), digest, distinct, links

    def pack(self, distinct: np.ndarray, links: np.ndarray) -> bytes:
        """Differences of ascending pairs and links less one, by planes of bytes, which compress well."""
        steps = np.diff(distinct, prepend=0).astype(self.width)
        return b"".join(planes(x) for x in (steps, (links - 1).astype("<u4")))

    def unpack(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = len(data) // (self.width.itemsize + 4)
        split = n * self.width.itemsize
        steps, links = unplanes(data[:split], self.width), unplanes(data[split:], np.dtype("<u4"))
        return steps.astype(np.int64).cumsum(), links.astype(np.int64) + 1


def planes(numbers: np.ndarray) -> bytes:
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def unplanes(data: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


ALIGNERS: dict[int, Aligner] = {}  # one for each pair of models, kept while a worker lives


class Counts:
    """Documents by pair, in memory bounded by `HELD` distinct pairs and as many waiting."""

    def __init__(self):
        self.pairs, self.docs, self.waiting, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, distinct: np.ndarray) -> None:
        self.waiting.append(distinct)
        self.n += len(distinct)

    def merge(self) -> None:
        every = np.concatenate([self.pairs, *self.waiting])
        weight = np.concatenate([self.docs, np.ones(self.n, np.int64)])
        self.pairs, place = np.unique(every, return_inverse=True)
        self.docs = np.bincount(place, weight, len(self.pairs)).astype(np.int64)
        self.waiting, self.n = [], 0

    def taken(self) -> Iterator[pa.RecordBatch]:
        """The counts as rows; they start anew."""
        for at in range(0, len(self.pairs), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield batch_of(ALIGNED, {"pair": self.pairs[part], "docs": self.docs[part]})
        self.__init__()


def align_documents(docs: DataFrame, shared) -> DataFrame:
    """A row for each document, with a key of its own, and rows of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = aligner_of(shared), Counts()
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows = [aligner.align(text) for text in batch.column(1).to_pylist()]
            for row in rows:
                counts.add(row[5])
                if counts.n > HELD:
                    counts.merge()
                    if len(counts.pairs) > HELD:
                        yield from counts.taken()
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*(r[:5] for r in rows))))
            keys = np.arange(key, key + len(rows))
            key += len(rows)
            packed = [aligner.pack(*r[5:]) for r in rows]
            yield batch_of(ALIGNED, {"key": keys, "doc_id": batch.column(0), **columns, "pairs": packed})
        counts.merge()
        yield from counts.taken()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, spark_schema(ALIGNED))


def aligner_of(shared) -> Aligner:
    models = shared.value
    key = hash(models)
    if key not in ALIGNERS:
        ALIGNERS[key] = Aligner(*models)
    return ALIGNERS[key]


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, its count `n`, and whether no other pair of its A id has more."""
    summed = aligned.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("n"))
    summed = stored(summed, "pair-counts", compression="zstd")
    a = F.expr(f"pair div {size_b}L").alias("a")
    best = summed.groupBy(a).agg(F.max("n").alias("most"))  # at most a row for each id of A
    joined = summed.select("*", a).join(F.broadcast(best), "a")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def head_bound(counts: DataFrame, size: int) -> int:
    """A count that at most `size` pairs reach, from a histogram in steps of a sixteenth of each power of two."""
    step = F.floor(F.log2(F.col("n").cast("double")) * BUCKETS).alias("step")
    histogram = counts.groupBy(step).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    bound, reached = None, 0
    for row in sorted(histogram, key=lambda r: -r["step"]):
        reached += row["pairs"]
        if reached > size:
            break
        bound = row["least"]
    return bound if bound is not None else 1 << 62


def look_up(aligned: DataFrame, shared, head) -> DataFrame:
    """Documents with the sums over their commonest pairs; their other pairs as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, (known, n, best) = aligner_of(shared), head.value
        kept = [c for c in SUMMED if c in ALIGNED and c != "pair"]
        for batch in slices(batches):
            columns = {c: batch.column(c) for c in kept}
            n_best, count_sum, keys, rest, rest_links = [], [], [], [], []
            for key, data in zip(batch.column("key").to_pylist(), batch.column("pairs").to_pylist()):
                pairs, links = aligner.unpack(data)
                place = np.searchsorted(known, pairs)
                place[place == len(known)] = 0
                found = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
                at, weight = place[found], links[found]
                n_best.append(int(weight[best[at]].sum()))
                count_sum.append(int((n[at] * weight).sum()))
                if not found.all():
                    keys.append(np.full(len(pairs) - len(at), key))
                    rest.append(pairs[~found])
                    rest_links.append(links[~found])
            yield batch_of(SUMMED, {**columns, "n_best": n_best, "count_sum": count_sum})
            if keys:
                yield batch_of(SUMMED, {"key": np.concatenate(keys), "pair": np.concatenate(rest), "links": np.concatenate(rest_links)})

    return aligned.where("pair IS NULL").mapInArrow(run, spark_schema(SUMMED))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, head_size: int = HEAD) -> DataFrame:
    """The contract's row for each document: sizes, groups, links, and sums of the links' counts."""
    with open(path_a, "rb") as file_a, open(path_b, "rb") as file_b:
        models = file_a.read(), file_b.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(models)
    aligned = stored(align_documents(docs, shared), "aligned", compression="zstd")

    counts = stored(pair_counts(aligned, load(models[1]).vocab_size()), "pairs", compression="zstd")
    bound = head_bound(counts, head_size)
    # At most `head_size` rows of 17 bytes, whatever the corpus.
    common = counts.where(F.col("n") >= bound).toArrow().sort_by("pair")
    head = context.broadcast(tuple(common.column(c).to_numpy() for c in ("pair", "n", "best")))
    summed = stored(look_up(aligned, shared, head), "summed", compression="zstd")

    rare = summed.where("pair IS NOT NULL").select("key", "pair", "links")
    rare = rare.join(counts.where(F.col("n") < bound), "pair")
    rare = rare.groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("n") * F.col("links")).alias("rare_sum"),
    )
    every = summed.where("pair IS NULL").drop("pair", "links").join(rare, "key", "left")
    return every.withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("rare_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)),
        }
    ).select(RESULT)
