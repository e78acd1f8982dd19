"""A hashed maximum-entropy language model with a class-factored softmax.

p(word | before) = p(class of word | before) * p(word | class).

- Classes: words are grouped by their last two bytes, and those endings by the endings they follow, so that a
  class is known from a word alone, seen before or not. The end of a text is a class of its own.
- p(class | before) is a softmax over sums of weight rows. A row is chosen by a hash: of the word before, of the
  two before together, and, skipping what is between, of the words two, three and four places before.
- p(word | class) are counts with absolute discounting; what they give up goes to the class's unseen words.

Training sees every training text once. Its texts are dealt to rounds by a hash of the id; in a round each task
follows the gradient over its own texts from the common weights and returns what changed, and changes are
averaged, weighted by tokens, in a tree of bounded groups.

Counts are exact for every word. The commonest words (`HEAD` at most) go to the workers with the weights; words
beyond them are joined with the table of counts by shuffle, so no part of the vocabulary is lost.

Defined cases: a NULL or empty text is its end token alone. A NULL doc_id is held out. Repeated rows are
learned from and scored one by one. With nothing to learn from, N and V are 0 and the base score is 0. Other
columns of the input are not read.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import held_out, stored, whole_text
from divtide.llm.shingles import chunks, mix, word_prints

FOLDS = 7
CLASSES = 32
END_CLASS = CLASSES - 1
UNITS = 256  # groups of endings that classes are made from; the last is the end of a text
ROWS = 1 << 14  # weight rows; row 0 is the bias
ROUNDS = 3
TASK_TOKENS = 4_000_000  # that a gradient task has at least, on average
BATCH = 2048  # tokens whose gradients are summed before a step
RATE = 0.15
HEAD = 400_000
HELD = 600_000  # distinct words that a counting task holds before it hands them on
FAN = 64  # updates that are averaged in one group
BLOCK_ROWS = 512
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Tokens without the end; only A to Z are lowered, and only the six white-space codes split."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# Counts


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary, empty for the end) and how often it stands in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
                counts[END] += 1
                if len(counts) > HELD:
                    yield flush()
        yield flush()

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, most: int = HEAD) -> tuple[list[bytes], np.ndarray]:
    """All words above a count chosen so that there are at most `most` of them."""
    steps = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(steps.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    total, lowest = 0, None
    for row in sizes:
        total += row["words"]
        if total > most:
            break
        lowest = row["step"]
    if lowest is None:
        return [], np.zeros(0, np.int64)
    rows = counts.where(steps >= lowest).toPandas()
    return [bytes(w) for w in rows["word"]], rows["n"].to_numpy()


# Classes


def unit(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The group of an ending, from a word's last byte and the one before it (0 if it has one byte)."""
    return (last.astype(np.int64) * 31 + before.astype(np.int64) * 7) % (UNITS - 1)


class Tokens:
    """Fingerprint, unit and text of each token of a run of texts, ends included."""

    def __init__(self, held: list[bytes]):
        data = b" ".join(x.lower() for x in held)
        prints, at = word_prints(data)
        begins = np.cumsum([0, *[len(x) + 1 for x in held]])
        bounds = np.searchsorted(at, begins)
        self.starts = bounds + np.arange(len(bounds))
        n = int(self.starts[-1])
        owner = np.repeat(np.arange(len(held)), np.diff(bounds))
        place = np.arange(len(prints)) + owner
        self.prints = np.full(n, 1, np.uint64)
        self.prints[place] = prints
        self.units = np.full(n, UNITS - 1)
        if len(prints):
            codes = np.frombuffer(data + b" ", np.uint8)
            blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
            ends = np.flatnonzero(blank)
            last = ends[np.searchsorted(ends, at)] - 1
            self.units[place] = unit(codes[last], np.where(last > at, codes[last - 1], 0))
        self.owner = np.repeat(np.arange(len(held)), np.diff(self.starts))
        self.at = np.arange(n) - self.starts[self.owner]

    def before(self, k: int) -> np.ndarray:
        """The fingerprint k places before, 0 beyond the start of the text."""
        out = np.zeros(len(self.prints), np.uint64)
        out[k:] = self.prints[:-k] if k < len(out) else out[k:]
        out[self.at < k] = 0
        return out

    def rows(self) -> np.ndarray:
        """The weight rows of each token besides the bias, one column per feature."""
        one, two, three, four = (self.before(k) for k in (1, 2, 3, 4))
        seeds = [np.uint64(x) for x in (11, 12, 13, 14, 15)]
        hashed = [mix(one + seeds[0]), mix(mix(one + seeds[1]) + two), mix(two + seeds[2]), mix(three + seeds[3]), mix(four + seeds[4])]
        return np.stack([(h % np.uint64(ROWS - 1) + np.uint64(1)).astype(np.uint16) for h in hashed], axis=1)


def token_runs(texts: list[str | None]) -> Iterator[tuple[int, Tokens]]:
    for first, held in chunks([x or "" for x in texts]):
        yield first, Tokens(held)


def unit_pairs(texts: DataFrame) -> np.ndarray:
    """How often each unit follows each unit; a table of fixed size, whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for _, tokens in token_runs(batch.column(0).to_pylist()):
                before = np.append(UNITS - 1, tokens.units[:-1])
                total += np.bincount(before * UNITS + tokens.units, minlength=UNITS * UNITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["pair", "n"])

    rows = texts.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(UNITS * UNITS, np.int64)
    for row in rows:
        table[row["pair"]] = row["n"]
    return table.reshape(UNITS, UNITS)


def classes_of_units(pairs: np.ndarray) -> np.ndarray:
    """The class of each unit: k-means over the square roots of what stands before it, weighted by mass."""
    mass = pairs.sum(axis=0)[:-1].astype(float)
    points = np.sqrt(pairs[:, :-1].T / np.maximum(mass, 1)[:, None])
    k = CLASSES - 1
    out = np.arange(UNITS) % k
    out[-1] = END_CLASS
    if not mass.any():
        return out
    centres = [points[np.argmax(mass)]]
    for _ in range(k - 1):
        gap = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[np.argmax(gap * mass)])
    centres = np.array(centres)
    for _ in range(25):
        near = np.argmin(((points[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1)
        for c in range(k):
            own = near == c
            if mass[own].sum() > 0:
                centres[c] = np.average(points[own], axis=0, weights=mass[own])
    out[:-1] = near
    return out


# Weights


def rows_at(table: np.ndarray, places: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """`table[places]`; the places are known to lie in it, which saves a check and a copy."""
    return np.take(table, places, axis=0, out=out, mode="clip")


def probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Softmax over the classes for each token; rows has a column per feature."""
    sums = np.repeat(weights[:1], len(rows), axis=0)
    one = np.empty_like(sums)
    for k in range(rows.shape[1]):
        sums += rows_at(weights, rows[:, k], out=one)
    sums -= sums.max(axis=1, keepdims=True)
    np.exp(sums, out=sums)
    sums /= sums.sum(axis=1, keepdims=True)
    return sums


def follow_gradient(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> None:
    """One step over a batch, in place; each row has its own step length, from the gradients it has had."""
    error = probabilities(weights, rows)
    error[np.arange(len(rows)), classes] -= 1
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    placed, token = flat[order], order // rows.shape[1]
    starts = np.flatnonzero(np.append(True, placed[1:] != placed[:-1]))
    times = np.diff(np.append(starts, len(placed)))
    # Most rows stand once in a batch, so only the others have something to add up.
    summed, often = rows_at(error, token[starts]), times > 1
    if often.any():
        bounds = np.append(0, np.cumsum(times[often])[:-1])
        summed[often] = np.add.reduceat(rows_at(error, token[np.repeat(often, times)]), bounds, axis=0)
    touched = placed[starts]
    for at, gradient in ((touched, summed), (np.zeros(1, int), error.sum(axis=0, keepdims=True))):
        past = squares[at] + np.einsum("ij,ij->i", gradient, gradient) / np.float32(gradient.shape[1])
        squares[at] = past
        gradient *= (RATE / np.sqrt(past + 1e-6))[:, None]
        weights[at] -= gradient


UPDATE_SCHEMA = "block int, task long, tokens double, change binary"


def one_round(texts: DataFrame, weights: np.ndarray, squares: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The common weights after each task has followed its own gradient; step lengths are kept alike."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((weights, squares, class_of))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, past, classes = shared.value
        own, steps, tokens = start.copy(), past.copy(), 0
        for batch in batches:
            for _, run in token_runs(batch.column(0).to_pylist()):
                rows, wanted = run.rows(), classes[run.units]
                # Texts next to each other may be alike; a fixed stride mixes them within the run.
                order = np.argsort(mix(np.arange(len(wanted)).astype(np.uint64)))
                for at in range(0, len(order), BATCH):
                    part = order[at : at + BATCH]
                    follow_gradient(own, steps, rows[part], wanted[part])
                tokens += len(wanted)
        task = TaskContext.get().partitionId()
        change = np.concatenate([own - start, (steps - past)[:, None]], axis=1).astype(np.float32)
        blocks = range(ROWS // BLOCK_ROWS) if tokens else ()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(blocks), pa.int32()),
                pa.array([task for _ in blocks], pa.int64()),
                pa.array([float(tokens) for _ in blocks], pa.float64()),
                pa.array([change[b * BLOCK_ROWS : (b + 1) * BLOCK_ROWS].tobytes() for b in blocks], pa.binary()),
            ],
            names=["block", "task", "tokens", "change"],
        )

    def average(table: pa.Table) -> pa.Table:
        tokens = table.column("tokens").to_numpy()
        changes = [np.frombuffer(x, np.float32) for x in table.column("change").to_pylist()]
        mean = sum(c * np.float32(t / tokens.sum()) for c, t in zip(changes, tokens))
        first = table.slice(0, 1)
        return pa.table(
            {
                "block": first.column("block"),
                "task": first.column("task"),
                "tokens": pa.array([float(tokens.sum())]),
                "change": pa.array([mean.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    updates = stored(texts.select("text").mapInArrow(learn, UPDATE_SCHEMA), "updates")
    tasks = (updates.agg(F.max("task").alias("n")).first()["n"] or 0) + 1
    while True:
        updates = updates.withColumn("task", F.floor(F.col("task") / FAN).cast("long"))
        updates = updates.groupBy("block", "task").applyInArrow(average, UPDATE_SCHEMA)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    weights, squares = weights.copy(), squares.copy()
    for row in updates.collect():
        change = np.frombuffer(row["change"], np.float32).reshape(BLOCK_ROWS, CLASSES + 1)
        part = slice(row["block"] * BLOCK_ROWS, (row["block"] + 1) * BLOCK_ROWS)
        weights[part] += change[:, :-1]
        squares[part] += change[:, -1]
    return weights, squares


# The model


SCORED_SCHEMA = (
    "doc_id long, n_tokens long, known long, base double, score double, tail array<struct<word: binary, class: int, n: long>>"
)


class Model:
    """Counts, classes and weights learned from `docs`; `score` applies them to any documents."""

    def __init__(self, docs: DataFrame, folds: int = FOLDS, rounds: int = ROUNDS):
        self.folds = folds
        texts = docs.where(~held_out(F.col("doc_id"), folds)).select("doc_id", whole_text("text").alias("text"))
        self.counts = stored(count_words(texts), "word-counts")
        sums = self.counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.count("*").alias("v"),
            F.count(F.when(F.col("n") == 1, 1)).alias("once"),
            F.count(F.when(F.col("n") == 2, 1)).alias("twice"),
        ).first()
        self.n, self.v = sums["n"], sums["v"]
        self.discount = min(0.95, max(0.05, sums["once"] / max(1, sums["once"] + 2 * sums["twice"])))
        self.head = head_words(self.counts)

        spread = max(docs.sparkSession.sparkContext.defaultParallelism, -(-self.n // (rounds * TASK_TOKENS)))
        self.class_of = classes_of_units(unit_pairs(texts))
        self.mass, self.types = self.class_masses()
        self.weights, squares = np.zeros((ROWS, CLASSES), np.float32), np.zeros(ROWS, np.float32)
        for r in range(rounds):
            dealt = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == r)
            self.weights, squares = one_round(dealt.coalesce(spread), self.weights, squares, self.class_of)

    def class_masses(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and distinct words of each class; read by ending, of which there are at most 2**16 and a few."""
        ending = F.hex(F.expr("substring(word, -2, 2)"))
        rows = self.counts.groupBy(ending.alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
        mass, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for row in rows:
            c = self.class_of_ending(bytes.fromhex(row["ending"]))
            mass[c] += row["n"]
            types[c] += row["v"]
        return mass, types

    def class_of_ending(self, word: bytes) -> int:
        if not word:
            return END_CLASS
        return int(self.class_of[unit(np.array([word[-1]]), np.array([word[-2] if len(word) > 1 else 0]))[0]])

    def unseen(self) -> np.ndarray:
        """log10 p(unseen word | class); certain in a class that training never met."""
        return np.log10(np.where(self.mass > 0, self.discount * self.types / np.maximum(self.mass, 1), 1.0))

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per document row."""
        total, discount = self.n + self.v + 1, self.discount
        words, n = self.head
        per_word = [self.class_of_ending(w) for w in words]
        log_mass = np.log10(np.maximum(self.mass, 1))
        head_base = np.log10((n + 1) / total)
        head_own = np.log10(n - discount) - log_mass[np.array(per_word, int)] if len(words) else np.zeros(0)
        packed = zlib.compress(b" ".join(w or b"\n" for w in words), 1)
        shared = docs.sparkSession.sparkContext.broadcast((packed, head_base, head_own, self.weights, self.class_of))

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packed, base10, own10, weights, class_of = shared.value
            names = zlib.decompress(packed)
            place = {END if w == b"\n" else w: i for i, w in enumerate(names.split(b" "))} if names else {}
            base10, own10 = np.append(base10, 0.0), np.append(own10, 0.0)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                out: list[list] = [[], [], [], []]
                tail: list[list] = [[], [], []]
                bounds = [0]
                for first, run in token_runs(texts):
                    rows, classes = run.rows(), class_of[run.units]
                    logs = np.empty(len(classes))
                    for at in range(0, len(classes), BATCH * 4):
                        part = slice(at, at + BATCH * 4)
                        p = probabilities(weights, rows[part])
                        logs[part] = np.log10(p[np.arange(len(p)), classes[part]], dtype=float)
                    for i in range(len(run.starts) - 1):
                        span = slice(run.starts[i], run.starts[i + 1])
                        tokens = words_of(texts[first + i])
                        tokens.append(END)
                        found = np.fromiter(map(place.get, tokens, repeat(-1)), np.int64, len(tokens))
                        missing = np.flatnonzero(found < 0)
                        rest = Counter(zip(map(tokens.__getitem__, missing.tolist()), classes[span][missing].tolist()))
                        out[0].append(len(tokens))
                        out[1].append(len(tokens) - len(missing))
                        out[2].append(float(base10[found].sum()))
                        out[3].append(float(own10[found].sum() + logs[span].sum()))
                        for column, values in zip(tail, (*(zip(*rest) if rest else ((), ())), rest.values())):
                            column.extend(values)
                        bounds.append(len(tail[0]))
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                fields = [pa.array(x, kind) for x, kind in zip(tail, (pa.binary(), pa.int32(), pa.int64()))]
                listed = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, names=["word", "class", "n"])
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(x, kind) for x, kind in zip(out, kinds)], listed],
                    names=["doc_id", "n_tokens", "known", "base", "score", "tail"],
                )

        read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
        scored = read.mapInArrow(compute, SCORED_SCHEMA).withColumn("row", F.monotonically_increasing_id())
        scored = stored(scored, "scored")
        # Words beyond the head: counts by shuffle. Below the head's least count, so no word is hot.
        tail = scored.select("row", F.inline("tail")).join(self.counts.withColumnRenamed("n", "c"), "word", "left")
        c = F.coalesce("c", F.lit(0))
        mass = F.element_at(F.array(*[F.lit(float(x)) for x in log_mass]), F.col("class") + 1)
        unseen = F.element_at(F.array(*[F.lit(float(x)) for x in self.unseen()]), F.col("class") + 1)
        own = F.when(c > 0, F.log10(F.greatest(c - discount, F.lit(1e-9))) - mass).otherwise(unseen)
        sums = tail.groupBy("row").agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(total)))).alias("tail_base"),
            F.sum(F.col("n") * own).alias("tail_score"),
        )
        joined = scored.drop("tail").join(sums, "row", "left")
        return joined.select(
            "doc_id",
            held_out(F.col("doc_id"), self.folds).alias("held_out"),
            "n_tokens",
            (F.col("known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(self.n).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
        )
