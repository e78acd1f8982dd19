"""Toxicity of whole texts: boosted trees over a dozen dense features, calibrated by isotonic regression.

Labelled rows outside the held-out quarter are split by id into three parts that never mix: one teaches which
words and word beginnings mark toxic texts, one the trees, one the calibration. So the trees see how a learned
lexicon does on texts it was not learned from, and the calibration how trees do on texts new to them.

Defined cases: a NULL or empty text has all features 0 and is scored like any other. A NULL doc_id is carried,
is held out and matches no label. Repeated rows are scored one by one. An id with several labels is toxic if
one of them says so. Without labels of both kinds the score is the share of toxic labels, 0 if there is none. `labels` and
`documents` may have other columns; only doc_id, text and toxic are read.
"""

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import held_out, stored, whole_text

FOLDS, HELD_OUT = 4, 2
LEXICON_FOLD, TREE_FOLD, CALIBRATION_FOLD = 0, 1, 3
# The most labelled rows that each part is fitted on; beyond it, rows are chosen by a hash of the id.
FIT_ROWS = 30_000
THRESHOLD = 0.3

# Common insults in four languages; the learned lexicon adds what the labels show.
INSULTS = frozenset(
    """
    idiot idiots stupid moron morons loser losers pathetic scum worthless trash garbage disgusting clown dumb
    fool jerk creep filthy vile imbecile ugly pig
    idiota estúpido estúpida imbécil basura asqueroso asquerosa payaso inútil patético escoria
    idiote stupide imbécile crétin ordure dégoûtant pathétique minable raclure débile
    trottel dummkopf abschaum widerlich wertlos versager müll dumm erbärmlich schwachkopf
    """.split()
)
SECOND_PERSON = frozenset(
    """
    you your yours you're u ur yourself tu te ti tus tuyo usted ustedes vous votre vos toi ton ta tes
    du dich dir dein deine deiner ihr euch euer
    """.split()
)
EDGES = string.punctuation + "«»„“”‚‘’…¿¡"
PLAIN = str.maketrans("013457@$!|", "oieastasil")
INSULT, STRONG, WEAK, PERSON, HIDDEN, SHOUTED = 1, 2, 4, 8, 16, 32
FEATURES = [
    "insults",
    "strong_terms",
    "weak_terms",
    "any_insult",
    "any_strong",
    "near_person",
    "hidden",
    "shouted",
    "marks",
    "log_words",
]
FEATURE_SCHEMA = ", ".join(["doc_id long", "toxic double", *[f"{name} double" for name in FEATURES]])
PREFIXES = (3, 4, 5, 6)
CONTEXTS = 62  # bits that tell contexts apart


def core(word: str) -> str:
    return word.strip(EDGES).lower()


def terms(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends in `*`, which no core does."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


class Flags:
    """What there is to say about a single word, remembered."""

    LIMIT = 400_000

    def __init__(self, strong: frozenset[str], weak: frozenset[str]):
        self.strong, self.weak = strong, weak
        self.known: dict[str, int] = {}

    def of(self, word: str) -> int:
        plain = core(word)
        flags = 0
        bare = word.strip(EDGES)
        if len(bare) > 2 and not bare.isalpha() and bare[0].isalpha() and bare[-1].isalpha() and bare.translate(PLAIN).isalpha() or "*" in bare:
            flags |= HIDDEN
            plain = plain.translate(PLAIN)
        if len(bare) > 1 and bare.isupper():
            flags |= SHOUTED
        if plain in INSULTS:
            flags |= INSULT
        if plain in SECOND_PERSON:
            flags |= PERSON
        if plain:
            own = terms(plain)
            if not self.strong.isdisjoint(own):
                flags |= STRONG
            elif not self.weak.isdisjoint(own):
                flags |= WEAK
        return flags

    def text(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(known) > self.LIMIT:
                known.clear()
            for word in set(words).difference(known):
                known[word] = self.of(word)
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def features_of(text: str, flags: Flags) -> list[float]:
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    found, n = flags.text(words), len(words)
    insult, strong = (found & INSULT) > 0, (found & STRONG) > 0
    hits, persons = np.flatnonzero(insult | strong), np.flatnonzero(found & PERSON)
    near = 0
    if len(hits) and len(persons):
        after = np.searchsorted(persons, hits)
        gaps = np.minimum(
            np.abs(persons[np.minimum(after, len(persons) - 1)] - hits), np.abs(persons[np.maximum(after - 1, 0)] - hits)
        )
        near = int((gaps <= 3).sum())
    per = 100.0 / n
    return [
        per * int(insult.sum()),
        per * int(strong.sum()),
        per * int(((found & WEAK) > 0).sum()),
        float(min(3, insult.sum())),
        float(min(3, strong.sum())),
        per * near,
        per * int(((found & HIDDEN) > 0).sum()),
        per * int(((found & SHOUTED) > 0).sum()),
        per * (text.count("!") + text.count("?")),
        float(np.log1p(n)),
    ]


def features(rows: DataFrame, lexicon: tuple[frozenset[str], frozenset[str]]) -> DataFrame:
    """The dense features of (doc_id, text, toxic); the label passes through and is not used."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(*shared.value)
        for batch in batches:
            table = np.array([features_of(x, flags) for x in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            columns = [pa.array(table[:, i], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *columns], names=["doc_id", "toxic", *FEATURES]
            )

    return rows.select("doc_id", "text", "toxic").mapInArrow(compute, FEATURE_SCHEMA)


TERM_SCHEMA = "term string, toxic_docs long, clean_docs long, contexts long"
TERMS_HELD = 1_000_000


def term_counts(rows: DataFrame) -> DataFrame:
    """In how many toxic and clean texts each term stands, and after which words in toxic ones.

    `contexts` has a bit per hash of the word before, so that a term which only copies of one text share does
    not look like one that many texts share. Counted in each task first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            names = pa.array(list(counts), pa.string())
            columns = [pa.array([x[i] for x in counts.values()], pa.int64()) for i in range(3)]
            counts.clear()
            return pa.RecordBatch.from_arrays([names, columns[1], columns[0], columns[2]], names=["term", "toxic_docs", "clean_docs", "contexts"])

        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = [core(w) for w in text.split()]
                found = dict.fromkeys((t for w in set(words) if w for t in terms(w)), 0)
                if toxic:
                    for before, word in zip(["", *words], words):
                        bit = 1 << zlib.crc32(before.encode("utf-8", "surrogatepass")) % CONTEXTS
                        for term in terms(word) if word else ():
                            found[term] |= bit
                for term, bits in found.items():
                    entry = counts.setdefault(term, [0, 0, 0])
                    entry[int(toxic > 0)] += 1
                    entry[2] |= bits
                if len(counts) > TERMS_HELD:
                    yield flush()
        yield flush()

    counted = rows.select("doc_id", "text", "toxic").mapInArrow(count, TERM_SCHEMA).groupBy("term")
    return counted.agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("clean_docs").alias("clean_docs"), F.bit_or("contexts").alias("contexts"))


def learn_lexicon(rows: DataFrame, most: int = 2000) -> tuple[frozenset[str], frozenset[str]]:
    """Strong and weak terms: those far likelier in toxic texts, by smoothed log odds and their certainty.

    At most `most` terms come to the driver.
    """
    n = rows.agg(F.count(F.when(F.col("toxic") > 0, 1)).alias("toxic"), F.count(F.when(F.col("toxic") == 0, 1)).alias("clean")).first()
    if not n["toxic"] or not n["clean"]:
        return frozenset(), frozenset()
    # So many contexts a bitmap with that many bits set has had, as far as it can tell.
    bits = F.bit_count("contexts")
    contexts = F.when(bits < CONTEXTS, -CONTEXTS * F.log(1 - bits / CONTEXTS)).otherwise(F.col("toxic_docs"))
    t, c = F.least(F.col("toxic_docs").cast("double"), contexts), F.col("clean_docs")
    odds = F.log((t + 0.5) / (n["toxic"] - t + 0.5)) - F.log((c + 0.5) / (n["clean"] - c + 0.5))
    sure = F.col("odds") / F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    scored = term_counts(rows).where(t >= 3).withColumn("odds", odds).withColumn("sure", sure)
    # Weak: three times as likely; strong: thirty times.
    best = scored.where(f"odds > {np.log(3)} and sure > 3.2").orderBy(F.desc("sure"), "term").limit(most).collect()
    return (
        frozenset(r["term"] for r in best if r["odds"] > np.log(30)),
        frozenset(r["term"] for r in best if r["odds"] <= np.log(30)),
    )


class Model:
    """Lexicon, trees and calibration; `score` applies them to any documents."""

    def __init__(self, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
        fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
        known = labels.where("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
        known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold).where(F.col("fold") != HELD_OUT)
        sizes = {r["fold"]: r["count"] for r in known.groupBy("fold").count().collect()}
        share = F.element_at(F.create_map(*[F.lit(x) for k in (0, 1, 3) for x in (k, min(1.0, fit_rows / max(1, sizes.get(k, 0))))]), F.col("fold").cast("int"))
        chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
        # At most about three times `fit_rows` short rows, each id once, so no text is shuffled to meet its label.
        rows = stored(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
        self.rate = rows.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("rate")).first()["rate"]
        self.lexicon = learn_lexicon(rows.where(F.col("fold") == LEXICON_FOLD))
        self.assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        parts = {
            k: self.assembler.transform(stored(features(rows.where(F.col("fold") == k), self.lexicon), "features"))
            for k in (TREE_FOLD, CALIBRATION_FOLD)
        }
        self.trees = self.calibration = None
        if all(part.select("toxic").distinct().count() == 2 for part in parts.values()):
            trees = GBTClassifier(labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=11, checkpointInterval=-1)
            self.trees = trees.fit(parts[TREE_FOLD].select("toxic", "features"))
            isotonic = IsotonicRegression(labelCol="toxic", featuresCol="raw")
            self.calibration = isotonic.fit(self.raw(parts[CALIBRATION_FOLD]).select("toxic", "raw"))

    def raw(self, assembled: DataFrame) -> DataFrame:
        """What the trees say, 0 to 1, as `raw`."""
        return self.trees.transform(assembled).withColumn("raw", vector_to_array("probability")[1])

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, score, predicted, raw. Calibrated scores have ties; the trees break them."""
        read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"), F.lit(None).cast("double").alias("toxic"))
        dense = features(read, self.lexicon)
        if self.trees is None:
            scored = dense.withColumns({"raw": F.lit(float(self.rate)), "prediction": F.lit(float(self.rate))})
        else:
            scored = self.calibration.transform(self.raw(self.assembler.transform(dense)).drop("prediction"))
        score = F.col("prediction") * 0.999 + F.col("raw") * 0.001
        out = scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), score.alias("score"), "raw")
        return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
