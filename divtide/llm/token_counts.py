"""Token counts of whole texts under a sentencepiece BPE vocabulary, with a shortcut for whole tokens.

No piece of the vocabulary holds a space mark after another character (checked when the model is loaded), so
no merge crosses the start of a run of spaces. A text therefore falls into pre-tokens, each a run of spaces
and the characters up to the next one, whose counts add up. Before any text is read, `proven` encodes every
vocabulary string alone; those that come out as one token count 1 wherever they are a pre-token. Only other
pre-tokens go through the library's merges, once each while a worker remembers them.

Defined cases: a NULL or empty text has no bytes and no tokens. A NULL doc_id is carried. Repeated rows are
counted one by one. Other columns of the input are not read. Long texts need memory for their own words only.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"  # how sentencepiece writes a space
REMEMBERED = 400_000  # pre-tokens that a worker keeps besides the vocabulary
PRE_TOKEN = re.compile(r" *[^ ]+| +$")
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def proven(model: bytes) -> frozenset[str]:
    """Words that, after a space, encode alone as the one token that the vocabulary has for them."""
    library = load(model)
    pieces = [library.id_to_piece(i) for i in range(library.vocab_size()) if not library.is_control(i)]
    for piece in pieces:
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"{piece!r} joins two words, so pre-tokens do not add up under this vocabulary")
    candidates = [p[1:] for p in pieces if p.startswith(MARK) and len(p) > 1 and p[1] != MARK]
    encoded = library.encode(candidates, num_threads=1)
    return frozenset(word for word, ids in zip(candidates, encoded) if len(ids) == 1)


class Counter:
    """Counts the tokens of texts; remembers pre-tokens, written without their first space."""

    def __init__(self, model: bytes, whole: frozenset[str]):
        self.library = load(model)
        self.whole = whole
        self.forget()

    def forget(self) -> None:
        self.known = dict.fromkeys(self.whole, 1)
        self.known[""] = 1  # a space at the end of a text is a token of its own

    def learn(self, pre_tokens: list[str]) -> None:
        if len(self.known) > len(self.whole) + REMEMBERED:
            self.forget()
        new = list(set(pre_tokens).difference(self.known))
        self.known.update(zip(new, map(len, self.library.encode(new, num_threads=1))))

    def count(self, text: str) -> int:
        if not text:
            return 0
        # A space and its mark are the same to the library.
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            pre_tokens = [x[1:] for x in PRE_TOKEN.findall(" " + text)]
        else:
            pre_tokens = text.split(" ")
        try:
            return sum(map(self.known.__getitem__, pre_tokens))
        except KeyError:
            self.learn(pre_tokens)
            return sum(map(self.known.__getitem__, pre_tokens))


COUNTERS: dict[int, Counter] = {}  # one for each model, kept while a worker lives


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit, without begin, end or added tokens.

    The model goes to the workers as a broadcast of its bytes, the proven words with it; both are bounded by
    the size of the vocabulary.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((model, proven(model)))
    key = hash(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = COUNTERS.get(key)
        if counter is None:
            counter = COUNTERS.setdefault(key, Counter(*shared.value))
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            n_tokens = [counter.count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(count, SCHEMA)
