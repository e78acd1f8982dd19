"""Packing tokenised documents into sequences of a fixed length, best fit first, largest piece first.

A document longer than a sequence is cut into full windows; what is left of it, and every shorter document,
is a piece. Pieces are placed from the longest to the shortest, each into the open window with the least room
that still holds it. A segment tree over the remaining room finds that window in a few steps.

Pieces are dealt evenly to groups of a bounded size, whatever their ids, and each group is packed in its own
task. Groups are large enough (thousands of windows) that their last, half-empty windows do not count.

Defined cases: a NULL or empty text is a document of the end token alone. A NULL doc_id is carried. Repeated
rows are packed one by one. An empty table gives no rows. Other columns of the input are not read.
"""

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored

SEQUENCE = 2048
END_ID = 1
WINDOWS = 4096  # of tokens that one group has
PIECES = 200_000  # that one group has at most, on average
REMEMBERED = 200_000  # words whose ids a worker keeps
WORD_START = re.compile(r" (?=\S)")
ODD_SPACE = re.compile(r" (?:\s|$)")
# Fixed value: how byte-level vocabularies of this kind split a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED_SCHEMA = "doc_id long, start long, doc_tokens long, ids binary, sequence_id long, offset long"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 stands for itself, the other bytes in order for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Tokens(dict):
    """The ids of whole texts as little-endian unsigned 32-bit numbers.

    The byte-level pattern never joins a space that precedes a word to what is before it, so a text can be cut
    there and the ids of its parts strung together. Parts recur, so the dictionary remembers them, without
    their space. New parts are merged by tiktoken under the vocabulary of the given file, whose ids are the
    ranks of its merges; texts with a special string go through the file's own library, as it handles those.
    """

    def __init__(self, model: bytes):
        import tiktoken

        spec = json.loads(model)
        self.model, self.library = model, None
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte = byte_of_character()
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.merge = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = array("I", self.merge(" " + word)).tobytes()
        return found

    def slowly(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_buffer(self.model)
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.slowly(text)
        words = iter(WORD_START.split(text) if ODD_SPACE.search(text) else text.split(" "))
        first = array("I", self.merge(next(words))).tobytes()
        return first + b"".join(map(self.__getitem__, words))


TOKENS: dict[int, Tokens] = {}  # one for each model, kept while a worker lives


def planes(ids: bytes) -> bytes:
    """The first bytes of all ids, then the second ones and so on; the high ones, mostly zeros, compress well."""
    return np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes()


def ids_of_planes(data: bytes) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.tobytes()


def pieces(docs: DataFrame, model_path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """The full windows and the rest of each document: doc_id, start, length, ids_crc32, doc_tokens, ids (as planes)."""
    with open(model_path, "rb") as file:
        model = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key, end = hash(model), np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TOKENS.get(key)
        if tokens is None:
            tokens = TOKENS.setdefault(key, Tokens(shared.value))
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = (tokens.ids(text) if text else b"") + end
                n = len(data) // 4
                for at in range(0, n, sequence):
                    part = data[at * 4 : (at + sequence) * 4]
                    rows.append(row)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    ids.append(planes(part))
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *numbers, pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(cut, PIECE_SCHEMA)


class OpenWindows:
    """Open windows by the room they have left; a segment tree says which amounts of room exist."""

    def __init__(self, sequence: int):
        self.leaves = 1 << sequence.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(sequence + 1)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes a window with the least room of at least `need`; its room and number, or None."""
        node = self.leaves + need
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.any[node]
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return room, window


def best_fit(lengths: list[int], sequence: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; the lengths come in descending order."""
    tree, windows, offsets, used = OpenWindows(sequence), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            room, window = sequence, used
            used += 1
        else:
            room, window = found
        windows.append(window)
        offsets.append(sequence - room)
        if room > length:
            tree.put(room - length, window)
    return windows, offsets


def pack(cut: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces with their ids, sequence_id and offset, written below `spark.checkpoint.dir`.

    `cut` is written first: its tokens are needed twice. length and ids_crc32 are those of the ids as placed.
    """
    held = stored(cut, "pieces", compression="zstd")
    size = held.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("rows")).first()
    groups = max(1, -(-size["tokens"] // (sequence * WINDOWS)), -(-size["rows"] // PIECES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=SHAPE)
        # In an order of its own, so that a repeated task gives the same sequences.
        table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        windows, offsets = best_fit(table.column("length").to_pylist(), sequence)
        first = TaskContext.get().partitionId() << 32
        ids = pa.array(map(ids_of_planes, table.column("ids").to_pylist()), pa.binary())
        table = table.drop_columns(["length", "ids_crc32", "ids"]).add_column(3, "ids", ids)
        table = table.append_column("sequence_id", pa.array([first + w for w in windows], pa.int64()))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        # A sequence's pieces lie next to each other, in order.
        yield from table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_batches(2_000)

    # Dealt in turn and not by a key: even groups whatever the ids are.
    packed = stored(held.repartition(groups).mapInArrow(place, PLACED_SCHEMA), "packed", compression="zstd")
    length, crc = F.octet_length("ids").cast("long") / 4, F.crc32("ids")
    return packed.select(
        "doc_id", "start", length.cast("long").alias("length"), crc.alias("ids_crc32"), "doc_tokens", "ids", "sequence_id", "offset"
    )


SHAPE = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.binary())]
)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids as one binary, the pieces end to end; at most one sequence per row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, part: F.concat(acc, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
