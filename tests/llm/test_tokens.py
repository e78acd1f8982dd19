"""Token counts and packing against the libraries themselves."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from divtide.llm import packing, token_counts
from divtide.llm.registry import tokenizer
from tests.llm.conftest import EDGES, prose

PIECES, BYTES = tokenizer("piece_bpe_32k.model"), tokenizer("byte_bpe_50k.json")
ODD = [
    "  two  spaces at both ends  ",
    " ",
    "▁marks▁ and ▁▁ more",
    "<s> </s> <unk> <0x0A> <|endoftext|>",
    "tabs\tand\nlines \n \n  then\r\n text",
    "emoji 🙂🙂 汉字  nbsp  em \x1c sep 123456 don't I'll",
    "a" * 5000 + " " * 50 + "b",
]
TEXTS = st.text(alphabet=st.sampled_from(list(" \n\t▁ab'sé.1🙂<|> \x1c")), max_size=60)


def read(path):
    with open(path, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def counter():
    model = read(PIECES)
    return token_counts.Counter(model, token_counts.proven(model))


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(read(BYTES))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_counts_any_text(counter, text):
    assert counter.count(text) == len(counter.library.encode(text))


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_of_any_text(tokens, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert list(np.frombuffer(tokens.ids(text), "<u4")) == expected


def test_count_query_cases(frame, counter):
    rows = [*EDGES, *enumerate(ODD, 100)]
    out = token_counts.token_counts(frame(rows), PIECES, limit=100).collect()
    expected = sorted((i is None, i or 0, len((t or "").encode()), len(counter.library.encode(t or ""))) for i, t in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in out) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in out)
    assert token_counts.token_counts(frame([]), PIECES).count() == 0


def test_pack_round_trip(frame, library):
    rows = [(i, t) for i, (_, t) in enumerate([*EDGES, *enumerate(ODD), *[(0, prose(s, s * 13 % 900)) for s in range(60)]])]
    packed = packing.pack(packing.pieces(frame(rows), BYTES)).cache()
    documents, sequences = defaultdict(dict), defaultdict(dict)
    for r in packed.collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        documents[r["doc_id"]][r["start"]] = ids
        sequences[r["sequence_id"]][r["offset"]] = ids
    for i, text in rows:
        whole = np.concatenate([documents[i][s] for s in sorted(documents[i])])
        assert list(whole) == [*library.encode(text or "", add_special_tokens=False).ids, 1]
    for parts in sequences.values():
        end = 0
        for offset in sorted(parts):
            assert offset == end
            end += len(parts[offset])
        assert end <= packing.SEQUENCE
    joined = {r["sequence_id"]: len(r["ids"]) // 4 for r in packing.sequences(packed).collect()}
    assert joined == {s: sum(map(len, p.values())) for s, p in sequences.items()}
    packed.unpersist()


def test_pack_nothing(frame):
    assert packing.pack(packing.pieces(frame([]), BYTES)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_is_best_fit(lengths):
    """Each piece goes where a search of all open windows would put it."""
    lengths = sorted(lengths, reverse=True)
    windows, offsets = packing.best_fit(lengths, 16)
    rooms: dict[int, int] = {}
    for length, window, offset in zip(lengths, windows, offsets):
        fitting = [room for room in rooms.values() if room >= length]
        if fitting:
            assert rooms[window] == min(fitting)
        else:
            assert window not in rooms
            rooms[window] = 16
        assert offset == 16 - rooms[window]
        rooms[window] -= length
