"""Alignment against the libraries' own tokens and all overlapping pairs."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from divtide.llm import alignment
from divtide.llm.registry import tokenizer
from tests.llm.conftest import EDGES, prose
from tests.llm.test_tokens import ODD

PIECES, BYTES = tokenizer("piece_bpe_32k.model"), tokenizer("byte_bpe_50k.json")
TEXTS = st.text(alphabet=st.sampled_from(list(" \n\tab'sé.1🙂<|>漢\x00\x1c") + ["▁"]), max_size=40)


def read(path):
    with open(path, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(read(BYTES), read(PIECES))


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(BYTES)
    made.encode_special_tokens = True
    return made


def plain(aligner, library, text):
    """n_a, n_b, n_groups, n_links, digest and links by pair, from all pairs of byte ranges."""
    none = (0, 0, 0, 0, "", Counter())
    if not text:
        return none
    whole = (" " + text).encode()
    character = {c: b for c, b in alignment.byte_of_character().items()}
    sides = []
    a = library.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.library.encode(text)
    pieces = aligner.b.library.id_to_piece(b)
    octets_a = [bytes(character[c] for c in library.id_to_token(i)) for i in a]
    octets_b = [bytes([int(p[3:5], 16)]) if aligner.b.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    if b"".join(octets_a) != whole or b"".join(octets_b) != whole:
        return none
    for ids, octets in ((a, octets_a), (b, octets_b)):
        at, side = 0, []
        for i, x in zip(ids, octets):
            side.append((at, at + len(x), i))
            at += len(x)
        sides.append(side)
    cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in sides))
        low = cut
    links = Counter()
    j0 = 0
    for s, e, i in sides[0]:
        while sides[1][j0][1] <= s:
            j0 += 1
        j = j0
        while j < len(sides[1]) and sides[1][j][0] < e:
            links[i, sides[1][j][2]] += 1
            j += 1
    return len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def same(aligner, library, text):
    *numbers, pairs, links = aligner.align(text)
    found = {(p // aligner.b.size, p % aligner.b.size): n for p, n in zip(pairs.tolist(), links.tolist())}
    assert (*numbers, found) == plain(aligner, library, text)
    again = aligner.unpack(aligner.pack(pairs, links))
    assert (again[0] == pairs).all() and (again[1] == links).all()


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_any_text(aligner, library, text):
    same(aligner, library, text)


@pytest.mark.parametrize("text", [*ODD, prose(3, 400), "naïve Ärger über façades " * 40, "x" * 3000, "1234567890" * 50, None, ""])
def test_odd_texts(aligner, library, text):
    same(aligner, library, text)


@settings(max_examples=500, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_skips_what_a_walk_would_find(some, others):
    """Links and last tokens of irregular groups, found by a search of all pairs."""
    a, b = sorted({*some, 61}), sorted({*others, 61})
    inner = list(zip(*alignment.skip_diagonals(a, b)))
    overlaps = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if (a[i - 1] if i else 0) < y and (b[j - 1] if j else 0) < x]
    assert inner == [(i, j) for i, j in overlaps if a[i] != b[j]]


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_whole_table(frame, aligner, library, head):
    """Counts of pairs over all documents, whether they are broadcast or joined."""
    rows = [*EDGES[:-2], *enumerate(ODD, 100), *[(s, prose(s % 5, 30 + s)) for s in range(25)], (8, "▁ marked"), (9, "the the the cat")]
    found = [plain(aligner, library, text) for _, text in rows]
    count = Counter(pair for f in found for pair in f[5])
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    expected = []
    for (i, _), (n_a, n_b, n_groups, n_links, digest, links) in zip(rows, found):
        n_best = sum(n for (a, b), n in links.items() if count[a, b] == best[a])
        expected.append((i, n_a, n_b, n_groups, n_links, n_best, sum(count[p] * n for p, n in links.items()), digest))
    out = alignment.align_tokenizers(frame(rows, 3), BYTES, PIECES, head)
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))


def test_counts_in_bounded_memory(frame, monkeypatch):
    """Tasks that hand their counts over in parts give the same."""
    rows = [(s, prose(s, 40)) for s in range(30)]
    whole = sorted(map(tuple, alignment.align_tokenizers(frame(rows), BYTES, PIECES).collect()))
    counts = alignment.Counts()
    monkeypatch.setattr(alignment, "HELD", 50)
    parts = sorted(map(tuple, alignment.align_tokenizers(frame(rows), BYTES, PIECES).collect()))
    assert counts.n == 0 and parts == whole


def test_no_documents(frame):
    assert alignment.align_tokenizers(frame([]), BYTES, PIECES).count() == 0
