"""Fingerprints of word shingles for many texts at once.

A word is a run of characters other than white space (codes 9 to 13 and 32). A shingle is five words in a
row; a text with one to four words has one shingle, all its words; a text without words has none. Words and
shingles are known by 64-bit fingerprints: two different shingles of one corpus share one with a probability
of about 1 in 10^19 for each pair.
"""

from collections.abc import Iterator

import numpy as np

SIZE = 5
CHUNK = 1 << 20  # bytes of text that are fingerprinted together

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each number over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and INVERSE ** i for i below n; kept for texts of usual length."""
    if len(POWERS[0]) >= n:
        return POWERS[0][:n], POWERS[1][:n]
    made = []
    for base in (BASE, INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if n <= 4 * CHUNK:
        POWERS[:] = made
    return made[0], made[1]


def word_prints(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and start of each word of UTF-8 text."""
    codes = np.frombuffer(data, np.uint8)
    blank = np.ones(len(codes) + 2, bool)
    blank[1:-1] = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = powers(len(codes))
    # The polynomial of a word is a difference of two running sums, shifted back to the word's start.
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64)), starts


def chunks(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about CHUNK bytes, with the place of the first; a longer text stands alone."""
    first, held, size = 0, [], 0
    for place, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        if held and size + len(data) > CHUNK:
            yield first, held
            first, held, size = place, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def shingle_runs(texts: list[str], size: int = SIZE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: place of the first, all shingles in order, and where each text's shingles start.

    The starts have one entry more than the run has texts. Shingles may repeat within a text.
    """
    for first, held in chunks(texts):
        prints, at = word_prints(b" ".join(held))
        begins = np.cumsum([0, *[len(x) + 1 for x in held]])
        bounds = np.searchsorted(at, begins)
        n_words = np.diff(bounds)
        n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
        starts = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(starts[-1], np.uint64)
        if len(prints) >= size:
            rolled = np.zeros(len(prints) - size + 1, np.uint64)
            for k in range(size):
                rolled = rolled * BASE + prints[k : len(prints) - size + 1 + k]
            rolled = mix(rolled)
        for i in np.flatnonzero(n):
            if n_words[i] >= size:
                out[starts[i] : starts[i + 1]] = rolled[bounds[i] : bounds[i] + n[i]]
            else:
                value = np.zeros(1, np.uint64)
                for word in prints[bounds[i] : bounds[i + 1]]:
                    value = value * BASE + word
                out[starts[i]] = mix(value + np.uint64(n_words[i]))[0]
        yield first, out, starts


def shingle_sets(texts: list[str], size: int = SIZE) -> Iterator[tuple[int, np.ndarray]]:
    """Place and sorted distinct shingles of each text."""
    for first, out, starts in shingle_runs(texts, size):
        for i in range(len(starts) - 1):
            yield first + i, np.unique(out[starts[i] : starts[i + 1]])
