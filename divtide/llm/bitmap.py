"""A bitmap of fixed size over 64-bit fingerprints, for workers to tell early what cannot matter.

It marks every fingerprint it was made from and a few others; whoever uses it joins exactly afterwards.
"""

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 2**BITS bits, 8 MB


def bitmap(prints: DataFrame) -> bytes:
    """The bitmap of column `print`, compressed; at most 2**(BITS - 6) rows come to the driver."""
    place = F.shiftrightunsigned("print", 64 - BITS)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = prints.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
    packed = np.zeros(1 << (BITS - 6), np.int64)
    for row in words.agg(F.bit_or(bit).alias("bits")).collect():
        packed[row["word"]] = row["bits"]
    return zlib.compress(packed.tobytes(), 1)


def opened(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint64)


def marked(words: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which fingerprints the opened bitmap marks."""
    place = prints >> np.uint64(64 - BITS)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def opened_bytes(packed: bytes) -> bytes:
    return zlib.decompress(packed)


def is_marked(octets: bytes, signed: int) -> bool:
    """The same for a single fingerprint, given as Spark has it, signed."""
    place = (signed & 0xFFFF_FFFF_FFFF_FFFF) >> (64 - BITS)
    return octets[place >> 3] >> (place & 7) & 1 == 1
