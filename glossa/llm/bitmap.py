"""A Bloom filter of bounded size: tells tasks which rows may be wanted, without a shuffle of the rest.

A full filter lets everything pass; results never depend on it, only how many rows are sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import lean
from glossa.llm.hashing import mix

FUNCTIONS = 3


def _bits(values: np.ndarray, words: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter's words and bits of some 64-bit values, for one of its functions."""
    step = np.array([i + 1], dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    place = mix(values + step)
    word = place >> np.uint64(6)
    # Same value, without a division, if the words are a power of two.
    word = word % np.uint64(words) if words & (words - 1) else word & np.uint64(words - 1)
    return word.astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def passes(values: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    left = np.arange(len(values))
    for i in range(FUNCTIONS):
        word, bit = _bits(values if not i else values[left], len(bitmap), i)
        left = left[(bitmap[word] & bit) != 0]
    ok = np.zeros(len(values), dtype=bool)
    ok[left] = True
    return ok


def bitmap_of(values: DataFrame, words: int) -> np.ndarray:
    """Filter of the only column of ``values`` (long): the driver gets ``words`` words at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(words, dtype=np.uint64)
        for batch in batches:
            for i in range(FUNCTIONS):
                np.bitwise_or.at(own, *_bits(batch.column(0).to_numpy().view(np.uint64), words, i))
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used].view(np.int64))], names=["word", "bits"])

    found = values.mapInArrow(lean(run), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out
