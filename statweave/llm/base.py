"""What several corpus operators share: text columns, word numbering and block numbers."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(column, UPPER, LOWER)


def text_bytes(column: Column) -> Column:
    """UTF-8 bytes; null stays null."""
    return column.cast("string").cast("binary")


def block_count(df: DataFrame, column: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Number of blocks so that one holds about ``block_bytes`` of the binary ``column``."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def chunks(values: list, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``values`` (bytes or None) of about ``max_bytes`` each, at least one value long."""
    start, size = 0, 0
    for i, value in enumerate(values):
        size += len(value) if value else 0
        if size >= max_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


class WordTable(dict):
    """Numbers words 0, 1, 2 … in the order of their first use and lists the new ones.

    ``limit`` bounds its memory: ``trim`` starts afresh when more words are held. It
    bounds a memo only; every word is numbered.
    """

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit, self.fresh = limit, []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def take_fresh(self) -> list[bytes]:
        fresh, self.fresh = self.fresh, []
        return fresh

    def trim(self) -> bool:
        if len(self) <= self.limit:
            return False
        self.clear()
        self.fresh = []
        return True

    def number(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after the other, and the number of words of each text."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        return numbers, sizes

    def number_array(self, words: pa.Array) -> np.ndarray:
        """Word numbers of an array of words; each distinct word of it is looked up once."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)  # much faster than to_pylist
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        return numbers.take(coded.indices.to_numpy())


def per_text(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of ``numbers`` over consecutive runs of the given sizes (0 for an empty run)."""
    ends = np.cumsum(sizes)
    total = np.concatenate([np.zeros(1, numbers.dtype), np.cumsum(numbers)])
    return total[ends] - total[ends - sizes]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash of unsigned numbers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def by_arrow(df: DataFrame, function: Callable, schema: str, *passed: str) -> DataFrame:
    """``mapInArrow`` over the named columns only."""
    return df.select(*passed).mapInArrow(function, schema)


def shared(df: DataFrame, value: object) -> Callable[[], object]:
    """Broadcast any object; the result reads it inside a task.

    The object travels as bytes that carry the code of its classes, so workers need not
    have this package installed.
    """
    data = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


class Renamed:
    """A DataFrame under names that no working column has; ``back`` restores the caller's."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.safe = [f"column_{i}_" for i in range(len(self.names))]
        self.df = df.toDF(*self.safe)

    def name(self, column: str) -> str:
        return self.safe[self.names.index(column)]

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*self.safe).toDF(*self.names)
