"""Words and shingles of many texts at once, as numpy arrays.

The functions work on slices of an Arrow batch: the bytes of some whole texts
and the offsets where each begins. Memory stays bounded by the slice, however
many rows a batch has; a text longer than a slice is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
SLICE_TEXTS = 1 << 12  # a text's number fits 12 bits, see `distinct_per_text`

U = np.uint64
MULTIPLIER = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

# White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half the output bits."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUE = mix(np.arange(256, dtype=U), 1)
BYTE_VALUE_LOWER = BYTE_VALUE[LOWER]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64; kept between calls, at least `n` long."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES) + 1
        have = np.full(size, base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so no other column can clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def unused(columns: list[str], *names: str) -> list[str]:
    """The names with as many underscores before them as make them new among `columns`."""
    taken = {c.lower() for c in columns}
    return [next(n for k in range(1, len(taken) + 2) if (n := "_" * k + name) not in taken) for name in names]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its texts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `size` bytes and at most SLICE_TEXTS texts."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + SLICE_TEXTS, n)
        yield first, last
        first = last


def each_slice(batches, size: int = SLICE_BYTES):
    """(batch, first, last, bytes, offsets from 0) of every slice of every batch."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in slices(offsets, size):
            part = offsets[first : last + 1]
            yield batch, first, last, data[part[0] : part[-1]], part - part[0]


def tidy(run: Callable) -> Callable:
    """The function of batches; when it ends, what it has freed goes back to the system.

    A worker outlives its task, and several wait beside those that work: without
    this each keeps the memory of its largest batch.
    """
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every system has it
            if trim:
                trim(0)
    return whole


def with_end(batches):
    """The batches, then None."""
    yield from batches
    yield None


class Words:
    """The words of a slice: text number, start, stop (bytes) and 64-bit hash.

    A word is a run of bytes other than blanks and ASCII controls 9 to 13;
    A-Z count as a-z. Words never cross texts.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~IS_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        stops = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        total = np.zeros(n + 1, U)
        np.cumsum(BYTE_VALUE_LOWER[data] * powers(MULTIPLIER, n)[:n], out=total[1:])
        value = (total[stops] - total[starts]) * powers(INVERSE, n)[starts]
        self.starts, self.stops = starts, stops
        self.hash = mix(value + (stops - starts).astype(U) * U(0x9E3779B97F4A7C15))
        self.text = np.searchsorted(offsets, starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.cumsum(self.counts) - self.counts  # each text's first word

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, first word) of all runs of `width` words, in text order.

        A text with fewer words, but at least one, gives its whole sequence as
        one shingle. Equal runs have equal hashes, whatever text they are in.
        """
        n, keys = len(self.hash), powers(0xA0761D6478BD642F, width + 1)
        whole = np.zeros(0, np.int64)
        value = np.zeros(0, U)
        if n >= width:
            whole = np.flatnonzero(self.text[: n - width + 1] == self.text[width - 1 :])
            value = np.zeros(n - width + 1, U)
            for k in range(width):
                value += self.hash[k : n - width + 1 + k] * keys[k + 1]
            value = mix(value[whole], 2)
        short = np.flatnonzero((self.counts > 0) & (self.counts < width))
        if len(short):
            part = np.zeros(len(short), U)
            for k in range(width - 1):
                has = self.counts[short] > k
                part[has] += self.hash[self.first[short[has]] + k] * keys[k + 1]
            part = mix(part + self.counts[short].astype(U), 3)
            place = np.concatenate([whole, self.first[short]])
            order = np.argsort(place, kind="stable")
            whole, value = place[order], np.concatenate([value, part])[order]
        return value, self.text[whole], whole


def distinct_per_text(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (value, text), sorted by text and value; values keep 52 bits."""
    packed = np.sort((text.astype(U) << U(52)) | (values >> U(12)))
    if len(packed):
        packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    return packed & U((1 << 52) - 1), (packed >> U(52)).astype(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of lists out of one flat array and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of a slice of UTF-8 texts, the texts' offsets in them, and that of every byte."""
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return points, leads[offsets], leads


def text_numbers(offsets: np.ndarray) -> np.ndarray:
    """For each element, the number of the text it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
