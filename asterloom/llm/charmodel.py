"""Interpolated modified Kneser-Ney model over character classes.

A character's class is one of 64 symbols, so that every n-gram up to order 4 has
a 24-bit key: 18 bits of context and 6 of the class. These models are therefore
bounded by 64**4 entries however much text they are trained on. Which character
of its class it is, `spelling` predicts from the real characters before it, so
that no character stands for another: the product of both is its probability.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from . import spelling
from .textops import Words, code_points, each_slice, text_numbers, tidy

ORDER, BITS = 4, 6
KEYS = 1 << (ORDER * BITS)
PAD, SYMBOLS = 62, 63  # the pad opens every text and is never predicted
REPEAT = 63  # stands before a word said again at once, or as the end of a pair said again
NGRAM = ["key", "context", "character", "n"]
OWN = ".,;:!?'\"-()|#$%&*"  # punctuation with a symbol of its own


@lru_cache(maxsize=17)
def symbol_table(plane: int = 0) -> np.ndarray:
    """The class symbol of each code point of a plane, of the first 65536 unless another is named.

    0-25 a to z, 26 capitals, 27 digits, 28 white space, 29-40 other small
    letters (12 classes), 41 letters without case, 42-58 the punctuation above,
    59 other ASCII punctuation, 60 other signs, 61 controls; 62 and 63 are PAD
    and REPEAT.
    """
    table = np.full(1 << 16, 60, np.uint8)
    for low in range(1 << 16):
        code = plane << 16 | low
        c = chr(code)
        if c.isspace():
            table[low] = 28
        elif "a" <= c <= "z":
            table[low] = code - 97
        elif c.isupper() or c.istitle():
            table[low] = 26
        elif c.isdigit():
            table[low] = 27
        elif c.islower():
            table[low] = 29 + code % 12
        elif c.isalpha():
            table[low] = 41
        elif c in OWN:
            table[low] = 42 + OWN.index(c)
        elif code < 32 or 127 <= code < 160:
            table[low] = 61
        elif code < 128:
            table[low] = 59
    return table


def class_symbols(points: np.ndarray) -> np.ndarray:
    """The class symbol of each character."""
    symbols = symbol_table()[np.minimum(points, 0xFFFF)]
    planes = points >> 16
    for plane in np.unique(planes[planes > 0]):
        part = planes == plane
        symbols[part] = symbol_table(int(plane))[points[part] & 0xFFFF]
    return symbols


@lru_cache(maxsize=1)
def class_sizes() -> np.ndarray:
    """How many code points each class has."""
    return sum(np.bincount(symbol_table(plane), minlength=1 << BITS) for plane in range(17))


ALONE = (*range(26), *range(42, 42 + len(OWN)))  # classes of one character


def read_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The characters: code points, class symbols, the texts' offsets; the key of every symbol with its three predecessors, the texts' offsets.

    Every character has its symbol. A word that repeats the one before it, or
    ends a repeated pair of words, has REPEAT before its own symbols: the loops
    of stuck generators become as unlikely as they are.
    """
    words = Words(data, offsets)
    again, n = np.zeros(len(words.hash), bool), len(words.hash)
    same = lambda lag: (words.hash[lag:] == words.hash[: max(n - lag, 0)]) & (words.text[lag:] == words.text[: max(n - lag, 0)])
    again[1:] |= same(1)
    again[3:] |= same(2)[1:] & same(2)[:-1]
    points, point_offsets, leads = code_points(data, offsets)
    first = leads[words.starts[again]]
    classes = class_symbols(points)
    symbols = np.insert(classes.astype(np.uint32), first, REPEAT)
    offsets = point_offsets + np.searchsorted(first, point_offsets)
    shift = (ORDER - 1) * (text_numbers(offsets) + 1)
    spread = np.full(len(symbols) + (ORDER - 1) * len(offsets), PAD, np.uint32)
    at = np.arange(len(symbols)) + shift
    spread[at] = symbols
    keys = symbols
    for k in range(1, ORDER):
        keys = keys | (spread[at - k] << (BITS * k))
    return points, classes, point_offsets, keys, offsets


def symbol_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of `read_symbols` and the texts' offsets in them."""
    return read_symbols(data, offsets)[3:]


def characters(points: np.ndarray, classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, context, character) of the characters that share their class with others."""
    shared = np.ones(1 << BITS, bool)
    shared[list(ALONE)] = False
    return spelling.spelled(points, offsets, classes, shared)


def count_batches(batches):
    """(key, n) of the n-grams of all texts of a task, summed within the task; (context, character, n) of their characters."""
    def sent(found):
        for context, character, n in found:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(n), pa.int32()), pa.array(context), pa.array(character.astype(np.int32)), pa.array(n)], NGRAM)

    total, spelled = None, spelling.Counts()
    for _, _, _, data, offsets in each_slice(batches):
        points, classes, point_offsets, keys, _ = read_symbols(data, offsets)
        if total is None:
            total = np.zeros(KEYS, np.int64)
        np.add.at(total, keys, 1)  # in place: only the pages of keys seen take memory
        yield from sent(spelled.add(*characters(points, classes, point_offsets)[1:]))
    yield from sent(spelled.rest())
    if total is not None:
        seen = np.flatnonzero(total)
        none = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), none, none.cast(pa.int32()), pa.array(total[seen])], NGRAM)


def count_ngrams(texts: DataFrame) -> DataFrame:
    """Counts over all texts (column text): key and n of classes, context, character and n of characters, the others null."""
    found = texts.select("text").mapInArrow(tidy(count_batches), "key int, context long, character int, n long")
    return found.groupBy("key", "context", "character").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    n1, n2, n3, n4 = counts.agg(*(F.count_if(F.col("n") == k) for k in (1, 2, 3, 4))).first()
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = lambda a, b: a / b if b else 0.0
    d = (1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3))
    return tuple(min(max(x, 0.1), float(k + 1)) for k, x in enumerate(d))


def train(counts: DataFrame) -> DataFrame:
    """(level, key, p) of every n-gram seen, (-level, context, weight) of every context.

    `counts` has the n-grams of the highest order; those of characters aside
    (see `train_spelling`), they are of classes. Lower orders count in how
    many contexts a suffix was seen. Each level joins its counts with its
    contexts' sums and with the next lower level's probabilities, all of them
    dealt out by key.
    """
    levels = {ORDER: counts.filter("key is not null").select("key", "n")}
    for level in range(ORDER - 1, 0, -1):
        suffix = F.col("key").bitwiseAND((1 << (BITS * level)) - 1)
        levels[level] = levels[level + 1].groupBy(suffix.alias("key")).agg(F.count("*").alias("n"))
    out = lower = None
    for level in range(1, ORDER + 1):
        c = levels[level]
        d1, d2, d3 = _discounts(c)
        c = c.withColumn("context", F.shiftright("key", BITS))
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        contexts = c.groupBy("context").agg(F.sum("n").alias("total"), F.sum(F.least(discount, n)).alias("taken"))
        p = c.join(contexts, "context")
        p = p.withColumn("suffix", F.col("key").bitwiseAND((1 << (BITS * (level - 1))) - 1))
        own, weight = (n - F.least(discount, n)) / F.col("total"), F.col("taken") / F.col("total")
        if lower is None:
            p = p.select("key", (own + weight / SYMBOLS).alias("p"))
        else:
            below = lower.select(F.col("key").alias("suffix"), F.col("p").alias("q"))
            p = p.join(below, "suffix").select("key", (own + weight * F.col("q")).alias("p"))
        lower = materialise(p, f"order{level}")
        rows = lower.select(F.lit(level).alias("level"), "key", "p").union(
            contexts.select(F.lit(-level).alias("level"), F.col("context").alias("key"), (F.col("taken") / F.col("total")).alias("p")))
        out = rows if out is None else out.union(rows)
    return out


def train_spelling(counts: DataFrame) -> spelling.Spelling:
    """The model of the characters within their classes."""
    seen = counts.filter("key is null").select("context", "character", "n")
    return spelling.Spelling(spelling.train(seen, class_sizes(), _discounts), class_sizes())


def log_table(level: np.ndarray, key: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log probabilities of all 64**4 keys from the rows of `train`."""
    table = np.full(1, 1 / SYMBOLS, np.float32)
    for order in range(1, ORDER + 1):
        weight = np.ones(1 << (BITS * (order - 1)), np.float32)
        part = level == -order
        weight[key[part]] = p[part]
        if order == 1:
            wider = np.full(1 << BITS, weight[0] / SYMBOLS, np.float32)
        else:
            wider = (weight.reshape(1 << BITS, -1, 1) * table.reshape(1, -1, 1 << BITS)).reshape(-1)
        part = level == order
        wider[key[part]] = p[part]
        table = wider
    return np.log(np.maximum(table, 1e-12, out=table), out=table)


class Model:
    """The rows of `train`, small enough to go to every task; tables are built there once."""

    def __init__(self, rows: DataFrame):
        got = rows.toArrow()
        self.level = got.column("level").to_numpy().astype(np.int8)
        self.key = got.column("key").to_numpy().astype(np.int32)
        self.p = got.column("p").to_numpy().astype(np.float32)
        self.name = hash((len(self.p), float(self.p.sum()), int(self.key.sum())))

    def table(self) -> np.ndarray:
        if _tables.get("name") != self.name:
            _tables.update(name=self.name, table=log_table(self.level, self.key, self.p))
        return _tables["table"]


_tables: dict = {}
