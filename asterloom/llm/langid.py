"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over
hashed character trigrams tells the languages with a one from those with a
zero: its weight for a trigram is the log odds between the mean trigram
distributions of the two sides, so a frequent language does not outweigh a rare
one. All classifiers are counted from all training rows in one aggregation. A
text is decoded to the codeword with the least loss over its bits, each bit
weighted by how well it parts the languages.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U, code_points, each_slice, mix, text_numbers

SLOTS = 1 << 16  # hashed trigrams
UNKNOWN = "und"
RESULT = "doc_id long, lang_pred string, score double, ambiguous boolean"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Small form of each letter up to code point 65535, 0 for what is no letter."""
    table = np.zeros(1 << 16, np.uint32)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


def trigram_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, text) of the trigrams of each text's letters, and the number of letters.

    Runs of other characters count as one blank; texts are framed by blanks.
    """
    points, offsets, _ = code_points(data, offsets)
    letters = letter_table()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        letters[high] = [ord(chr(x).lower()[0]) if chr(x).isalpha() else 0 for x in points[high]]
    text = text_numbers(offsets)
    counts = np.bincount(text[letters > 0], minlength=len(offsets) - 1)
    # A blank between texts, and one for each run of other characters.
    spread = np.zeros(len(letters) + len(offsets), np.uint32)
    owner = np.full(len(spread), -1, np.int64)
    at = np.arange(len(letters)) + text + 1
    spread[at], owner[at] = letters, text
    owner[offsets[1:] + np.arange(1, len(offsets))] = np.arange(len(offsets) - 1)
    keep = np.concatenate([[True], (spread[1:] > 0) | (spread[:-1] > 0)])
    spread, owner = spread[keep], owner[keep]
    if len(spread) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    key = (spread[:-2].astype(U) << U(42)) | (spread[1:-1].astype(U) << U(21)) | spread[2:].astype(U)
    middle = spread[1:-1] > 0
    return (mix(key[middle]) >> U(48)).astype(np.int64), owner[1:-1][middle], counts


def _count_batches(batches):
    """(lang, slot, n): trigrams by language, summed within the task."""
    totals: dict[str, np.ndarray] = {}
    for batch, first, last, data, offsets in each_slice(batches):
        slot, text, _ = trigram_slots(data, offsets)
        langs = np.array(batch.column("lang").slice(first, last - first).to_pylist(), dtype=object)
        for lang in set(langs):
            own = slot[(langs == lang)[text]]
            totals.setdefault(lang, np.zeros(SLOTS, np.int64))
            totals[lang] += np.bincount(own, minlength=SLOTS)
    for lang, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(total[seen])],
            ["lang", "slot", "n"])


def codewords(n: int) -> np.ndarray:
    """n x bits of +1 and -1. Up to six languages get the exhaustive code; beyond
    that each bit is a balanced pseudo-random split, ten for each doubling."""
    if n <= 6:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.int8).T if splits else np.ones((n, 1), np.int8)
    bits = 10 * int(np.ceil(np.log2(n)))
    ranks = np.argsort([mix(np.arange(n, dtype=U), 500 + b) for b in range(bits)], axis=1)
    code = np.where(np.argsort(ranks, axis=1) < n // 2, 1, -1).T
    return code.astype(np.int8)


class Decoder:
    """The bit classifiers and the weighted decoding."""

    def __init__(self, langs: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.langs = langs
        share = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
        self.code = codewords(len(langs)).astype(np.float64)
        if len(langs) == 1:
            self.weights, self.scale = np.zeros((SLOTS, 1), np.float32), np.ones(1)
            self.importance = np.ones(1)
            return
        ones, zeros = (self.code > 0).astype(float), (self.code < 0).astype(float)
        high = (ones.T @ share) / ones.sum(axis=0)[:, None]
        low = (zeros.T @ share) / zeros.sum(axis=0)[:, None]
        log_odds = np.log(high / low)
        margins = share @ log_odds.T  # what each language's mean text scores on each bit
        signed = margins * self.code
        self.scale = np.maximum(np.abs(margins).mean(axis=0), 1e-9)
        self.importance = np.maximum(signed.min(axis=0), 0.01 * self.scale)
        self.importance = self.importance / self.importance.sum()
        self.weights = np.ascontiguousarray(log_odds.T, np.float32)

    def decode(self, slot: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score 0 to 1, lead over the next) of each text."""
        bits = self.weights.shape[1]
        size = np.maximum(np.bincount(text, minlength=n_texts), 1)
        margin = np.empty((n_texts, bits))
        for b in range(bits):
            margin[:, b] = np.bincount(text, self.weights[:, b][slot], minlength=n_texts) / size
        margin = np.clip(margin / self.scale, -4, 4)
        loss = np.exp(-margin[:, None, :] * self.code[None, :, :]) @ self.importance
        best = loss.argmin(axis=1)
        belief = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        belief /= belief.sum(axis=1, keepdims=True)
        ordered = np.sort(belief, axis=1)
        lead = ordered[:, -1] - ordered[:, -2] if len(self.langs) > 1 else ordered[:, -1]
        return best, ordered[:, -1], lead


def _predict_batches(shared, least_lead: float):
    def run(batches):
        for batch, first, last, data, offsets in each_slice(batches):
            n = last - first
            slot, text, letters = trigram_slots(data, offsets)
            known = letters > 0
            decoder: Decoder | None = shared.value
            if decoder is None:
                best, score, lead, names = np.zeros(n, int), np.zeros(n), np.zeros(n), [UNKNOWN]
            else:
                (best, score, lead), names = decoder.decode(slot, text, n), decoder.langs
            lang = [names[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, n), pa.array(lang, pa.string()),
                pa.array(np.where(known, score, 0.0)), pa.array(~known | (lead < least_lead)),
            ], ["doc_id", "lang_pred", "score", "ambiguous"])
    return run


def train_languages(training: DataFrame) -> Decoder | None:
    """The decoder learned from all rows of `training` (text, lang); None without any.

    The driver gathers one count per language and hashed trigram: at most
    SLOTS numbers a language.
    """
    rows = training.select("text", "lang").filter("lang is not null and text is not null")
    counts = rows.mapInArrow(_count_batches, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    if not got.num_rows:
        return None
    langs = sorted(set(got.column("lang").to_pylist()))
    table = np.zeros((len(langs), SLOTS))
    place = {lang: k for k, lang in enumerate(langs)}
    table[[place[x] for x in got.column("lang").to_pylist()], got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return Decoder(langs, table)


def predict_languages(df: DataFrame, decoder: Decoder | None, id_col: str = "doc_id", text_col: str = "text",
                      least_lead: float = 0.2) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous: one row per input row, from the text alone.

    `score` is the chosen language's share of belief, `ambiguous` marks texts
    whose best language leads the next by less than `least_lead`. Texts that
    are null or without a letter are `und` with score 0 and ambiguous, as is
    every text if there was nothing to learn from. Ties go to the language
    first in the alphabet. Null ids stay null, repeated rows each give a row,
    an empty table none. Other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(decoder)
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_predict_batches(shared, least_lead), RESULT)
