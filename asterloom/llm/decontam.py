"""Benchmark decontamination by SimHash over item-sized windows.

An item is fingerprinted by a SimHash of 256 bits over its shingles, and so is
every window of as many shingles in a text that can match it at all: a window
without any shingle of an item has similarity 0. A window is a candidate for an
item of its size if, of their 16 fingerprint blocks of 16 bits, some block
differs in at most 4: by the pigeonhole principle this finds every pair within
79 bits. A similarity of 0.8 shows 39 differing bits on average with a deviation
of under 6, chance 128. Candidates are then compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U, Words, each_slice, id_text, mix, tidy

LANES, LANE_ERRORS = 16, 4
RADIUS = LANES * (LANE_ERRORS + 1) - 1
MAX_ITEMS, MAX_ITEM_BYTES = 20_000, 32 << 20  # of one broadcast block of items
BITS_SET = np.array([x.bit_count() for x in range(1 << 16)], np.uint8)
RESULT = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def sign_bits(shingles: np.ndarray) -> np.ndarray:
    """256 pseudo-random bits of each shingle."""
    words = np.stack([mix(shingles, 60 + k) for k in range(4)], axis=1)
    return np.unpackbits(words.view(np.uint8).reshape(len(shingles), 32), axis=1)


def fingerprints(bits: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of `size` rows of `bits`, as 16 blocks of 16 bits."""
    total = np.zeros((len(bits) + 1, 256), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    votes = total[size:] - total[:-size]
    return np.packbits(2 * votes > size, axis=1).view(np.uint16)


class Items:
    """A block of benchmark items, indexed by shingle and by size."""

    def __init__(self, ids: list[int], texts: list[str], width: int):
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
        hashes, text, _ = words.shingles(width)
        self.ids, self.n_words = np.array(ids), words.counts
        self.shingles = [hashes[text == k] for k in range(len(ids))]
        self.prints = [fingerprints(sign_bits(s), len(s))[0] if len(s) else None for s in self.shingles]
        known = np.unique(hashes)
        self.known = known
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(known >> U(44)).astype(np.int64)] = True
        order = np.argsort(hashes, kind="stable")
        self.by_hash, self.by_item = hashes[order], text[order]
        sizes = np.array([len(s) for s in self.shingles])
        self.sizes = {int(m): np.flatnonzero(sizes == m) for m in np.unique(sizes) if m}
        self.size_of = sizes

    def seeds(self, hashes: np.ndarray) -> np.ndarray:
        """Places of shingles that occur in some item."""
        place = np.flatnonzero(self.sieve[(hashes >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[place]), len(self.known) - 1)
        return place[self.known[at] == hashes[place]]

    def matches(self, hashes: np.ndarray, seeds: np.ndarray, least: float):
        """(item, similarity, first shingle, size) of the best window of each item.

        `hashes` are the shingles of one text, `seeds` the places of known ones.
        """
        lo = np.searchsorted(self.by_hash, hashes[seeds], "left")
        hi = np.searchsorted(self.by_hash, hashes[seeds], "right")
        touched = {int(x) for a, b in zip(lo, hi, strict=True) for x in self.by_item[a:b]}
        for size in sorted({int(self.size_of[k]) for k in touched}):
            window = min(size, len(hashes))
            inside = np.zeros(len(hashes) - window + 2, np.int64)
            np.add.at(inside, np.maximum(seeds - window + 1, 0), 1)
            np.add.at(inside, np.minimum(seeds + 1, len(inside) - 1), -1)
            starts = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
            runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
            prints = np.concatenate([
                fingerprints(sign_bits(hashes[r[0] : r[-1] + window]), window) for r in runs])
            for item in self.sizes[size]:
                lanes = BITS_SET[prints ^ self.prints[item]]
                close = (lanes <= LANE_ERRORS).any(axis=1) & (lanes.sum(axis=1, dtype=np.int32) <= RADIUS)
                best = self.best_window(hashes, starts[close], window, item)
                if best and best[0] >= least:
                    yield item, best[0], best[1], window

    def best_window(self, hashes: np.ndarray, starts: np.ndarray, window: int, item: int):
        """Exact similarity, weighted by how often a shingle occurs; first of the best."""
        if not len(starts):
            return None
        own, weight = np.unique(self.shingles[item], return_counts=True)
        size = len(self.shingles[item])
        at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
        shared = np.where(own[at] == hashes, at, -1)
        upper = np.concatenate([[0], np.cumsum(shared >= 0)])
        upper = upper[starts + window] - upper[starts]
        best = None
        for k in np.argsort(-upper, kind="stable"):
            if best and upper[k] / (size + window - upper[k]) < best[0]:
                break
            part = shared[starts[k] : starts[k] + window]
            counts = np.bincount(part[part >= 0], minlength=len(own))
            both = int(np.minimum(counts, weight).sum())
            value = both / (size + window - both)
            if best is None or value > best[0] or (value == best[0] and starts[k] < best[1]):
                best = (value, int(starts[k]))
        return best


def _match_batches(ids: list[int], texts: list[str], width: int, least: float):
    def run(batches):
        items = Items(ids, texts, width)
        for batch, first, last, data, offsets in each_slice(batches):
            if not len(items.known):
                return
            words = Words(data, offsets)
            hashes, text, begin = words.shingles(width)
            seeds = items.seeds(hashes)
            rows = []
            names = batch.column("doc_id").slice(first, last - first)
            edges = np.searchsorted(text, np.arange(last - first + 1))
            for t in np.unique(text[seeds]):
                a, b = edges[t], edges[t + 1]
                own = seeds[np.searchsorted(seeds, a) : np.searchsorted(seeds, b)] - a
                for item, value, place, size in items.matches(hashes[a:b], own, least):
                    word = int(begin[a + place] - words.first[t])
                    n = size + width - 1 if words.counts[t] >= width else int(words.counts[t])
                    rows.append((names[int(t)].as_py(), int(items.ids[item]), value, word, n))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) if i else pa.array(x, pa.int64()) for i, x in enumerate(zip(*rows, strict=True))],
                    ["doc_id", "item_id", "similarity", "first_word", "n_words"])
    return run


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", width: int = 5,
                 least: float = 0.8) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words of each match.

    A text holds an item if one of its windows with as many `width`-word
    shingles as the item (or the whole text, if shorter) has a similarity of at
    least `least`: shared shingles, as often as they occur in both, over all.
    The most similar window is given, the first among equals. Items with fewer
    words than a shingle are one shingle and match only texts equal to them.

    Items are sent to all tasks in blocks of at most MAX_ITEMS items and
    about MAX_ITEM_BYTES bytes; a larger benchmark takes a pass over the texts
    for each block, so no broadcast grows with it.

    Null, empty and wordless texts and items match nothing; items without an id
    are left out; repeated rows match each on their own. An empty table on
    either side gives an empty result. Other columns are ignored.
    """
    docs = id_text(df, id_col, text_col)
    spark = df.sparkSession
    items = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    items = items.filter("item_id is not null and length(text) > 0")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-count // MAX_ITEMS), -(-size // MAX_ITEM_BYTES))
    found = spark.createDataFrame([], RESULT)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for k in range(blocks):
        rows = items.filter(block == k).distinct().orderBy("item_id", "text").collect()
        job = _match_batches([r[0] for r in rows], [r[1] for r in rows], width, least)
        found = found.union(docs.mapInArrow(tidy(job), RESULT)) if k else docs.mapInArrow(tidy(job), RESULT)
    return found
