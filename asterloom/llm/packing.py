"""Packing of token sequences by bin completion over their lengths.

What a packing needs to know is how many pieces have each length, at most
`capacity` numbers however many documents there are. Over these the search
fills one sequence after the other around the longest piece left: it enumerates
the fillings that no other filling dominates, those with least waste first, and
uses a filling as often as the counts allow. Best-fit decreasing gives the first
solution; a branch is cut when its waste shows that it can't beat the best one.
Pieces then take their places by their rank among those of their length, which
Spark computes without a hot key.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise
from .textops import each_slice, unused
from .word_ids import word_ids

CAPACITY = 2048
NODES = 4000  # how many fillings the search tries beyond its first descent
SLICE = 4 << 20
END_ID = 0

Filling = tuple[tuple[int, int], ...]  # (length, how often), longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces that can't share one."""
    if not counts:
        return 0
    sizes = np.array(sorted(counts))
    many = np.array([counts[int(s)] for s in sizes], dtype=object)  # exact at any size
    number = np.concatenate([[0], np.cumsum(many)])
    length = np.concatenate([[0], np.cumsum(many * sizes)])
    half = int(np.searchsorted(sizes, capacity // 2, "right"))
    best = -(-int(length[-1]) // capacity)
    for least in {0, *(int(s) for s in sizes[:half])}:
        alone = int(np.searchsorted(sizes, capacity - least, "right"))
        alone = max(alone, half)
        low = int(np.searchsorted(sizes, least, "left"))
        room = (number[alone] - number[half]) * capacity - (length[alone] - length[half])
        rest = max(0, (length[half] - length[low]) - room) if half > low else 0
        best = max(best, int(number[-1] - number[half] + -(-int(rest) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, many equal sequences at a time."""
    open_ones: dict[int, list[list]] = {}  # room: [filling, how many]
    rooms: list[int] = []

    def put(filling: Counter, room: int, n: int) -> None:
        if room not in open_ones:
            open_ones[room] = []
            insort(rooms, room)
        open_ones[room].append([filling, n])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = next((r for r in rooms if r >= size), None)
            if room is None:
                each = capacity // size
                if left // each:
                    put(Counter({size: each}), capacity - each * size, left // each)
                if left % each:
                    put(Counter({size: left % each}), capacity - left % each * size, 1)
                break
            filling, n = open_ones[room].pop()
            if not open_ones[room]:
                del open_ones[room]
                rooms.remove(room)
            # The fullest sequence that takes the piece takes as many as fit.
            each = room // size
            full = min(n, left // each)
            if full:
                put(filling + Counter({size: each}), room - each * size, full)
            if full < n and (some := min(each, left - full * each)):
                put(filling + Counter({size: some}), room - some * size, 1)
                if n - full - 1:
                    put(filling, room, n - full - 1)
                left -= some
            elif full < n:
                put(filling, room, n - full)
            left -= full * each
    merged: Counter = Counter()
    for found in open_ones.values():
        for filling, n in found:
            merged[tuple(sorted(filling.items(), reverse=True))] += n
    return sorted(merged.items(), reverse=True)


def _dominated(chosen: list[int], waste: int, left: dict[int, int]) -> bool:
    """Whether one piece that is left could take the place of one or several chosen ones.

    It then is as long or longer and still fits, and what it replaces can go
    wherever it went.
    """
    one = several = 0
    for size in chosen:
        several |= (several | one) << size
        one |= 1 << size
    there = 0
    for size, n in left.items():
        if n:
            there |= 1 << size
    for more in range(waste + 1):
        if (several << more | (one << more if more else 0)) & there:
            return True
    return False


def fillings(counts: dict[int, int], room: int, most_waste: int) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) of all undominated fillings of `room`, least waste and longest pieces first."""
    sizes = sorted(s for s, n in counts.items() if n and s <= room)
    mask, reach = (1 << room + 1) - 1, [1]
    for size in sizes:
        # Sums that this size and shorter ones can make, each as often as there.
        sums, n, step = reach[-1], min(counts[size], room // size), 1
        while n:
            step = min(step, n)
            sums |= sums << size * step & mask
            n, step = n - step, step * 2
        reach.append(sums)

    def choose(total: int, last: int) -> Iterator[list[int]]:
        """Ways to make exactly `total` of sizes[:last + 1], longest first."""
        if not total:
            yield []
            return
        for k in range(last, -1, -1):
            size = sizes[k]
            if size > total or not reach[k + 1] >> total & 1:
                if size <= total:
                    return
                continue
            for n in range(min(counts[size], total // size), 0, -1):
                if reach[k] >> (total - n * size) & 1:
                    for rest in choose(total - n * size, k - 1):
                        yield [size] * n + rest

    for waste in range(min(most_waste, room) + 1):
        if reach[-1] >> (room - waste) & 1:
            for chosen in choose(room - waste, len(sizes) - 1):
                used = Counter(chosen)
                if not _dominated(chosen, waste, {s: counts[s] - used[s] for s in sizes}):
                    yield waste, tuple(sorted(used.items(), reverse=True))


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """(filling, how often): a packing of all pieces in as few sequences as the search finds.

    Ends when a lower bound is met, when all is tried, or after `nodes` fillings
    beyond the first descent; the best packing so far is the result.
    """
    counts = {s: n for s, n in sorted(counts.items(), reverse=True) if n}
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    left = dict(counts)
    used = waste = 0

    def apply(step: tuple[Filling, int, int], sign: int) -> None:
        nonlocal used, waste
        filling, times, lost = step
        used, waste = used + sign * times, waste + sign * times * lost
        for size, n in filling:
            left[size] -= sign * n * times

    def options() -> Iterator[tuple[Filling, int, int]]:
        """(filling, how often, waste of each) around the longest piece left."""
        first = next(s for s, n in left.items() if n)
        rest = {s: n - (s == first) for s, n in left.items()}
        for lost, filling in fillings(rest, capacity - first, (fewest - 1) * capacity - total - waste):
            whole = Counter(dict(filling))
            whole[first] += 1
            for times in range(min(left[s] // n for s, n in whole.items()), 0, -1):
                yield tuple(sorted(whole.items(), reverse=True)), times, lost

    # Each level: what can still be tried there, and what is in use.
    levels: list[list] = [[options(), None]] if left else []
    tried, descended = 0, False
    while levels and fewest > bound and tried < nodes:
        level = levels[-1]
        if level[1]:
            apply(level[1], -1)
        level[1] = step = next(level[0], None)
        if step is None:
            levels.pop()
            descended = True
            continue
        tried += descended
        apply(step, 1)
        # All waste there may be: one sequence less than the best packing has.
        if waste > (fewest - 1) * capacity - total:
            continue
        if not any(left.values()):
            descended = True
            if used < fewest:
                fewest, best = used, [(lv[1][0], lv[1][1]) for lv in levels]
        elif used + -(-sum(s * n for s, n in left.items()) // capacity) < fewest:
            levels.append([options(), None])
    return best


def _places(packing: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """For each length, which ranks lie in which sequences at which offsets."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for filling, times in packing:
        offset = 0
        for size, n in filling:
            rows.append((size, taken[size], n, sequence, offset))
            taken[size] += n * times
            offset += size * n
        sequence += times
    rows.sort()
    names = ("length", "first", "each", "sequence", "offset")
    return {name: np.array([r[k] for r in rows], np.int64) for k, name in enumerate(names)}


def _place(places: dict[str, np.ndarray], rank_col: str):
    firsts = {}
    edges = np.flatnonzero(np.diff(places["length"], prepend=-1, append=-1)) if len(places["length"]) else np.zeros(0, np.int64)
    for a, b in zip(edges, edges[1:]):
        firsts[int(places["length"][a])] = (int(a), places["first"][a:b])

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", rank_col))
            row = np.zeros(len(length), np.int64)
            for size in np.unique(length):
                base, first = firsts[int(size)]
                chosen = length == size
                row[chosen] = base + np.searchsorted(first, rank[chosen], "right") - 1
            nth, each = rank - places["first"][row], places["each"][row]
            sequence = places["sequence"][row] + nth // np.maximum(each, 1)
            offset = places["offset"][row] + nth % np.maximum(each, 1) * length
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != rank_col]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in kept), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*(n for n, _ in kept), "sequence_id", "offset"])
    return run


def _pieces(content: str, capacity: int):
    def run(batches):
        words = word_ids(content)
        for batch, first, last, data, offsets in each_slice(batches, SLICE):
            ids, counts = words.encode(data, offsets)
            ends = np.cumsum(counts)
            # Every document ends with one more id.
            flat = np.insert(ids.astype("<u4"), ends, END_ID).astype("<u4")
            sizes = counts + 1
            begin = np.cumsum(sizes) - sizes
            pieces = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), pieces)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            at = np.append((begin[owner] + start) * 4, len(flat) * 4)
            doc = batch.column("doc_id").slice(first, last - first).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(nth, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(owner), [None, pa.py_buffer(at), pa.py_buffer(flat)])
                 .cast(pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"])
    return run


def token_pieces(
    df: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, piece int, start, length, ids binary: every document's token ids in pieces of at most `capacity`.

    A document is the ids that the public tokenizers library gives for the whole
    text, without added special tokens, and then id 0; `ids` holds them as
    little-endian 32-bit numbers. Only documents longer than `capacity` are cut.
    A null text is empty and gives the piece of id 0 alone. Null ids stay null;
    repeated rows give pieces each; an empty table gives none; other columns
    are ignored.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        content = f.read()
    word_ids(content)  # fails here, not in a task, for an unsuitable file
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_pieces(content, capacity), "doc_id long, piece int, start long, length long, ids binary")


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """The rows with sequence_id and offset: where each goes in sequences of at most `capacity`.

    `pieces` has a column `length` from 1 to `capacity`; all its columns but
    columns named sequence_id or offset are kept. In a sequence the pieces stand
    one behind the other from 0. Rows that are equal each get a place; an empty
    table gives no rows; a length out of range or null is an error.

    The rows are written once. To the driver go the counts by length and back
    come the fillings: `capacity` lengths at most, whatever the size of the
    table. A row's rank among its length is its rank in the partition it was
    written from and what earlier partitions have of that length, so a length
    that a third of all rows have is ranked in as many tasks as wrote it.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    part, rank, before, many = unused(columns, "part", "rank", "before", "many")
    checked = F.when(F.col("length").between(1, capacity), F.col("length")).otherwise(
        F.raise_error(F.lit(f"a piece's length must be from 1 to {capacity}")).cast("long"))
    stored = materialise(
        pieces.select(columns).withColumn("length", checked.cast("long")).withColumn(part, F.spark_partition_id()), "pieces")
    # Narrow: a count for each partition and length.
    counts = materialise(stored.groupBy(part, "length").agg(F.count(F.lit(1)).alias(many)), "lengths")
    found = counts.groupBy("length").agg(F.sum(many).alias(many)).collect()  # at most `capacity` rows
    places = _places(complete_bins({r["length"]: r[many] for r in found}, capacity, nodes))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, "length", F.coalesce(F.sum(many).over(earlier), F.lit(0)).alias(before))
    order = [c for c in ("doc_id", "piece") if c in columns] or ["length"]
    ranked = stored.withColumn(rank, F.row_number().over(Window.partitionBy(part, "length").orderBy(*order)) - 1)
    placed = ranked.join(offsets, [part, "length"]).select(
        *[F.col(f"`{c}`") for c in columns], (F.col(before) + F.col(rank)).alias(rank))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields if f.name != rank]
    return placed.mapInArrow(_place(places, rank), ", ".join([*kinds, "sequence_id long", "offset long"]))
