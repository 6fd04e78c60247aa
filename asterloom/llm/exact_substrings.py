"""Removal of repeated byte strings, keeping the first, over all documents.

A byte goes if some `SPAN`-byte string that covers it also starts earlier. Equal
SPAN-byte windows are grouped by fingerprint; no suffix order and no longest
previous factors are computed. The windows are sharded by content, so that equal
ones meet:

1. Each SPAN-byte window is owned by its least Q-gram (by hash, the leftmost),
   which depends on the window's bytes alone. Consecutive windows with one owner
   form a run. Of runs with equal bytes only the first can hold anything new.
2. Where a Q-gram owns runs of different bytes, their windows are grouped by
   fingerprint. Among equal ones all but the one at the first position are covered.
3. A document's covered windows are merged and cut out.

Runs with equal bytes are merged before they are shuffled, so a passage in a
third of all documents sends one run per Q-gram and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .textops import BYTE_VALUE, MULTIPLIER, INVERSE, U, mix, powers, text_bytes

SPAN, Q = 100, 16
WIDTH = SPAN - Q + 1  # Q-grams in a window
PIECE = 1 << 20  # bytes worked on at once; longer texts are worked on in parts
INDEX = U((1 << 24) - 1)
HELD = 1 << 18  # runs gathered before they are sent
SHARD_BYTES = 32 << 20
RUN = [("h", "<i8"), ("seg", "<i8"), ("doc", "<i8"), ("tie", "<i8"), ("at", "<i4"), ("g", "u1"), ("o", "u1")]


def fingerprints(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the byte strings data[first:stop]."""
    n = len(data)
    total = np.zeros(n + 1, U)
    np.cumsum(BYTE_VALUE[data] * powers(MULTIPLIER, n)[:n], out=total[1:])
    return mix((total[stop] - total[first]) * powers(INVERSE, n)[first] + (stop - first).astype(U) * U(0x9E3779B97F4A7C15))


def window_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, last window, owner, owner's hash, fingerprint) of each run."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < SPAN:
        return empty, empty, empty, empty, empty
    gram = BYTE_VALUE[data]
    for k in (1, 2, 4, 8):
        step = gram.copy()
        step[:-k] = (gram[:-k] ^ (gram[:-k] >> U(29))) * U(0xD6E8FEB86659FD93) + gram[k:]
        gram = step
    gram = mix(gram, 5)
    least = (gram & ~INDEX) | np.arange(n, dtype=U)
    k = 1
    while 2 * k <= WIDTH:
        least[:-k] = np.minimum(least[:-k], least[k:])
        k *= 2
    if WIDTH > k:
        least[: k - WIDTH] = np.minimum(least[: k - WIDTH], least[WIDTH - k :])
    inside = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= SPAN
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - SPAN + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(starts):
        return empty, empty, empty, empty, empty
    owner = (least[starts] & INDEX).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    owner = owner[new]
    seg = mix(fingerprints(data, first, last + SPAN) + (owner - first).astype(U), 6)
    return first, last, owner, gram[owner], seg


def pieces(batches):
    """(batch, rows, where each row's part begins in its text, bytes, offsets).

    Windows never span two parts: parts of a long text overlap by SPAN - 1 bytes.
    """
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        row, n = 0, len(offsets) - 1
        while row < n:
            size = offsets[row + 1] - offsets[row]
            if size > PIECE:
                for at in range(0, int(size), PIECE):
                    part = data[offsets[row] + at : min(offsets[row] + at + PIECE + SPAN - 1, offsets[row + 1])]
                    yield batch, np.array([row]), at, part, np.array([0, len(part)])
                row += 1
                continue
            last = max(int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1, row + 1)
            while last > row + 1 and offsets[last] - offsets[last - 1] > PIECE:
                last -= 1
            part = offsets[row : last + 1]
            yield batch, np.arange(row, last), 0, data[part[0] : part[-1]], part - part[0]
            row = last


def _pack(runs: np.ndarray) -> bytes:
    return b"".join(runs[name].tobytes() for name, _ in RUN)


def _unpack(blob: bytes) -> np.ndarray:
    n, place = len(blob) // sum(np.dtype(t).itemsize for _, t in RUN), 0
    out = np.empty(n, RUN)
    for name, kind in RUN:
        size = n * np.dtype(kind).itemsize
        out[name] = np.frombuffer(blob[place : place + size], kind)
        place += size
    return out


def first_runs(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs in order, and which of them repeat the bytes of an earlier one."""
    runs = runs[np.lexsort((runs["tie"], runs["at"], runs["doc"], runs["seg"], runs["h"]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs["h"][1:] != runs["h"][:-1]) | (runs["seg"][1:] != runs["seg"][:-1])
    head = runs[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return runs, ~new & ((runs["doc"] != head["doc"]) | (runs["at"] != head["at"]))


def _run_batches(shards: int):
    """Runs by shard; those that repeat another run of the task go to shard -1."""
    def send(held):
        runs, again = first_runs(np.concatenate(held))
        shard = np.where(again, -1 - (mix(runs["doc"].view(U), 9) % U(shards)).astype(np.int64),
                         (mix(runs["h"].view(U), 8) % U(shards)).astype(np.int64))
        order = np.argsort(shard, kind="stable")
        runs, shard = runs[order], shard[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(runs)]])
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[edges[:-1]].astype(np.int32)),
             pa.array([_pack(runs[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())], ["shard", "runs"])

    def run(batches):
        held, size = [], 0
        for batch, rows, at, data, offsets in pieces(batches):
            first, last, owner, h, seg = window_runs(data, offsets)
            text = np.searchsorted(offsets, first, "right") - 1
            runs = np.empty(len(first), RUN)
            row = rows[text]
            runs["doc"], runs["tie"] = np.asarray(batch.column("doc_id"))[row], np.asarray(batch.column("tie"))[row]
            runs["at"], runs["g"], runs["o"] = first - offsets[text] + at, last - first + 1, owner - first
            runs["h"], runs["seg"] = h.view(np.int64), seg.view(np.int64)
            held.append(runs)
            size += len(runs)
            if size >= HELD:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)
    return run


def _judge_runs(batches):
    """Covered runs, and runs whose Q-gram also owns other bytes (open)."""
    shards: dict[int, list[bytes]] = {}
    for batch in batches:
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            shards.setdefault(shard, []).append(blob)
    for shard, blobs in shards.items():
        runs = np.concatenate([_unpack(b) for b in blobs])
        if shard < 0:
            covered, keep = np.ones(len(runs), bool), np.ones(len(runs), bool)
        else:
            runs, covered = first_runs(runs)
            new = np.concatenate([[True], runs["h"][1:] != runs["h"][:-1]])
            group = np.cumsum(new) - 1
            segs = np.concatenate([[True], (runs["seg"][1:] != runs["seg"][:-1]) | new[1:]])
            several = (np.bincount(group, segs) > 1)[group]
            keep = covered | several
        runs, covered = runs[keep], covered[keep]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(runs[c].astype(t)) for c, t in
               (("doc", np.int64), ("tie", np.int64), ("at", np.int32), ("g", np.int32), ("o", np.int32), ("h", np.int64))),
             pa.array(~covered)], ["doc_id", "tie", "at", "g", "o", "h", "open"])


def _segment_batches(shards: int):
    """The bytes of open runs, by shard of their Q-gram."""
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("open_runs")
            counts = np.asarray(lists.value_lengths())
            flat = lists.flatten()
            at, g, o, h = (np.asarray(flat.field(k)) for k in range(4))
            row = np.repeat(np.arange(batch.num_rows), counts)
            start, size = offsets[row] + at, g + SPAN - 1
            raw = data.tobytes() if len(data) else b""
            shard = (mix(h.view(U), 8) % U(shards)).astype(np.int32)
            doc, tie = np.asarray(batch.column("doc_id"))[row], np.asarray(batch.column("tie"))[row]
            # One row for each shard of the batch, so that a hot Q-gram costs no extra rows.
            order = np.argsort(shard, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(shard[order])) + 1, [len(order)]]) if len(order) else [0]
            rows = []
            for a, b in zip(edges, edges[1:]):
                k = order[a:b]
                runs = np.empty(len(k), RUN)
                for name, values in (("h", h), ("seg", h), ("doc", doc), ("tie", tie), ("at", at), ("g", g), ("o", o)):
                    runs[name] = values[k]
                rows.append((int(shard[k[0]]), _pack(runs), b"".join([raw[x : x + y] for x, y in zip(start[k], size[k], strict=True)])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.binary())], ["shard", "runs", "bytes"])
    return run


def covered_windows(runs: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, window within the run) of all windows that also start earlier."""
    size = runs["g"].astype(np.int64) + SPAN - 1
    begin = np.cumsum(size) - size
    g = runs["g"].astype(np.int64)
    run = np.repeat(np.arange(len(runs)), g)
    window = np.arange(len(run)) - np.repeat(np.cumsum(g) - g, g)
    place = begin[run] + window
    key = mix(fingerprints(data, place, place + SPAN) ^ mix(runs["h"].view(U), 3)[run] ^ (window - runs["o"][run]).astype(np.int64).view(U))
    doc, at = runs["doc"][run], runs["at"][run] + window
    order = np.lexsort((at, doc, key))  # equal windows together, then by position
    key, doc, at = key[order], doc[order], at[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]  # the smallest position among equal windows
    again = order[~new & ((doc != doc[head]) | (at != at[head]))]
    again.sort()
    return run[again], window[again]


def _judge_windows(batches):
    shards: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for shard, runs, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "runs", "bytes")), strict=True):
            shards.setdefault(shard, []).append((runs, data))
    for blobs in shards.values():
        runs = np.concatenate([_unpack(r) for r, _ in blobs])
        run, window = covered_windows(runs, np.frombuffer(b"".join([d for _, d in blobs]), np.uint8))
        if not len(run):
            continue
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(run)) - 1
        own = runs[run[first]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own["doc"]), pa.array(own["tie"]), pa.array((own["at"] + window[first]).astype(np.int32)),
             pa.array((own["at"] + window[last] + SPAN).astype(np.int32))], ["doc_id", "tie", "first", "stop"])


def _cut_batches(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        lists = batch.column("covered")
        flat, counts = lists.flatten(), np.asarray(lists.value_lengths().fill_null(0))
        first, stop = np.asarray(flat.field(0), np.int64), np.asarray(flat.field(1), np.int64)
        edge, out = 0, []
        for row, n in enumerate(counts):
            text = data[offsets[row] : offsets[row + 1]]
            spans, kept, place = [], [], 0
            a, b = first[edge : edge + n], stop[edge : edge + n]
            edge += n
            for x, y in sorted(zip(a.tolist(), b.tolist(), strict=True)):
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], y)
                else:
                    spans.append([x, y])
            for x, y in spans:
                kept.append(text[place:x].tobytes())
                place = y
            kept.append(text[place:].tobytes())
            out.append((len(text), sum(y - x for x, y in spans), b"".join(kept), spans))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
            pa.array([len(x[3]) for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary()),
            pa.array([[{"first": a, "stop": b} for a, b in x[3]] for x in out], pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))),
        ], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "removed"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept binary, removed (byte ranges): a row per input row.

    Texts are judged as they are given, as UTF-8 bytes; earlier means a smaller
    doc_id, or the same and an earlier start. `removed` lists the maximal
    removed runs as half-open ranges.

    A null text is empty; texts shorter than SPAN keep everything. Rows without
    an id take no part and stay whole. Rows that share an id are versions of one
    document: a string at the same place of two versions is not earlier in
    either, so equal rows get equal results. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    named = docs.filter("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    shards = 8 * parts
    runs = named.mapInArrow(_run_batches(shards), "shard int, runs binary").repartition(parts, "shard")
    judged = materialise(runs.mapInArrow(
        _judge_runs, "doc_id long, tie long, at int, g int, o int, h long, open boolean"), "runs")
    opened = judged.filter("open").groupBy("doc_id", "tie").agg(F.collect_list(F.struct("at", "g", "o", "h")).alias("open_runs"))
    segments = named.join(opened, ["doc_id", "tie"]).mapInArrow(_segment_batches(shards), "shard int, runs binary, bytes binary")
    windows = segments.repartition(parts, "shard").mapInArrow(_judge_windows, "doc_id long, tie long, first int, stop int")
    whole = judged.filter("not open").select("doc_id", "tie", F.col("at").alias("first"), (F.col("at") + F.col("g") + SPAN - 1).alias("stop"))
    covered = materialise(whole.union(windows), "covered").groupBy("doc_id", "tie").agg(
        F.collect_list(F.struct("first", "stop")).alias("covered"))
    cut = docs.join(covered, ["doc_id", "tie"], "left").select("doc_id", "text", "covered")
    return cut.mapInArrow(
        _cut_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<first int, stop int>>")
