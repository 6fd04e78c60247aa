"""MinHash near-dedup with SuperMinHash signatures.

Every element (word shingle) of a text takes the slots of the signature in a
pseudo-random order of its own; in round j it offers slot p_j the value
j + fraction, and each slot keeps the least value offered. Ranks within an
element are thus correlated (each is used once), which lowers the variance
against independent hashes. As round j only offers values of j or more, a text
is finished once all its slots hold less than j: long texts need one or two
rounds. The order is (a + j * b) modulo a prime number of slots, which is
pairwise uniform, all that the variance depends on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .components import components
from .textops import U, Words, distinct_per_text, each_slice, id_text, list_array, mix, tidy, with_end

SLOTS = 389  # prime; the first ones make the bands, all of them the sketch
ROWS = 4  # slots per band
FEATURES = "doc_id long, n_shingles long, key_a long, key_b long, sketch binary, bands array<long>"
BLOCK = 256  # members of a bucket that one task compares with as many others


def signatures(values: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """SuperMinHash of each text's distinct elements: n_texts x SLOTS."""
    best = np.full(n_texts * SLOTS, U(2**64 - 1))
    first = mix(values, 11)
    start = (first % U(SLOTS)).astype(np.int64)
    stride = ((first >> U(32)) % U(SLOTS - 1)).astype(np.int64) + 1
    live_texts = np.unique(text)
    for rank in range(SLOTS):
        fraction = mix(values, 100 + rank) >> U(16)
        np.minimum.at(best, text * SLOTS + start, (U(rank) << U(48)) | fraction)
        worst = best.reshape(n_texts, SLOTS)[live_texts].max(axis=1) >> U(48)
        open_text = np.zeros(n_texts, bool)
        live_texts = live_texts[worst > U(rank)]
        if not len(live_texts):
            break
        open_text[live_texts] = True
        keep = open_text[text]
        values, text, start, stride = values[keep], text[keep], start[keep], stride[keep]
        start = (start + stride) % SLOTS
    return best.reshape(n_texts, SLOTS)


def _feature_batches(width: int, bands: int):
    def run(batches):
        for batch, first, last, data, offsets in each_slice(batches):
            n = last - first
            values, text, _ = Words(data, offsets).shingles(width)
            values, text = distinct_per_text(values, text)
            counts = np.bincount(text, minlength=n)
            sign = signatures(values, text, n)
            key_a, key_b = np.zeros(n, U), np.zeros(n, U)
            np.add.at(key_a, text, mix(values, 21))
            np.add.at(key_b, text, mix(values, 22))
            has = counts > 0
            parts = sign[:, : bands * ROWS].reshape(n, bands, ROWS)
            band = np.zeros((n, bands), U)
            for k in range(ROWS):
                band = mix(band ^ parts[:, :, k], 31 + k)
            band = mix(band + np.arange(bands, dtype=U), 41)
            sketch = mix(sign, 51).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, n),
                pa.array(counts.astype(np.int64)),
                pa.array(key_a.view(np.int64)),
                pa.array(key_b.view(np.int64)),
                pa.array([row.tobytes() if ok else b"" for row, ok in zip(sketch, has, strict=True)], pa.binary()),
                list_array(band[has].ravel().view(np.int64), np.where(has, bands, 0), pa.int64()),
            ], ["doc_id", "n_shingles", "key_a", "key_b", "sketch", "bands"])
    return run


def _set_batches(width: int):
    def run(batches):
        for batch, first, last, data, offsets in each_slice(batches):
            values, text, _ = Words(data, offsets).shingles(width)
            values, text = distinct_per_text(values, text)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first),
                list_array(values.view(np.int64), np.bincount(text, minlength=last - first), pa.int64()),
            ], ["doc_id", "shingles"])
    return run


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, less what chance gives one-byte slots."""
    same = (a == b).sum(axis=-1) / SLOTS
    return (same - 1 / 256) / (1 - 1 / 256)


def _least_agreement(similarity: float) -> float:
    """4.5 standard deviations under what a pair at the threshold shows: one in 300,000 is below."""
    return max(0.0, similarity - 4.5 * (similarity * (1 - similarity) / SLOTS) ** 0.5)


def _plausible_batches(least: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
            b = np.frombuffer(b"".join(batch.column("leader_sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
            keep = pa.array(_agreement(a, b) >= least)
            yield batch.select(["node", "near"]).filter(keep)
    return run


def _cross_batches(least: float, similarity: float):
    """Plausible pairs of a block of strays with a block of all members.

    The rows come sorted by bucket and block, so that each block is a run; the
    last run of a batch waits for the next batch.
    """
    def pairs(c: dict[str, np.ndarray], first: int, last: int):
        stray = c["stray"][first:last]
        left, right = np.flatnonzero(stray) + first, np.flatnonzero(~stray) + first
        node, comp, n, major, sketch, bands = (c[k] for k in ("node", "component", "n", "major", "sketch", "bands"))
        for i in left:
            other = right[(comp[right] != comp[i]) & ((comp[right] == major[i]) | (node[right] > node[i]))]
            other = other[np.minimum(n[other], n[i]) >= similarity * np.maximum(n[other], n[i])]
            if len(other):
                other = other[_agreement(sketch[other], sketch[i]) >= least]
            if len(other):
                # A pair that shares several buckets comes out of the first of them only.
                shared = (bands[other] == bands[i]).argmax(axis=1)
                other = other[bands[i][shared] == c["bucket"][i]]
                yield np.full(len(other), node[i]), node[other]

    def run(batches):
        rest = None
        for batch in with_end(batches):
            table = [x for x in (rest, batch) if x is not None]
            if not table:
                return
            table = pa.Table.from_batches(table).combine_chunks()
            if not table.num_rows:
                rest = None
                continue
            c = {k: table.column(k).to_numpy() for k in ("bucket", "i", "j", "node", "component", "n", "major", "stray")}
            c["sketch"] = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
            c["bands"] = np.asarray(table.column("bands").combine_chunks().flatten()).reshape(table.num_rows, -1)
            new = (np.diff(c["bucket"]) != 0) | (np.diff(c["i"]) != 0) | (np.diff(c["j"]) != 0)
            edges = np.concatenate([[0], np.flatnonzero(new) + 1, [table.num_rows]])
            if batch is not None:
                rest = table.slice(edges[-2]).to_batches()[0]
                edges = edges[:-1]
            found = [x for k in range(len(edges) - 1) for x in pairs(c, edges[k], edges[k + 1])]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["node", "near"])
    return run


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    wanted = pairs.select("node").union(pairs.select("near")).distinct().withColumnRenamed("node", "doc_id")
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(
        tidy(_set_batches(width)), "doc_id long, shingles array<long>")
    sets = materialise(sets, "sets")
    left = sets.select(F.col("doc_id").alias("node"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc_id").alias("near"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - both
    return pairs.join(left, "node").join(right, "near").filter(100 * both >= percent * union).select("node", "near")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, bands: int = 24) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Texts are linked if their sets of `width`-word shingles have a Jaccard
    similarity of at least `percent` / 100, confirmed on the full sets; a
    component is what links connect, named by its smallest id, and the row with
    that id is kept. A pair at the threshold of 80 % shares none of 24 bands of
    four slots once in 200,000; at 85 % once in 50 million.

    1. Equal sets become one class with its smallest id.
    2. In each band bucket all classes are compared with one leader, the one
       that meets most others over all buckets: a star, not all pairs.
    3. Where a bucket still holds several components, its strays (members outside
       the leader's component) are compared with all members, block by block, on
       their sketches inside tasks; only plausible pairs of different components
       come out, and are verified like the others.

    Texts that are null, empty or without words have an empty set and are
    linked with nothing. Rows that share an id count as one document with
    several texts. Rows whose id is null are linked with nothing: component
    null, kept. An empty table gives an empty result; other columns are ignored.
    """
    similarity, least = percent / 100, _least_agreement(percent / 100)
    docs = id_text(df, id_col, text_col)
    features = materialise(docs.mapInArrow(tidy(_feature_batches(width, bands)), FEATURES), "features")
    full = features.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("key_a", "key_b", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    classes = materialise(classes, "classes")
    sketches = classes.select("node", "sketch", "bands")
    exploded = classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialise(exploded.join(shared, "bucket"), "members")
    central = members.groupBy("node").agg(F.sum("members").alias("meets"))
    leaders = members.join(central, "node").groupBy("bucket").agg(
        F.max(F.struct(F.col("meets"), (-F.col("node")).alias("low"), F.col("n"))).alias("x"))
    leaders = materialise(
        leaders.select("bucket", (-F.col("x.low")).alias("near"), F.col("x.n").alias("leader_n")), "leaders")
    star = (members.join(leaders, "bucket").filter("node <> near")
            .filter(F.least("n", "leader_n") >= similarity * F.greatest("n", "leader_n"))
            .select("node", "near").distinct())
    star = star.join(sketches.drop("bands"), "node").join(
        sketches.select(F.col("node").alias("near"), F.col("sketch").alias("leader_sketch")), "near")
    star = star.mapInArrow(tidy(_plausible_batches(least)), "node long, near long")
    links = _verified(materialise(star, "pairs"), docs, width, percent)
    several = full.groupBy("doc_id").agg(
        F.min(F.struct("key_a", "key_b")).alias("low"), F.max(F.struct("key_a", "key_b")).alias("high"))
    several = full.join(several.filter("low <> high").select("doc_id"), "doc_id", "left_semi")
    same_id = several.join(classes.select("key_a", "key_b", "node"), ["key_a", "key_b"]).filter("doc_id <> node").select(
        F.col("doc_id").alias("node"), F.col("node").alias("near"))
    links = materialise(links, "links")
    found = materialise(components(links), "components")

    # What the stars leave open: strays, outside their bucket's leading component.
    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    major = leaders.select("bucket", F.col("near").alias("node")).join(found, "node", "left").select(
        "bucket", F.coalesce("component", "node").alias("major"))
    placed = placed.join(major, "bucket")
    parts = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = placed.groupBy("bucket").agg(
        F.count_if(F.expr("component <> major")).alias("strays"), F.count("*").alias("members_now")).filter("strays > 0")
    mixed = mixed.select("bucket", parts(F.col("strays")).alias("rows"), parts(F.col("members_now")).alias("columns"))
    rest = placed.join(mixed, "bucket").withColumn("spread", F.xxhash64("node"))
    sides = [
        rest.filter("component <> major").withColumn("i", F.pmod("spread", "rows")).withColumn(
            "j", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("stray", F.lit(True)),
        rest.withColumn("j", F.pmod("spread", "columns")).withColumn(
            "i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("stray", F.lit(False)),
    ]
    sides = [x.selectExpr("bucket", "int(i) i", "int(j) j", "node", "n", "component", "major", "stray")
             for x in sides]
    blocks = sides[0].union(sides[1]).join(sketches, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    cross = blocks.mapInArrow(tidy(_cross_batches(least, similarity)), "node long, near long").distinct()
    more = _verified(materialise(cross, "pairs"), docs, width, percent)
    every = links.union(more).union(same_id)
    found = components(every)

    named = classes.join(found, "node", "left").select(
        "key_a", "key_b", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    linked = full.join(named, ["key_a", "key_b", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = features.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
