"""Data selection by cross-entropy difference.

Two word-bigram models, one of target text and one of all text, share one
vocabulary and one smoothing; a document's score is its mean loss per token
under the target model less that under the background model, the document's own
counts taken out of both. Lower is more like the target.

All words and all bigrams are counted, in a table keyed by n-gram. A document's
n-grams are joined with it; frequent ones, which would make hot keys, are looked
up in a copy of bounded size that every task has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, release
from .textops import U, Words, each_slice, mix, tidy

STRENGTH = 50.0  # unigram counts worth this many tokens are added to each context
CACHED = 1 << 19  # n-grams at most that go to every task
HELD = 1 << 18  # distinct n-grams that a task holds before it sends their sums on
AT_ONCE = 1 << 17  # rows in a batch of sums
START = U(0x5851F42D4C957F2D)  # stands before the first word of a text
SUMS = ("target", "background", "target_after", "background_after", "texts")
MISSING = ("a_t", "a_b", "c_t", "c_b")


def word_keys(words: np.ndarray) -> np.ndarray:
    return mix(words, 61)


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(before, 62) + words, 63)


def _counted(text: np.ndarray, values: np.ndarray, *also: np.ndarray):
    """Distinct (text, value) with one sum for each of `also`, and for every element its row there."""
    order = np.lexsort((values, text))
    t, v = text[order], values[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    row = np.empty(len(t), np.int64)
    row[order] = np.cumsum(new) - 1
    return t[at], v[at], [np.bincount(row, x, minlength=len(at)).astype(np.int64) for x in also], row, order[at]


def text_ngrams(words: Words) -> tuple:
    """Distinct words and bigrams of every text.

    Words: text, word, count as a word, count as what another word follows.
    Bigrams: text, key, count, word, and the word's row among the former.
    """
    n, first = len(words.hash), words.first[words.counts > 0]
    before = np.empty(n, U)
    before[1:] = words.hash[:-1]
    before[first] = START
    text, word, (own, after), row, _ = _counted(
        np.concatenate([words.text, words.text]), np.concatenate([words.hash, before]), np.repeat([1, 0], n), np.repeat([0, 1], n))
    p_text, pair, (count,), _, at = _counted(words.text, pair_keys(before, words.hash), np.ones(n, np.int64))
    return (text, word, own, after), (p_text, pair, count, words.hash[at], row[at])


def _summed(held: list[tuple]) -> tuple:
    key, at, row = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
    word, is_pair = (np.concatenate([h[k] for h in held])[at] for k in (1, 2))
    return key, word, is_pair, *(
        np.bincount(row, np.concatenate([h[3 + k] for h in held]), minlength=len(key)).astype(np.int64) for k in range(len(SUMS)))


def _count_batches(batches):
    """Words and bigrams with their counts, summed within the task."""
    def sent(rows: tuple):
        for x in range(0, len(rows[0]), AT_ONCE):
            part = [column[x : x + AT_ONCE] for column in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0].view(np.int64)), pa.array(part[1].view(np.int64)), *(pa.array(x) for x in part[2:])],
                ["key", "word", "is_pair", *SUMS])

    held: list[tuple] = []
    for batch, first, last, data, offsets in each_slice(batches):
        (text, word, own, after), (p_text, pair, count, p_word, _) = text_ngrams(Words(data, offsets))
        target = np.asarray(batch.column("target").slice(first, last - first).to_pylist(), np.int64)
        zero = np.zeros(len(pair), np.int64)
        held.append(_summed([
            (word_keys(word), word, np.zeros(len(word), bool), own * target[text], own, after * target[text], after, np.ones(len(word), np.int64)),
            (pair, p_word, np.ones(len(pair), bool), count * target[p_text], count, zero, zero, np.ones(len(pair), np.int64))]))
        if sum(len(h[0]) for h in held) > HELD:
            held = [_summed(held)]
            if len(held[0][0]) > HELD // 2:  # a new slice has room for as many
                yield from sent(held.pop())
    if held:
        yield from sent(_summed(held))


class Frequent:
    """The n-grams that every task looks up itself, and the models' totals."""

    def __init__(self, rows: pa.Table, totals: tuple[float, float, float]):
        key = rows.column("key").to_numpy().astype(np.int64).view(U)
        order = np.argsort(key)
        self.key, self.totals = key[order], totals
        self.counts = [rows.column(n).to_numpy().astype(np.int64)[order] for n in MISSING]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        if not len(self.key):
            return np.zeros(len(keys), bool), [np.zeros(len(keys), np.int64) for _ in self.counts]
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        return self.key[at] == keys, [x[at] for x in self.counts]


def shares(target, background, own, tokens, inside, totals):
    """Both models' smoothed shares of a word without the document's own counts."""
    t_total, b_total, size = totals
    return ((target - own * inside + 0.5) / (t_total - tokens * inside + 0.5 * size),
            (background - own + 0.5) / (b_total - tokens + 0.5 * size))


def word_loss(counts: list, own, after, tokens, inside, totals):
    """What a word adds to a text's loss: its share for each time it stands there, its total for each that follows it."""
    t, b, t_after, b_after = counts
    t_share, b_share = shares(t, b, own, tokens, inside, totals)
    return own * np.log(b_share / t_share) + after * np.log(
        (t_after - after * inside + STRENGTH) / (b_after - after + STRENGTH))


def pair_loss(counts: list, count, own, tokens, inside, totals):
    """What a bigram that other texts have too changes in it."""
    t, b, t_word, b_word = counts
    t_share, b_share = shares(t_word, b_word, own, tokens, inside, totals)
    return count * (np.log1p((b - count) / (STRENGTH * b_share)) - np.log1p((t - count * inside) / (STRENGTH * t_share)))


NGRAM = "row long, key long, kind int, n int, own int, tokens int, inside int, loss double"


def _ngram_batches(shared):
    def run(batches):
        """A row for each text with the loss of its frequent n-grams; a row for each of its others."""
        frequent = shared.value
        for batch, first, last, data, offsets in each_slice(batches):
            words, n = Words(data, offsets), last - first
            (text, word, own, after), (p_text, pair, count, _, at) = text_ngrams(words)
            inside = np.asarray(batch.column("target").slice(first, n).to_pylist(), np.int64)
            row = np.asarray(batch.column("row"))[first:last]
            tokens, key = words.counts.astype(np.int64), word_keys(word)
            known, found = frequent.find(key)
            p_known, p_found = frequent.find(pair)
            w, p, k = known, p_known, text[known]
            loss = np.bincount(k, word_loss([x[w] for x in found], own[w], after[w], tokens[k], inside[k], frequent.totals), minlength=n)
            k = p_text[p]
            loss += np.bincount(k, pair_loss([x[p] for x in p_found], count[p], own[at[p]], tokens[k], inside[k], frequent.totals), minlength=n)
            w, p = ~known, ~p_known
            texts = np.concatenate([np.arange(n), text[w], p_text[p]])
            kind = np.repeat([0, 1, 2], [n, w.sum(), p.sum()])
            yield pa.RecordBatch.from_arrays([
                pa.array(row[texts]), pa.array(np.concatenate([row, key[w].view(np.int64), pair[p].view(np.int64)])),
                *(pa.array(x.astype(np.int32)) for x in (
                    kind, np.concatenate([np.ones(n), after[w], count[p]]), np.concatenate([np.zeros(n), own[w], own[at[p]]]),
                    tokens[texts], inside[texts])),
                pa.array(np.concatenate([loss, np.zeros(len(texts) - n)]))], [x.split()[0] for x in NGRAM.split(", ")])
    return run


def _loss_batches(totals: tuple):
    def run(batches):
        """(row, loss, copies, tokens) of the joined rows."""
        for batch in batches:
            c = {n: np.asarray(batch.column(n)) for n in ("row", "kind", "n", "own", "tokens", "inside", "loss", *MISSING)}
            loss = c["loss"].copy()
            for kind, of in ((1, lambda x, k: word_loss(x, c["own"][k], c["n"][k], c["tokens"][k], c["inside"][k], totals)),
                             (2, lambda x, k: pair_loss(x, c["n"][k], c["own"][k], c["tokens"][k], c["inside"][k], totals))):
                k = np.flatnonzero(c["kind"] == kind)
                loss[k] = of([c[n][k] for n in MISSING], k)
            copies = c["kind"] == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["row"]), pa.array(loss), pa.array(copies.astype(np.int64)), pa.array(np.where(copies, c["tokens"], 0).astype(np.int64))],
                ["row", "loss", "copies", "tokens"])
    return run


def score_difference(df: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, score: one row per input row.

    `target_ids` (doc_id) names the target texts; the background is every row.
    Every word and every bigram counts, by 64-bit hash. Bigrams that one text
    alone has are nothing once its own counts are out, so they aren't kept. The
    CACHED most frequent n-grams at most go to every task, which spares their
    rows in the join and changes no score.

    Texts that are null, empty or without words have no tokens and a null
    score. Without target texts the target model is the smoothing alone. Null
    ids are scored but never targets; repeated rows count each time; an empty
    table gives an empty result. Other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = df.sparkSession
    chosen = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    # Rows of one id and text have one score, so they may share a number.
    marked = docs.join(chosen, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"),
        F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("row"))
    kinds = "key long, word long, is_pair boolean, " + ", ".join(f"{n} long" for n in SUMS)
    counts = marked.select("text", "target").mapInArrow(tidy(_count_batches), kinds)
    counts = counts.groupBy("key", "word", "is_pair").agg(*(F.sum(n).alias(n) for n in SUMS))
    counts = materialise(counts.filter("not is_pair or texts > 1"), "counts")
    words = counts.filter("not is_pair")
    totals = tuple(float(x or 0) for x in words.agg(F.sum("target"), F.sum("background"), F.count("*")).first())
    of_word = words.select("word", F.col("target").alias("c_t"), F.col("background").alias("c_b"))
    table = counts.filter("is_pair").join(of_word, "word").select(
        "key", F.col("target").alias("a_t"), F.col("background").alias("a_b"), "c_t", "c_b", "texts")
    table = materialise(table.union(words.select(
        "key", "target", "background", F.col("target_after"), F.col("background_after"), "texts")), "ngrams")
    release(counts)
    # The least count of texts, in steps of a tenth, from which n-grams are few enough.
    step = F.floor(F.log(F.col("texts").cast("double")) * 10)
    least, n = None, 0
    for at, members in sorted(table.groupBy(step.alias("at")).count().collect(), reverse=True):
        n += members
        if n > CACHED:
            break
        least = at
    frequent = table.filter(step >= least) if least is not None else table.limit(0)
    shared = spark.sparkContext.broadcast(Frequent(frequent.select("key", *MISSING).toArrow(), totals))
    rest = marked.select("row", "text", "target").mapInArrow(tidy(_ngram_batches(shared)), NGRAM)
    joined = rest.join(table.select("key", *MISSING), "key", "left").filter("kind = 0 or a_b is not null")
    joined = joined.select("row", "kind", "n", "own", "tokens", "inside", "loss", *(F.coalesce(c, F.lit(0)).alias(c) for c in MISSING))
    found = joined.mapInArrow(tidy(_loss_batches(totals)), "row long, loss double, copies long, tokens long").groupBy("row").agg(
        F.sum("loss").alias("loss"), F.sum("copies").alias("copies"), F.sum("tokens").alias("tokens"))
    # The text stays behind: only ids and numbers are joined with the sums.
    return marked.select("doc_id", "row").join(found, "row").select(
        "doc_id", (F.col("tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        F.when(F.col("tokens") > 0, F.col("loss") / F.col("tokens")).alias("score"))
