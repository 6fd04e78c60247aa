"""Quality classifier: perplexity under a Kneser-Ney model of trusted text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .charmodel import Model, characters, count_ngrams, read_symbols, train, train_spelling
from .textops import each_slice, text_numbers, tidy

PRIOR = 80  # characters at the mean loss that every text is given, so that short ones don't vary more


def _loss_batches(shared, spelling):
    def run(batches):
        table = None
        for batch, first, last, data, offsets in each_slice(batches):
            if table is None:
                table = shared.value.table()
            points, classes, point_offsets, keys, offsets = read_symbols(data, offsets)
            loss = np.bincount(text_numbers(offsets), -table[keys].astype(np.float64), minlength=last - first)
            text, context, character = characters(points, classes, point_offsets)
            loss -= np.bincount(text, spelling.log_shares(context, character), minlength=last - first)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first),
                batch.column("lang").slice(first, last - first),
                pa.array(np.diff(point_offsets)), pa.array(loss),
            ], ["doc_id", "lang", "n_symbols", "loss"])
    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good and never labelled bad or toxic."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    return (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.bool_and(good).alias("good"))
            .filter("good").select("doc_id"))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", quantile: float = 0.99, slack: float = 0.15, fitted: int | None = None) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, kept: one row per input row.

    The model is trained on all texts that `labels` (doc_id, quality, toxic)
    trusts, and thresholds come from all of them; only a caller who names
    `fitted` has the model fitted on the texts of so many ids, picked by hash.
    Ids and texts meet by a shuffle at any size, so that no task holds all ids
    and the cost of a text does not depend on how many there are.

    A text's perplexity is per character, repeated words included (they have a
    mark besides, whose loss counts), with PRIOR characters at the trusted
    mean added. It is kept if that is at most its language's threshold:
    the `quantile` of the trusted texts of that language, plus `slack` (as a
    share of the mean loss) for what a text outside the training data loses. A
    language without trusted texts, or null, takes the quantile over all.

    Null and empty texts have no characters and are kept, with the mean
    perplexity. Without trusted texts there is no model: perplexity and
    threshold are null and everything is kept. Rows whose id is null are scored
    but never trusted. Repeated rows count as often as they occur. Empty tables
    give an empty result; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).cast("string").alias("lang"))
    trusted = materialise(trusted_ids(labels), "trusted")
    learned = trusted
    if fitted is not None:
        learned = materialise(trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fitted), "fitted")
    texts = docs.select("doc_id", "text").join(learned.hint("shuffle_hash"), "doc_id", "left_semi")
    counts = materialise(count_ngrams(texts), "ngrams")
    if counts.isEmpty():
        nothing = F.lit(None).cast("double")
        return docs.select("doc_id", "lang", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_symbols"),
                           nothing.alias("perplexity"), nothing.alias("threshold"), F.lit(True).alias("kept"))
    shared = df.sparkSession.sparkContext.broadcast(Model(train(counts)))
    raw = docs.mapInArrow(tidy(_loss_batches(shared, train_spelling(counts))), "doc_id long, lang string, n_symbols long, loss double")
    raw = materialise(raw, "losses")
    known = raw.join(trusted, "doc_id", "left_semi")
    mean = known.agg(F.sum("loss") / F.greatest(F.sum("n_symbols"), F.lit(1))).first()[0] or 0.0
    smooth = (F.col("loss") + PRIOR * mean) / (F.col("n_symbols") + PRIOR)
    by_lang = known.groupBy("lang").agg(F.percentile_approx(smooth, quantile, 1000).alias("own"))
    overall = known.agg(F.percentile_approx(smooth, quantile, 1000)).first()[0]
    scored = raw.join(by_lang, raw["lang"].eqNullSafe(by_lang["lang"]), "left").drop(by_lang["lang"])
    limit = F.when(F.col("lang").isNull(), F.lit(overall)).otherwise(F.coalesce("own", F.lit(overall))) + slack * mean
    return scored.select("doc_id", "lang", "n_symbols", F.exp(smooth).alias("perplexity"),
                         F.exp(limit).alias("threshold"), (smooth <= limit).alias("kept"))
