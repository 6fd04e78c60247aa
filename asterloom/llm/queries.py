"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from .bpe import digests, encode_decode
from .conversations import damaged, repair_conversations, summaries
from .decontam import contaminated
from .exact_substrings import remove_repeats
from .html_text import extract_main_text
from .langid import predict_languages, train_languages
from .lm_scores import score_difference
from .near_dups import near_duplicates
from .packing import pack, token_pieces
from .passages import near_passages
from .phrases import mine_phrases
from .quality import score_quality, trusted_ids
from .topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of texts with Jaccard 0.85 or more over three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage's place."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document against its language's threshold."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    import public_tokenizers

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def held_out() -> Column:
    """One document in three, by the checksum of its id, is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents not held out."""
    docs = table(spark, sf_dir, "documents")
    decoder = train_languages(docs.filter(~held_out()))
    found = predict_languages(docs, decoder)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows with the highest inner product for every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op8_exact_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
r as (
  select query_id, vec_id, score,
    cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
"""


@query
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between trusted text and all text."""
    return score_difference(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))


@query
def op2_exact_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 100-byte strings seen before."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document also has, nearly or fully."""
    return near_passages(table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the edits that repair it."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    return summaries(repair_conversations(rows, lost=F.col("lost")))


@query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of at most 2048 tokens and their places in packed sequences."""
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    return mine_phrases(table(spark, sf_dir, "documents"))


SQL["op11_phrases"] = r"""
with texts as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
words as (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
grams as (
  select lang, ws[i : i + m - 1] as g from (
    select lang, ws, m, unnest(range(1, len(ws) - m + 2)) as i
    from words, (select unnest(range(1, 6)) as m) where len(ws) >= m)),
f as (select lang, g, count(*) as c from grams group by lang, g),
total as (select lang, sum(len(ws)) as n from words group by lang),
cand as (select lang, g, c as a from f where len(g) >= 2 and c >= 100),
longer as (
  select lang, h, max(a) as most from (
    select lang, g[1 : len(g) - 1] as h, a from cand union all select lang, g[2 : len(g)] as h, a from cand) group by lang, h),
kept as (
  select c.* from cand c left join longer x on x.lang = c.lang and x.h = c.g where x.most is null or x.most < c.a),
cuts as (
  select k.lang, k.g, k.a, k.k, h.c as l, t.c as r, total.n,
    (1000::hugeint * k.a * total.n) // (h.c::hugeint * t.c) as score
  from (select *, unnest(range(1, len(g))) as k from kept) k
  join f h on h.lang = k.lang and h.g = k.g[1 : k.k]
  join f t on t.lang = k.lang and t.g = k.g[k.k + 1 : len(k.g)]
  join total on total.lang = k.lang),
scored as (select *, row_number() over (partition by lang, g order by score, k) as nth from cuts),
ranked as (
  select *, array_to_string(g, ' ') as phrase,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank
  from scored where nth = 1)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
  cast(n as bigint) as n, cast(score as bigint) as score
from ranked where rank <= 2000
"""
