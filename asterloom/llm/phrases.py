"""Collocations: phrases that are far more frequent than their parts make likely.

Texts are gathered to shards of a few MB of one language each. A shard numbers
its words and counts them; counts are summed over shards, and words that are
frequent enough get a number of their own, which goes back to the shards that
have them. Each shard then has an FM-index of its frequent words. Its pairs are
counted, summed and numbered in the same way, and from the phrases that are
frequent in all shards together the index goes on, one word longer each time, to
the left and to the right by turns, as long as a phrase is frequent without its
first word and without its last. No phrase that is frequent can be missed, as its
parts are at least as frequent. What a phrase needs besides its count, that of
its parts and of its extensions, is joined from the same table.

Most words and phrases of a shard are rare in all shards together, so they travel
as packed lists, one for each shard and part of all words or phrases. The answer
is a list in the same order: each one's number, or 0 for a rare one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, release
from .fm_index import BidirectionalIndex, Phrases
from .textops import BYTE_VALUE, INVERSE, LOWER, MULTIPLIER, U, each_slice, mix, powers, text_bytes, tidy

SHARD_BYTES = 4 << 20
PART_BYTES = 32 << 20  # of text for each part of all words or pairs
LONGEST = 5
LEAST = 100
UNKNOWN = "und"

WORD, BLANK, BREAK = 0, 1, 2
BYTE_KIND = np.full(256, WORD, np.uint8)
BYTE_KIND[[0x20, 0x09]] = BLANK
BYTE_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = BREAK

SHARD_COLUMNS = "shard long, lang string, part int, words binary, n binary, sequence binary"
SHARD_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("words", pa.binary()), ("n", pa.binary()),
    ("sequence", pa.binary()),
])
NUMBERED = pa.schema([
    ("shard", pa.int64()), ("part", pa.int32()), ("numbers", pa.binary()),
    ("lang", pa.string()), ("word", pa.string()), ("key", pa.int64()), ("a", pa.int64()),
])
NUMBERED_COLUMNS = "shard long, part int, numbers binary, lang string, word string, key long, a long"
SUMMED = pa.schema([
    ("shard", pa.int64()), ("part", pa.int32()), ("numbers", pa.binary()),
    ("head", pa.int64()), ("tail", pa.int64()), ("key", pa.int64()), ("a", pa.int64()),
])
SUMMED_COLUMNS = "shard long, part int, numbers binary, head long, tail long, key long, a long"


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def stretch(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def squeeze_numbers(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all next ones: the higher ones are mostly 0."""
    width = numbers.dtype.itemsize
    return squeeze(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, width).T).tobytes())


def stretch_numbers(blob: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(stretch(blob), np.uint8).reshape(width, -1).T).view(kind).ravel()


def _rows(schema: pa.Schema, many: int, **columns) -> pa.RecordBatch:
    """Rows with the named columns, the others null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(many, f.type) for f in schema], schema=schema)


def _edges(sorted_parts: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins, and the end."""
    return np.flatnonzero(np.concatenate([[True], sorted_parts[1:] != sorted_parts[:-1], [True]])) if len(sorted_parts) else np.zeros(1, int)


def _word_parts(words: pa.Array, parts: int) -> np.ndarray:
    """The part each word belongs to, by a hash of its bytes."""
    data, offsets = text_bytes(words)
    offsets = offsets - offsets[0]
    total = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUE[data] * powers(MULTIPLIER, len(data))[: len(data)], out=total[1:])
    starts, stops = offsets[:-1], offsets[1:]
    value = (total[stops] - total[starts]) * powers(INVERSE, len(data))[starts]
    return (mix(value + (stops - starts).astype(U), 5) % U(parts)).astype(np.int32)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and whether a piece of text begins with each."""
    data = LOWER[data]
    kind = BYTE_KIND[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind == WORD
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    del inside, edge
    text = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.cumsum(kind == BREAK, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    begins = np.ones(len(starts), bool)
    begins[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    del text, breaks, kind
    # Words and what lies between them by turns; every other one is taken.
    cuts = np.column_stack([starts, stops]).ravel()
    if not len(cuts):
        return pa.array([], pa.large_string()), begins
    raw = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
    return raw.take(pa.array(np.arange(0, len(cuts), 2))), begins


def _with_breaks(numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The numbers with a 0 before each piece and at the end."""
    out = np.zeros(len(numbers) + int(begins.sum()) + 1, np.int32)
    out[np.arange(len(numbers)) + np.cumsum(begins)] = numbers
    return out


def _shards(shard_bytes: int, parts: int):
    """Rows of two kinds: a shard's words of one part with their counts, and its sequence.

    A shard's words are numbered part by part, so that all its lists one after
    the other have them in order.
    """
    def run(batches):
        task = TaskContext.get()
        shard = (task.partitionId() if task else 0) << 33
        for whole in batches:
            whole = whole.take(pc.sort_indices(whole, sort_keys=[("lang", "ascending")]))
            langs = whole.column("lang").dictionary_encode()
            edges = np.flatnonzero(np.diff(langs.indices.to_numpy(), prepend=-1, append=-1)) if whole.num_rows else []
            for a, b in zip(edges, edges[1:]):
                lang = whole.column("lang")[int(a)].as_py()
                for _, _, _, data, offsets in each_slice([whole.slice(a, b - a)], shard_bytes):
                    words, begins = _words(data, offsets)
                    found = words.dictionary_encode()
                    local, many = found.indices.to_numpy(), len(found.dictionary)
                    if not many:
                        continue
                    part = _word_parts(found.dictionary, parts)
                    order = np.argsort(part, kind="stable")
                    place = np.empty(many, np.int32)
                    place[order] = np.arange(1, many + 1, dtype=np.int32)
                    counts = np.bincount(local, minlength=many)[order]
                    spelt = found.dictionary.cast(pa.large_binary()).take(pa.array(order)).to_pylist()
                    cuts = _edges(part[order])
                    yield _rows(
                        SHARD_SCHEMA, len(cuts) - 1, shard=np.full(len(cuts) - 1, shard), lang=[lang] * (len(cuts) - 1),
                        part=part[order][cuts[:-1]], words=[squeeze(b" ".join(spelt[x:y])) for x, y in zip(cuts, cuts[1:])],
                        n=[squeeze_numbers(counts[x:y]) for x, y in zip(cuts, cuts[1:])])
                    yield _rows(SHARD_SCHEMA, 1, shard=[shard], lang=[lang], sequence=[squeeze_numbers(_with_breaks(place[local], begins))])
                    shard += 1
    return run


def _gathered(batches) -> dict[int, list[dict]]:
    """All rows of the task by their part."""
    found: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            found.setdefault(row["part"], []).append(row)
    return found


def _numbers(before: int, many: int, part: int, parts: int) -> np.ndarray:
    """Numbers from 1 on that no other part gives."""
    if ((before + many) * parts) >> 32:
        raise ValueError("more than 2**32 numbers")
    return (before + np.arange(many, dtype=np.int64)) * parts + part + 1


def _number_words(least: int, parts: int):
    """For each list of words their numbers in its order; the frequent words; each language's words in all.

    A number is made of the part and of the word's place among its frequent words.
    """
    def run(batches):
        for part, rows in sorted(_gathered(batches).items()):
            before = 0
            for lang in sorted({r["lang"] for r in rows}):
                own = [r for r in rows if r["lang"] == lang]
                lists = [stretch(r["words"]).split(b" ") for r in own]
                cuts = np.cumsum([0, *map(len, lists)])
                found = pa.chunked_array([pa.array(x, pa.binary()) for x in lists]).combine_chunks().dictionary_encode()
                del lists
                at, words = found.indices.to_numpy(), found.dictionary
                sums = np.zeros(len(words), np.int64)
                np.add.at(sums, at, np.concatenate([stretch_numbers(r["n"], np.int64) for r in own]))
                often = np.flatnonzero(sums >= least)
                often = often[pc.sort_indices(words.take(pa.array(often))).to_numpy()]
                key = np.zeros(len(words), np.int64)
                key[often] = _numbers(before, len(often), part, parts)
                before += len(often)
                yield _rows(NUMBERED, 1, lang=[lang], a=[int(sums.sum())])
                yield _rows(NUMBERED, len(often), lang=[lang] * len(often), word=words.take(pa.array(often)).view(pa.string()),
                            key=key[often], a=sums[often])
                for r, x, y in zip(own, cuts[:-1], cuts[1:], strict=True):
                    yield _rows(NUMBERED, 1, shard=[r["shard"]], part=[part], numbers=[squeeze_numbers(key[at[x:y]])])
    return run


def _answer(lists: list[dict]) -> np.ndarray:
    """The numbers that all parts sent to a shard."""
    return np.concatenate([stretch_numbers(x["numbers"], np.int64) for x in sorted(lists, key=lambda x: x["part"])])


def _recode(batches):
    """A shard's sequence with its frequent words only, others as breaks, and the number of each."""
    for batch in batches:
        for row in range(batch.num_rows):
            sequence = stretch_numbers(batch.column("sequence")[row].as_py(), np.int32)
            key = _answer(batch.column("codes")[row].as_py())
            words = np.sort(key[key > 0])
            if not len(words):
                continue
            table = np.zeros(len(key) + 1, np.int32)
            table[1:][key > 0] = np.searchsorted(words, key[key > 0]) + 1
            sequence = table[sequence]
            # One break is as good as several; so are words that stand alone, as they begin no pair.
            near = np.zeros(len(sequence) + 1, bool)
            near[1:-1] = (sequence[1:] != 0) & (sequence[:-1] != 0)
            sequence = np.where(near[1:] | near[:-1], sequence, 0)
            kept = np.ones(len(sequence), bool)
            kept[1:] = (sequence[1:] != 0) | (sequence[:-1] != 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").slice(row, 1), pa.array([squeeze_numbers(sequence[kept])], pa.binary()),
                 pa.array([squeeze_numbers(words)], pa.binary())],
                ["shard", "sequence", "words"])


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in a sorted table, from 1 on; 0 if nowhere."""
    at = np.searchsorted(table, keys)
    return np.where(table[np.minimum(at, len(table) - 1)] == keys, at + 1, 0)


def _phrases_of(sequence: np.ndarray, words: np.ndarray, length: int, answers: dict[int, list[dict]], parts: int):
    """(key, part, n) of a shard's phrases of `length` words, by part and key.

    A key holds the numbers of the phrase without its last and without its first
    word, each below 2**32; `answers` has those numbers for each length before.
    """
    index = BidirectionalIndex(sequence, length)
    phrases = index.right(index.words())
    head, tail, numbers, tables = phrases.words[:, 0], phrases.words[:, 1], words, []
    for size in range(2, length + 1):
        key = (numbers[head - 1].astype(U) << U(32)) | numbers[tail - 1].astype(U)
        part = (mix(key, 6) % U(parts)).astype(np.int32)
        order = np.lexsort((key, part))
        if size == length:
            return key[order], part[order], phrases.size[order]
        number = np.empty(len(key), np.int64)
        number[order] = _answer(answers[size])
        often = np.flatnonzero(number)
        if not len(often):
            break
        # Frequent phrases of this size by what they are made of.
        base = len(numbers) + 1
        made = head[often] * base + tail[often]
        rank = np.argsort(made)
        tables.append((base, made[rank]))
        numbers = number[often][rank]
        phrases = phrases.only(often)
        phrases = index.right(phrases) if size % 2 else index.left(phrases)
        ids = list(phrases.words.T)
        for base, table in tables:
            ids = [_place(table, x * base + y) for x, y in zip(ids, ids[1:])]
        known = (ids[0] > 0) & (ids[1] > 0)
        phrases, head, tail = phrases.only(known), ids[0][known], ids[1][known]
    return np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int64)


def _lists(length: int, parts: int):
    """A shard's phrases of `length` words of one part and their counts."""
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                sequence = stretch_numbers(batch.column("sequence")[row].as_py(), np.int32)
                words = stretch_numbers(batch.column("words")[row].as_py(), np.int64)
                answers: dict[int, list[dict]] = {}
                for x in batch.column("answers")[row].as_py() if length > 2 else ():
                    answers.setdefault(x["length"], []).append(x)
                key, part, n = _phrases_of(sequence, words, length, answers, parts)
                n, cuts = n.astype(np.int32), _edges(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(cuts) - 1, batch.column("shard")[row].as_py(), np.int64)), pa.array(part[cuts[:-1]]),
                    pa.array([squeeze_numbers(np.diff(key[x:y], prepend=U(0))) for x, y in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([squeeze_numbers(n[x:y]) for x, y in zip(cuts, cuts[1:])], pa.binary())],
                    ["shard", "part", "keys", "n"])
    return run


def _sum_lists(least: int, parts: int):
    """For each list of phrases their numbers in its order; the frequent phrases."""
    def run(batches):
        for part, rows in sorted(_gathered(batches).items()):
            lists = [np.cumsum(stretch_numbers(r["keys"], U), dtype=U) for r in rows]
            cuts = np.cumsum([0, *map(len, lists)])
            key, at = np.unique(np.concatenate(lists), return_inverse=True)
            del lists
            sums = np.zeros(len(key), np.int64)
            np.add.at(sums, at, np.concatenate([stretch_numbers(r["n"], np.int32) for r in rows]))
            often = np.flatnonzero(sums >= least)
            number = np.zeros(len(key), np.int64)
            number[often] = _numbers(0, len(often), part, parts)
            yield _rows(SUMMED, len(often), head=(key[often] >> U(32)).astype(np.int64),
                        tail=(key[often] & U(0xFFFFFFFF)).astype(np.int64), key=number[often], a=sums[often])
            for r, x, y in zip(rows, cuts[:-1], cuts[1:], strict=True):
                yield _rows(SUMMED, 1, shard=[r["shard"]], part=[part], numbers=[squeeze_numbers(number[at[x:y]])])
    return run


def count_phrases(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): every run of 1 to `longest` words that a language has `least` times or more.

    phrases: words array<long>, a; words: lang, word, key; totals: lang, n, all
    words of the language. A-Z count as a-z, words are runs without blank and tab,
    and `.,;:!?` and line ends break a text into pieces that no phrase crosses.
    A null text is empty, a null language is `und`.

    A shard is texts of one language, about `shard_bytes`; a longer text is a
    shard of its own.
    """
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    shards = materialise(texts.mapInArrow(tidy(_shards(shard_bytes, parts)), SHARD_COLUMNS), "shards")
    lists = shards.filter("part is not null").select("shard", "lang", "part", "words", "n").repartition(parts, "part")
    numbered = materialise(lists.mapInArrow(tidy(_number_words(least, parts)), NUMBERED_COLUMNS), "numbered")
    totals = numbered.filter("shard is null and key is null").groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = numbered.filter("key is not null").select("lang", "word", "key", "a")
    codes = numbered.filter("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("part", "numbers")).alias("codes"))
    sequences = shards.filter("sequence is not null").select("shard", "sequence")
    coded = materialise(
        sequences.join(codes, "shard").select("shard", "sequence", "codes").mapInArrow(
            tidy(_recode), "shard long, sequence binary, words binary"), "coded")
    release(shards)
    known = frequent.select(F.array("key").alias("words"), "key", "a")
    phrases, steps, answers, rows = known.select("words", "a"), [], None, coded
    for length in range(2, longest + 1):
        if answers is not None:
            there = answers.groupBy("shard").agg(
                F.collect_list(F.struct("length", "part", "numbers")).alias("answers"), F.max("length").alias("_last"))
            rows = coded.join(there.filter(F.col("_last") == length - 1).drop("_last"), "shard")
        lists = rows.mapInArrow(tidy(_lists(length, parts)), "shard long, part int, keys binary, n binary").repartition(parts, "part")
        found = materialise(lists.mapInArrow(tidy(_sum_lists(least, parts)), SUMMED_COLUMNS), "lists")
        steps.append(found)
        answer = found.filter("shard is not null").select("shard", F.lit(length).alias("length"), "part", "numbers")
        answers = answer if answers is None else answers.unionAll(answer)
        # A phrase is what its head says and the last word of its tail.
        heads = known.select(F.col("key").alias("head"), F.col("words").alias("_head"))
        tails = known.select(F.col("key").alias("tail"), F.slice("words", -1, 1).alias("_tail"))
        spelt = found.filter("key is not null").join(heads, "head").join(tails, "tail")
        known = materialise(spelt.select(F.concat("_head", "_tail").alias("words"), "key", "a"), "known")
        phrases = phrases.unionAll(known.select("words", "a"))
    release(coded, *steps)
    return phrases, frequent.select("lang", "word", "key"), totals


def mine_phrases(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, best: int = 2000,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `best` collocations.

    Candidates are phrases of 2 to `longest` words found `least` times or more
    (a). Cut behind its first words, a candidate has parts found l and r times and
    the score floor(1000 * a * n / (l * r)), n all words of the language; the
    cut with the least score counts, then the one with the shorter first part.
    A candidate goes if a longer candidate holds it and is as frequent. Ranked
    by score, then a, both descending, then phrase by its bytes.

    Products are decimal numbers of 38 digits, exact for up to 10^17 words.
    Texts, languages and nulls as in `count_phrases`. An empty table, or one
    without frequent phrases, gives no rows; repeated rows count each; other
    columns are ignored.
    """
    phrases, words, totals = count_phrases(df, text_col, lang_col, least, longest, shard_bytes)
    several = phrases.filter(F.size("words") > 1)
    # A longer phrase as frequent as this one is also one longer by a single word.
    last = F.size("words") - 1
    inner = several.filter(F.size("words") > 2)
    extended = inner.select(F.slice("words", 1, last).alias("words"), "a").unionAll(
        inner.select(F.slice("words", 2, last).alias("words"), "a")
    ).groupBy("words").agg(F.max("a").alias("_most"))
    kept = several.join(extended, "words", "left").filter(F.col("_most").isNull() | (F.col("_most") < F.col("a"))).drop("_most")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn(
        "tail", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    heads = phrases.select(F.col("words").alias("head"), F.col("a").alias("l"))
    tails = phrases.select(F.col("words").alias("tail"), F.col("a").alias("r"))
    langs = words.select(F.col("key").alias("_first"), "lang").join(totals, "lang")
    cuts = cuts.join(heads, "head").join(tails, "tail").withColumn("_first", F.element_at("words", 1)).join(langs, "_first")
    wide = [F.col(c).cast("decimal(20,0)").alias(f"_{c}") for c in ("a", "n", "l", "r")]
    scored = cuts.select("*", *wide).withColumn("score", F.expr("(_a * _n * 1000BD) div (_l * _r)"))
    chosen = scored.groupBy("lang", "words").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("lang", "words", "a", "n", "cut.l", "cut.r", "cut.score")
    # Ties at the end stay until their phrases decide.
    by_number = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = chosen.withColumn("_rank", F.rank().over(by_number)).filter(F.col("_rank") <= best).drop("_rank")
    spelt = first.select("words", F.posexplode("words").alias("_at", "key")).join(words.select("key", "word"), "key")
    spelt = spelt.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_spelt"))
    named = first.join(spelt, "words").withColumn("phrase", F.array_join(F.col("_spelt.word"), " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
