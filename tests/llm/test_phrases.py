"""Phrase mining and its FM-index against plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from asterloom.llm.fm_index import BidirectionalIndex
from asterloom.llm import phrases as phrases_module
from asterloom.llm.phrases import count_phrases, mine_phrases


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain(rows, least, longest=5, best=2000):
    """The contract's result, from all phrases held in memory."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        for ws in pieces(text):
            total[lang] += len(ws)
            for m in range(1, longest + 1):
                found.update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, found in counts.items():
        cands = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cands.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, _, l, r = min(  # noqa: E741
                (1000 * a * total[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:best], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def shown(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_index_finds_every_phrase_with_its_extensions():
    rng = np.random.default_rng(4)
    for highest, n in ((3, 60), (9, 400), (300_000, 300)):
        sequence = np.concatenate([[0], rng.integers(0, highest + 1, n), [0]]).astype(np.int32)
        sequence[sequence > 300] %= 4
        sequence[5] = highest
        index = BidirectionalIndex(sequence, 5)
        phrases, plain_counts = index.words(), Counter()
        for m in range(1, 6):
            for i in range(len(sequence) - m + 1):
                if all(sequence[i : i + m]):
                    plain_counts[tuple(sequence[i : i + m].tolist())] += 1
        for length in range(1, 6):
            want = {p: c for p, c in plain_counts.items() if len(p) == length}
            assert dict(zip(map(tuple, phrases.words.tolist()), phrases.size.tolist())) == want
            grown = index.left(phrases) if length % 2 else index.right(phrases)
            # Either side gives the same phrases.
            other = index.right(phrases) if length % 2 else index.left(phrases)
            assert sorted(map(tuple, grown.words.tolist())) == sorted(map(tuple, other.words.tolist()))
            phrases = grown


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["the", "The", "of", "é", "new", "york", "city", "a'b", "x-y", "ÀB", "naïve"] + [f"w{k}" for k in range(40)]
    rows = []
    for k in range(400):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts += rng.choice([[rng.choice(words)], ["New", "York", "City"], ["of", "the"], ["on", "the", "one", "hand"], ["the", "the"]])
            parts.append(rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r\n", "!"]))
        rows.append((rng.choice(["en", "en", "de", None, ""]), "".join(p if p[:1] in " \t.,\n\r!" else p + " " for p in parts)))
    return [*rows, ("en", None), ("en", ""), (None, None), ("fr", "... ,, \n"), ("en", "the one the one the one " * 3000)]


@pytest.mark.parametrize("least, longest, best, shard", [(3, 5, 2000, 8 << 20), (8, 5, 10, 2000), (2, 3, 50, 500), (5, 2, 5, 1 << 20)])
def test_equals_plain_counts(spark, texts, least, longest, best, shard):
    """Nulls, empty and long texts, ties, several languages, clashing names, small and large shards."""
    df = spark.createDataFrame(texts, "lang string, text string").selectExpr("*", "1 as n", "'x' as word", "2 as shard")
    got = mine_phrases(df.repartition(4), least=least, longest=longest, best=best, shard_bytes=shard)
    assert shown(got) == plain(texts, least, longest, best)


def test_repeated_rows_and_other_names(spark):
    rows = [("en", "big apple pie"), ("en", "Big apple"), ("en", "apple pie, big")] * 4
    df = spark.createDataFrame(rows, "l string, t string")
    assert shown(mine_phrases(df, "t", "l", least=4)) == plain(rows, 4)


def test_exact_beyond_64_bits(spark):
    scored = spark.sql("select cast(90000000000000 as decimal(20,0)) _a, cast(100000000000000 as decimal(20,0)) _n, "
                       "cast(90000000000001 as decimal(20,0)) _l, cast(90000000000000 as decimal(20,0)) _r")
    assert scored.select(F.expr("(_a * _n * 1000BD) div (_l * _r)")).first()[0] == 10**17 // 90000000000001


def test_shards_send_a_list_for_each_part(spark, texts, monkeypatch):
    """Pairs and longer phrases don't travel as a row each, and none that holds a rare phrase travels at all."""
    sent, kept = {}, phrases_module.materialise

    def counting(df, label="step"):
        table = kept(df, label)
        sent.setdefault(label, []).append(table)
        return table

    monkeypatch.setattr(phrases_module, "materialise", counting)
    monkeypatch.setattr(phrases_module, "release", lambda *tables: None)
    df = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    count_phrases(df, least=8, shard_bytes=2000)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = sent["coded"][0].count()
    assert shards > 4 and len(sent["lists"]) == 4
    for found in sent["lists"]:
        assert 0 < found.filter("shard is not null").count() <= shards * parts
    # A phrase of a b a b with a rare a b a is not made.
    sequence, words = np.array([0, 1, 2, 1, 2, 0], np.int32), np.array([4, 9])
    key, part, n = phrases_module._phrases_of(sequence, words, 2, {}, 1)
    assert sorted(zip(key.tolist(), n.tolist())) == [((4 << 32) | 9, 2), ((9 << 32) | 4, 1)]
    answer = {2: [{"part": 0, "numbers": phrases_module.squeeze_numbers(np.array([3, 0]))}]}
    assert len(phrases_module._phrases_of(sequence, words, 3, answer, 1)[0]) == 0


def test_empty_and_rare(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert mine_phrases(empty).count() == 0
    assert mine_phrases(spark.createDataFrame([("en", "once only")], "lang string, text string")).count() == 0
    phrases, words, totals = count_phrases(spark.createDataFrame([("en", "a b a")], "lang string, text string"), least=1)
    assert totals.collect()[0]["n"] == 3 and words.count() == 2 and phrases.count() == 5
