"""Packing against the best packings of small cases and the library's token ids."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from asterloom.llm.packing import best_fit, complete_bins, fillings, lower_bound, pack, token_pieces
from asterloom.llm.queries import QUERIES
from asterloom.llm.textops import each_slice
from asterloom.llm.word_ids import WordIds

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def ours():
    with open(VOCABULARY, encoding="utf-8") as f:
        words = WordIds(f.read())

    def encode(texts, size=1 << 16):
        out = []
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        for _, _, _, data, offsets in each_slice([batch], size):
            ids, counts = words.encode(data, offsets)
            out += [ids[e - n : e].tolist() for e, n in zip(np.cumsum(counts), counts)]
        return out

    return encode


def test_ids_are_those_of_the_library(library, ours):
    """Odd letters, joined marks, contractions, blanks of all kinds, special tokens, whole planes."""
    rng = random.Random(2)
    letters = [
        *"abzAZ09'’.,!?<|>-_ \t\n\r\x1c\x85\xa0", "é", "É", "ß", "ı", "İ", "Σ", "ς", "ǅ", "ﬁ", "½", "²", "٣", "漢", "한", "ᄀ", "ᅡ",
        "́", "ͅ", " ", "﻿", "‍", "\U0001f600", "\U00010400", "'s", "'t", "'RE", "'ve", "'LL", "'d", "'m", "''s",
        "<|endoftext|>", "<|startoftext|>", "<|", "",
    ]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(15_000)]
    spans = (0x250, 0x3000, 0xD800)
    texts += ["".join(chr(rng.randrange(rng.choice(spans))) for _ in range(rng.randint(1, 12))) for _ in range(15_000)]
    assert ours(texts) == library(texts)


def test_ids_of_the_given_texts(library, ours):
    texts = pq.read_table(f"{FOLDER}/documents.parquet").column("text").to_pylist()
    assert ours(texts) == library(texts)
    assert ours(["", "a" * 300_000, "no. " * 50_000]) == library(["", "a" * 300_000, "no. " * 50_000])


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for j in {room: j for j, room in enumerate(rooms) if room >= items[k]}.values():
            rooms[j] -= items[k]
            go(k + 1, rooms)
            rooms[j] += items[k]
        rooms.append(capacity - items[k])
        go(k + 1, rooms)
        rooms.pop()

    go(0, [])
    return best[0]


def holds(packing, counts, capacity):
    got = Counter()
    for filling, times in packing:
        assert times > 0 and sum(s * n for s, n in filling) <= capacity
        got.update({s: n * times for s, n in filling})
    return got == Counter(counts)


def test_small_cases_are_packed_best():
    rng, better = random.Random(3), 0
    for _ in range(300):
        capacity = rng.choice([10, 20, 50, 100])
        low, high = rng.choice([(1, capacity), (capacity // 5, capacity // 2)])
        items = [rng.randint(low, high) for _ in range(rng.randint(0, 11))]
        counts = dict(Counter(items))
        packing, first = complete_bins(counts, capacity, 20_000), best_fit(counts, capacity)
        assert holds(packing, counts, capacity) and holds(first, counts, capacity)
        assert sum(n for _, n in packing) == fewest(items, capacity) >= lower_bound(counts, capacity)
        better += sum(n for _, n in first) > sum(n for _, n in packing)
    assert better  # the search does find what best fit misses


def test_fillings_are_undominated():
    found = list(fillings({7: 1, 5: 1, 4: 2, 3: 1, 1: 3}, 8, 8))
    assert found[0] == (0, ((7, 1), (1, 1)))
    # 4 + 4 is better than 4 + 3 + 1: a 4 can take the place of both.
    assert (0, ((4, 2),)) in found and (0, ((4, 1), (3, 1), (1, 1))) not in found
    assert all(sum(s * n for s, n in f) + waste == 8 for waste, f in found)


def test_huge_counts():
    """A third of all pieces with one length; the work depends on the lengths, not on the counts."""
    counts = {2048: 10**12, 1500: 10**12 + 1, 548: 10**12, 3: 7}
    packing = complete_bins(counts, 2048)
    assert holds(packing, counts, 2048) and len(packing) < 10
    assert sum(n for _, n in packing) == 2 * 10**12 + 1


def check_places(rows, capacity):
    places = {}
    for r in rows:
        assert 1 <= r["length"] <= capacity
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_whole_table(spark, library):
    rows = [r.asDict() for r in QUERIES["op13_best_fit_packing"](spark, FOLDER).collect()]
    want, total = [], 0
    table = pq.read_table(f"{FOLDER}/documents.parquet")
    for doc, ids in zip(table.column("doc_id").to_pylist(), library([t or "" for t in table.column("text").to_pylist()])):
        ids = [*ids, 0]
        total += len(ids)
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want.append((doc, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    counts = dict(Counter(r["length"] for r in rows))
    assert check_places(rows, 2048) == sum(n for _, n in complete_bins(counts, 2048))
    assert lower_bound(counts, 2048) <= check_places(rows, 2048) <= -(-total // 2048) * 1.01 + 1


def test_null_empty_repeated_and_long_texts(spark, library):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (2, ""), (3, "x" * 9000), (4, "long text. " * 3000), (4, "long text. " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as length", "2 as sequence_id")
    pieces = token_pieces(df.repartition(3), VOCABULARY, 500)
    got = [r.asDict() for r in pack(pieces, 500).collect()]
    want = []
    for doc, text in rows:
        ids = [*library([text or ""])[0], 0]
        want += [(doc, k // 500, k, np.array(ids[k : k + 500], "<u4").tobytes()) for k in range(0, len(ids), 500)]
    assert sorted(((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in got), key=repr) == sorted(want, key=repr)
    check_places(got, 500)
    assert all(r["length"] * 4 == len(r["ids"]) for r in got)


def test_one_length_and_clashing_names(spark):
    """All pieces of one length, in few and in many partitions; other columns stay."""
    df = spark.range(5000).selectExpr("id", "700L as length", "5 as offset", "'s' as sequence_id", "id as rank", "id as _part", "1 as `_a b`")
    for n in (1, 40):
        got = [r.asDict() for r in pack(df.repartition(n), 2048).collect()]
        assert sorted(r["id"] for r in got) == list(range(5000)) and check_places(got, 2048) == 2500
        assert set(got[0]) == {"id", "length", "rank", "_part", "_a b", "sequence_id", "offset"}
        assert all(r["id"] == r["rank"] == r["_part"] for r in got)
    with pytest.raises(Exception, match="from 1 to 2048"):
        pack(df.selectExpr("id", "id as length")).count()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(token_pieces(docs, VOCABULARY)).count() == 0
