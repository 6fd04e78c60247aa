"""The character model: every character of a text counts, as the one it is."""

from __future__ import annotations

import collections
import math
import random

import numpy as np

from asterloom.llm import charmodel, spelling
from asterloom.llm.quality import score_quality


def read(*texts):
    raw = [t.encode() for t in texts]
    return charmodel.read_symbols(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))


def test_repeated_words_keep_their_characters():
    """A mark stands before them, in their place stand all their characters."""
    texts = ["go go go on", "he said he said é é", "", "said", "said so"]
    _, _, point_offsets, keys, offsets = read(*texts)
    last = keys & 63
    table = charmodel.symbol_table()
    for k, text in enumerate(texts):
        symbols = last[offsets[k] : offsets[k + 1]]
        assert symbols[symbols != charmodel.REPEAT].tolist() == [table[ord(c)] for c in text]
    assert np.diff(point_offsets).tolist() == [len(t) for t in texts]
    marks = [int((last[a:b] == charmodel.REPEAT).sum()) for a, b in zip(offsets, offsets[1:])]
    assert marks == [2, 2, 0, 0, 0]
    assert read("a a")[4].tolist() == [0, 4]  # however few words a slice has


def test_every_character_is_scored(spark):
    rows = [(1, "the cat sat on the mat. " * 20, "en"), (2, "ha ha ha ha ha ha", "en"), (3, "the cat the cat the cat", None), (None, "\U0001f600 中", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    assert {i: r.n_symbols for i, r in got.items()} == {i: len(t) for i, t, _ in rows}
    assert got[1].kept and not got[2].kept


def class_of(c):
    return int(charmodel.symbol_table(ord(c) >> 16)[ord(c) & 0xFFFF])


def test_shares_of_a_class_are_those_of_the_formula(spark, monkeypatch):
    """Over real characters of all planes, and however many blocks the model is dealt into."""
    texts = ["Élan vital: 12 élans, 中文的文中文", "Über 1999 中文!", "", "\U00020000\U0001d400 中文 \U00020000\U00020001", "ἀγορά καὶ ἀγών 12\t12"] * 2 + ["Élan 中的"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    alone = {c for c in map(chr, range(128)) if class_of(c) in charmodel.ALONE}
    counts = {4: collections.Counter()}
    for t in texts:
        for k, c in enumerate(t):
            if c not in alone:
                counts[4][(("<",) * 3 + tuple(t[:k]))[-3:] + (c,)] += 1
    for level in (3, 2, 1):
        counts[level] = collections.Counter(k[1:] for k in counts[level + 1])

    def discount(level, n):
        seen = collections.Counter(counts[level].values())
        y = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] else 0.5
        k = min(n, 3)
        return min(max(k - (k + 1) * y * (seen[k + 1] / seen[k] if seen[k] else 0), 0.1), k, n)

    def share(level, gram):
        if not level:
            return 1 / charmodel.class_sizes()[class_of(gram[0])]
        gram = gram[-level:]
        followers = {k: n for k, n in counts[level].items() if k[:-1] == gram[:-1] and class_of(k[-1]) == class_of(gram[-1])}
        wider = share(level - 1, gram if level == 1 else gram[1:])
        if not followers:
            return wider
        n = followers.get(gram, 0)
        taken = sum(discount(level, n) for n in followers.values())
        return ((n - discount(level, n) if n else 0) + taken * wider) / sum(followers.values())

    asked = ["Élan 中文的\U00020001", "\U0001d401文文文 99 Ἀ", "ÜÜ\t中", ""]
    points, classes, offsets, _, _ = read(*asked)
    text, context, character = charmodel.characters(points, classes, offsets)
    expected = [(k, share(4, (("<",) * 3 + tuple(t[:i]))[-3:] + (c,))) for k, t in enumerate(asked) for i, c in enumerate(t) if c not in alone]
    assert text.tolist() == [k for k, _ in expected]
    for size, blocks in ((spelling.BLOCK, 1), (40, None)):
        monkeypatch.setattr(spelling, "BLOCK", size)
        model = charmodel.train_spelling(charmodel.count_ngrams(df))
        assert len(model.blocks) == blocks if blocks else len(model.blocks) > 4
        assert np.allclose(model.log_shares(context, character), [math.log(p) for _, p in expected], rtol=1e-4)


def test_no_character_stands_for_another(spark):
    """Scrambled text of one class, and of another plane, isn't as good as what was learned."""
    rng = random.Random(4)
    words = {"zh": ["今天", "天气", "很好", "我们", "学习", "中文", "大家", "高兴"], "el": ["ἀγορά", "λόγος", "φίλος", "πόλις", "δῆμος"],
             "xx": ["\U00020001\U00020002", "\U00020003\U00020004\U00020005", "\U00020006\U00020007"]}
    rows, labels = [], []
    for lang, some in words.items():
        for k in range(30):
            text = "".join(rng.choice(some) for _ in range(200))
            if k == 0:
                text = "".join(rng.sample(text, len(text)))
            else:
                labels.append((len(rows), 1, 0))
            rows.append((len(rows), text, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.doc_id) if not r.kept] == [0, 30, 60]


def test_counts_of_characters_are_sent_on(monkeypatch):
    """In parts, without losing any."""
    monkeypatch.setattr(spelling, "HELD", 3)
    counts, sent = spelling.Counts(), collections.Counter()
    rng = np.random.default_rng(1)
    given = rng.integers(0, 4, (2, 6, 10))
    for context, character in zip(*given):
        for part in counts.add(context, character):
            for a, b, n in zip(*part):
                sent[int(a), int(b)] += int(n)
    for part in counts.rest():
        for a, b, n in zip(*part):
            sent[int(a), int(b)] += int(n)
    assert sent == collections.Counter(zip(*given.reshape(2, -1).tolist()))
