"""op10: distinct words are encoded once, and both ways of cutting texts give the library's ids."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest

from asterloom.llm import bpe

files = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("tokenizers")

TEXTS = ["Word, other word.", "word! OTHER (word)", None, "", "ΑΣ Σ. é", "a<|endoftext|>b word", "x\x1cy 1234 we've 'd", "\U0001f600 가"]


def content() -> str:
    with open(files.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def encoded(text: str, batches: list[list]) -> list[tuple]:
    rows = []
    for texts in batches:
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
        for done in bpe._encode_batches(text)([batch]):
            rows += zip(done.column("token_ids").to_pylist(), done.column("decoded").to_pylist(), strict=True)
    return rows


def test_a_word_is_encoded_once_whatever_stands_around_it(monkeypatch):
    asked = []
    encode = bpe.Vocabulary.encode_words
    monkeypatch.setattr(bpe.Vocabulary, "encode_words", lambda self, words: asked.extend(words) or encode(self, words))
    text = content() + " "  # a vocabulary that no other test has taught
    encoded(text, [[f"zyxwv{mark} {mark}Zyxwv" for mark in ".,;"], ["zyxwv! zyxwv?", "ZYXWV"], ["(zyxwv) zyxwv-zyxwv"]])
    assert asked.count("zyxwv") + asked.count("zyxwv</w>") == 1


@pytest.mark.parametrize("pattern", [None, r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\p{Z}{9}"])
def test_ids_are_those_of_the_library(pattern):
    spec = json.loads(content())
    if pattern:
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = pattern
    text = json.dumps(spec)
    assert isinstance(bpe.lasting_ids(text)[0], bpe.TextIds if pattern else bpe.TrieIds)
    known = library.Tokenizer.from_str(text)
    for (ids, decoded), source in zip(encoded(text, [TEXTS]), TEXTS, strict=True):
        want = known.encode(source or "", add_special_tokens=False).ids
        assert list(np.array(ids)) == want
        assert decoded == known.decode(want, skip_special_tokens=False)
