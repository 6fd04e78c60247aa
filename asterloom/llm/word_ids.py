"""Token ids of whole texts, word by distinct word, by the public tokenizers library.

The texts of a slice are cut into words as arrays of code points; the library's
model is asked once for each distinct word and the ids are gathered. A text with
characters whose normal form or lower case is not one character by itself, or
with a special token's name, goes to the library as a whole.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

CACHED_WORDS = 400_000  # a worker forgets its words beyond twice this; ids don't depend on it
OTHER, LETTER, NUMBER, SPACE, ODD = range(5)
KNOWN_POINTS = 0x30000
# The text rules of the vocabulary file that are spelt out here.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
RULES = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others, in order, for the
    characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=1)
def point_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of every code point; unusual ones are ODD."""
    chars = [chr(c) for c in range(KNOWN_POINTS) if not 0xD800 <= c < 0xE000]
    whole = "".join(chars)
    kind = np.full(KNOWN_POINTS + 1, OTHER, np.uint8)
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        kind[[ord(c) for c in regex.findall(pattern, whole)]] = value
    lower = np.arange(KNOWN_POINTS + 1, dtype=np.uint32)
    for c in chars:
        small = c.lower()
        if len(small) == 1:
            lower[ord(c)] = ord(small)
        # Characters this Unicode version doesn't know may have another class in the library.
        if len(small) != 1 or unicodedata.category(c) in ("Cn", "Mn", "Mc", "Me") or not unicodedata.is_normalized("NFC", c):
            kind[ord(c)] = ODD
    kind[0x1100:0x1200] = ODD  # Hangul letters join with each other
    kind[KNOWN_POINTS] = ODD
    return kind, lower


class WordIds:
    """Token ids by a word-level BPE vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        found = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])], [x["type"] for x in steps]
        if spec["model"]["type"] != "BPE" or found != RULES or steps[0]["pattern"].get("Regex") != WORD_PATTERN:
            raise ValueError("this vocabulary file needs other text rules than the ones known here")
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self._read(content)

    def _read(self, content: str) -> None:
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model

    def _tokens(self, words: list[str]) -> list[list[int]]:
        """The ids of each of some distinct words, given in byte letters."""
        return [[t.id for t in self.model.tokenize(word)] for word in words]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each of some texts that aren't cut into words here."""
        return [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32) for text in texts]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words, as little-endian 32-bit numbers."""
        if len(self.words) > CACHED_WORDS:
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        out = list(map(known.get, words))
        missing = []
        for k, ids in enumerate(out):
            if ids is None:
                ids = older.get(words[k])
                if ids is None:
                    missing.append(k)
                else:
                    out[k] = known[words[k]] = ids
        spelt = [words[k].decode("latin-1").translate(self.letters) for k in missing]
        for k, tokens in zip(missing, self._tokens(spelt), strict=True):
            out[k] = known[words[k]] = array("I", tokens).tobytes()
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice of UTF-8 bytes, one after the other, and how many each has."""
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        leads = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
        edges = np.concatenate([[0], leads])[offsets]
        texts, n = len(offsets) - 1, len(points)
        kinds, lowers = point_tables()
        points = np.minimum(points, np.uint32(KNOWN_POINTS))
        kind, low = kinds[points], lowers[points]
        owner = np.repeat(np.arange(texts, dtype=np.int32), np.diff(edges))
        odd = np.zeros(texts, bool)
        odd[owner[kind == ODD]] = True
        if self.special:
            bars = np.flatnonzero((low[:-1] == ord("<")) & (low[1:] == ord("|")))
            odd[owner[bars]] = True
        starts = np.zeros(n + 1, bool)
        starts[edges] = True
        starts[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        self._cut_contractions(low, kind, starts, edges, owner)
        begin = np.flatnonzero(starts[:n])
        stop = np.append(begin[1:], n)
        used = (kind[begin] != SPACE) & ~odd[owner[begin]]
        begin, stop = begin[used], stop[used]
        counts = np.zeros(texts, np.int64)
        flat = np.zeros(0, np.uint32)
        if len(begin):
            index, words = self._distinct(low, begin, stop)
            ids = self._learn(words)
            sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
            pool = np.frombuffer(b"".join(ids), "<u4")
            each = sizes[index]
            ends = np.cumsum(each, dtype=np.int32)
            back = (np.cumsum(sizes, dtype=np.int32) - sizes)[index] - (ends - each)
            flat = pool[np.arange(ends[-1], dtype=np.int32) + np.repeat(back, each)]
            counts += np.bincount(owner[begin], each, texts).astype(np.int64)
        return self._with_odd(data, offsets, odd, flat, counts)

    def _cut_contractions(self, low, kind, starts, edges, owner) -> None:
        """An apostrophe that begins a run takes s, t, m, d, re, ve or ll with it."""
        quotes = np.flatnonzero((low == ord("'")) & starts[:-1])
        quotes = quotes[quotes + 1 < len(low)]
        quotes = quotes[(owner[quotes] == owner[quotes + 1]) & (kind[quotes + 1] == LETTER)]
        after = low[quotes + 1]
        second = np.minimum(quotes + 2, len(low) - 1)
        same = (quotes + 2 < len(low)) & (owner[second] == owner[quotes])
        then = np.where(same, low[second], 0)
        pair = sum((after == ord(a)) & (then == ord(b)) for a, b in ("re", "ve", "ll")) > 0
        single = np.isin(after, [ord(c) for c in "stmd"])
        for at, length in ((quotes[single], 2), (quotes[pair & ~single], 3)):
            starts[at + 1] = False
            starts[at + length] = True

    def _distinct(self, low, begin, stop) -> tuple[np.ndarray, list[bytes]]:
        """For each word its number among the distinct ones, and these as bytes."""
        raw = low.tobytes().decode("utf-32-le").encode()
        width = (low >= 0x80).view(np.uint8) + 1
        if len(raw) > 2 * len(low) or (low >= 0x800).any():
            width += (low >= 0x800).view(np.uint8) + (low >= 0x10000)
        place = np.zeros(len(low) + 1, np.int64)
        np.cumsum(width, out=place[1:])
        # Words and what lies between them by turns; every other one is taken.
        cuts = np.column_stack([place[begin], place[stop]]).ravel()
        between = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        found = between.take(pa.array(np.arange(0, len(cuts), 2))).dictionary_encode()
        return found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()

    def _with_odd(self, data, offsets, odd, flat, counts) -> tuple[np.ndarray, np.ndarray]:
        """The same with the texts that the library encodes as a whole put in."""
        if not odd.any():
            return flat, counts
        parts, at = [], np.concatenate([[0], np.cumsum(counts)])
        whole = iter(self._whole([
            data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace") for k in np.flatnonzero(odd)]))
        for k in range(len(counts)):
            if odd[k]:
                parts.append(next(whole))
                counts[k] = len(parts[-1])
            else:
                parts.append(flat[at[k] : at[k + 1]])
        return np.concatenate(parts), counts


@lru_cache(maxsize=1)
def word_ids(content: str) -> WordIds:
    return WordIds(content)
