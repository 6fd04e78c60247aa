"""BPE encoding and decoding by a prefix-sharing trie traversal.

The distinct words of a slice are walked in sorted order, which is a depth-first
walk of their trie; the path from the root is all that is held. Every node
(prefix) keeps one state: the last token of its encoding. That token is the one
suffix of the prefix whose token may follow the last token of the rest: two
tokens may stand side by side if merging their units gives just these two. A
shared prefix is therefore encoded once, and a word's tokens are read off by
walking back from its end. Which suffixes of a prefix are tokens at all is known
from a second trie, that of the tokens, with links from each node to its longest
proper suffix: every node of the words' trie keeps its place there too.

Texts are cut into words as arrays (see `word_ids`), so that Python meets each
distinct word of a slice once, not each occurrence; only texts with unusual
characters are cut one by one.
"""

from __future__ import annotations

import gc
import json
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import each_slice, list_array, tidy
from .word_ids import WORD_PATTERN, WordIds, byte_letters

SLICE = 1 << 20
CACHED_CHUNKS = 200_000  # a worker forgets its words beyond this; results don't depend on it
SPLITS_ALIKE = regex.compile("[\x1c-\x1f]")  # the only characters str.split() takes for blanks and \s doesn't


class Vocabulary:
    """A word-level BPE vocabulary: NFC, one blank, lower case, split, bytes, merges."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, names = spec["model"], [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if model["type"] != "BPE" or names != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            raise ValueError("this vocabulary file needs other text rules than the ones known here")
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.blank = regex.compile(spec["normalizer"]["normalizers"][1]["pattern"]["Regex"])
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        self.ranks = {tuple(x if isinstance(x, list) else x.split(" ")): i for i, x in enumerate(model["merges"])}
        self.sizes = {i: len(self._units(t)) for t, i in self.ids.items()}
        self.letters = dict(enumerate(byte_letters()))
        self._link_tokens()
        self.alone: dict[int, bool] = {}
        self.beside: dict[int, bool] = {}  # by left << 20 | right
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    # Merging a short run of units, to learn which tokens may stand together.

    def _units(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token.removesuffix(self.end)
            return [*body[:-1], body[-1] + self.end]
        return [*token]

    def _merge(self, units: list[str]) -> list[str]:
        none = len(self.ranks)
        while len(units) > 1:
            ranks = [self.ranks.get(p, none) for p in zip(units, units[1:])]
            rank = min(ranks)
            if rank == none:
                break
            at = ranks.index(rank)
            units = [*units[:at], units[at] + units[at + 1], *units[at + 2 :]]
        return units

    def _stands_alone(self, token: int) -> bool:
        if token not in self.alone:
            name = self.names[token]
            self.alone[token] = self._merge(self._units(name)) == [name]
        return self.alone[token]

    def _may_follow(self, left: int, right: int) -> bool:
        a, b = self.names[left], self.names[right]
        return self._merge([*self._units(a), *self._units(b)]) == [a, b]

    def _link_tokens(self) -> None:
        """The trie of the tokens: for each node its longest proper suffix and all tokens that are suffixes of it.

        `inside` has those that may stand within a word, `closing` those for its
        end; both have the longest first.
        """
        self.following: list[dict[str, int]] = [{}]
        self.suffix, self.inside, self.closing = [0], [()], [()]
        for name, token in self.ids.items():
            closes = bool(self.end) and name.endswith(self.end) and len(name) > len(self.end)
            node = 0
            for letter in name.removesuffix(self.end) if closes else name:
                if letter not in self.following[node]:
                    self.following[node][letter] = len(self.following)
                    self.following.append({})
                    self.suffix.append(0)
                    self.inside.append(())
                    self.closing.append(())
                node = self.following[node][letter]
            if not closes:
                self.inside[node] = (token,)
            if closes or not self.end:
                self.closing[node] = (token,)
        waiting = deque(self.following[0].values())
        while waiting:  # by depth, so that a node's suffix is done before it
            node = waiting.popleft()
            self.inside[node] += self.inside[self.suffix[node]]
            self.closing[node] += self.closing[self.suffix[node]]
            for letter, child in self.following[node].items():
                self.suffix[child] = self._step(self.suffix[node], letter)
                waiting.append(child)

    def _step(self, node: int, letter: str) -> int:
        """The node of the longest suffix that begins a token, one letter further."""
        following = self.following
        while node and letter not in following[node]:
            node = self.suffix[node]
        return following[node].get(letter, 0)

    def _last_token(self, word: str, stop: int, states: list[int], tokens: tuple[int, ...]) -> int:
        """The last token of word[:stop], one of `tokens`; states hold those of shorter prefixes."""
        beside, sizes = self.beside, self.sizes
        for token in tokens:
            start = stop - sizes[token]
            if start:
                pair = states[start] << 20 | token
                fits = beside.get(pair)
                if fits is None:
                    fits = beside[pair] = self._may_follow(states[start], token)
                if fits:
                    return token
            elif self._stands_alone(token):
                return token
        raise ValueError(f"the vocabulary has no token for {word[stop - 1]!r}")

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Token ids of each distinct word, given in byte letters."""
        out: dict[str, list[int]] = {}
        states, nodes = [-1], [0]  # of every prefix of the word before
        before, last_token, sizes, step = "", self._last_token, self.sizes, self._step
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before)) - 1
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del states[shared + 1 :], nodes[shared + 1 :]
            for stop in range(shared + 1, len(word)):
                node = step(nodes[-1], word[stop - 1])
                nodes.append(node)
                states.append(last_token(word, stop, states, self.inside[node]))
            token = last_token(word, len(word), states, self.closing[step(nodes[-1], word[-1])])
            tokens, stop = [token], len(word) - sizes[token]
            while stop:
                token = states[stop]
                tokens.append(token)
                stop -= sizes[token]
            tokens.reverse()
            out[word] = tokens
            before = word
        return out

    def learn(self, chunks: set[str]) -> None:
        """Encode the runs without blanks that are not known yet."""
        if len(self.chunks) > CACHED_CHUNKS:
            # Words in use come back from the older half; the rest is forgotten.
            self.chunks, self.older = {}, self.chunks
        missing = [c for c in chunks if c not in self.chunks]
        self.chunks |= {c: self.older[c] for c in missing if c in self.older}
        new = [c for c in missing if c not in self.chunks]
        if len(self.beside) > 10 * CACHED_CHUNKS:
            self.beside.clear()
        letters, parts = self.letters, {}
        for chunk in new:
            text = unicodedata.normalize("NFC", chunk)
            # Letter by letter: a sigma at the end of a word is lowered like any other.
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            # Printable ASCII without blanks stands for itself.
            parts[chunk] = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(letters)
                            for w in self.words.findall(text)]
        tokens = self.encode_words(list({w for ws in parts.values() for w in ws}))
        names = self.names
        for chunk, ws in parts.items():
            ids = [t for w in ws for t in tokens[w]]
            self.chunks[chunk] = (array("i", ids).tobytes(), " ".join([names[t] for t in ids]))

    def split(self, text: str) -> list[str]:
        """Runs without blanks; special tokens are runs of their own."""
        if self.cut and self.cut.search(text):
            pieces = self.cut.split(text)
            return [c for k, p in enumerate(pieces) for c in ([p] if k % 2 else self._split(p))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if SPLITS_ALIKE.search(text):
            return [c for c in self.blank.split(text) if c]
        return text.split()

    def encode_texts(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as int32 bytes, decoded text) of each text."""
        split = [self.split(t) for t in texts]
        self.learn({c for chunks in split for c in chunks} - set(self.special))
        for content, token in self.special.items():
            self.chunks[content] = (np.array([token], np.int32).tobytes(), content)
        known, out = self.chunks, []
        for chunks in split:
            found = [known[c] for c in chunks]
            out.append((b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])))
        return out


class TrieIds(WordIds):
    """Token ids of whole slices, their words encoded by a vocabulary's trie."""

    def _read(self, content: str) -> None:
        self.vocabulary = vocabulary(content)

    def _tokens(self, words: list[str]) -> list[list[int]]:
        if len(self.vocabulary.beside) > 10 * CACHED_CHUNKS:
            self.vocabulary.beside.clear()
        found = self.vocabulary.encode_words(words)
        return [found[w] for w in words]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, np.uint32) for ids, _ in self.vocabulary.encode_texts(texts)]


class TextIds:
    """The same for a vocabulary whose words are cut by another pattern: text by text."""

    def __init__(self, content: str):
        self.vocabulary = vocabulary(content)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        done = self.vocabulary.encode_texts([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])])
        return np.frombuffer(b"".join([x[0] for x in done]), np.uint32), np.array([len(x[0]) // 4 for x in done])


@lru_cache(maxsize=2)
def vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def token_names(words: Vocabulary) -> pa.Array:
    """The name of each id; ids that no token has are null."""
    return pa.array([words.names.get(i) for i in range(max(words.names, default=-1) + 1)], pa.string())


@lru_cache(maxsize=2)
def lasting_ids(content: str) -> tuple[TrieIds | TextIds, pa.Array]:
    """What a worker encodes with: the collector needn't go through its tables again and again."""
    words = vocabulary(content)
    alike = words.words.pattern == WORD_PATTERN and all(name.startswith("<|") for name in words.special)
    found = (TrieIds if alike else TextIds)(content), token_names(words)
    gc.collect()
    gc.freeze()
    return found


def _encode_batches(content: str):
    def run(batches):
        words, names = lasting_ids(content)
        for batch, first, last, data, offsets in each_slice(batches, SLICE):
            ids, counts = words.encode(data, offsets)
            tokens = list_array(ids.view(np.int32), counts, pa.int32())
            spelt = pa.ListArray.from_arrays(tokens.offsets, names.take(tokens.values))
            columns = [c.slice(first, last - first) for n, c in zip(batch.schema.names, batch.columns) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, tokens, pc.binary_join(spelt, " ")],
                [*(n for n in batch.schema.names if n != "text"), "token_ids", "decoded"])
    return run


def encode_decode(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, token_ids array<int>, decoded: one row per input row.

    `vocabulary_path` names a tokenizer file on the driver; its content (a few
    MB) goes to the tasks with the function. Ids and decoded text are those of
    the public tokenizers library for that file without added special tokens;
    strings of special tokens in a text become these tokens. Decoding joins the
    names of the tokens by one blank, as that file has no decoder.

    A null or empty text has no tokens and decodes to the empty string. A null
    id stays null, repeated rows each give a row, an empty table gives none.
    Other columns are ignored.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        content = f.read()
    vocabulary(content)  # fails here, not in a task, for an unsuitable file
    # An id column is cast to long; its name never clashes with the text's.
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_encode_batches(content)), "doc_id long, token_ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, one blank between) and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
