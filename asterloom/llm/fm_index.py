"""A bidirectional FM-index over a sequence of word numbers, as numpy arrays.

The index knows the sequence and its mirror image by their Burrows-Wheeler
transforms. A set of phrases is a set of intervals, one in each of the two
orders: all places where the phrase stands, sorted by what follows it or by what
comes before it. `left` and `right` extend every phrase of a set by every word
that stands there, all at once. Orders go as deep as the longest phrase wanted,
which is all that its intervals depend on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Phrases:
    """Phrases of one length: words (one row each), how often, and where in both orders."""

    words: np.ndarray
    size: np.ndarray
    ahead: np.ndarray  # first place in the order by what follows
    behind: np.ndarray  # first place in the order by what comes before

    def only(self, chosen: np.ndarray) -> Phrases:
        return Phrases(self.words[chosen], self.size[chosen], self.ahead[chosen], self.behind[chosen])


class _Transform:
    """One direction: the word before each place, in the order of what follows the place."""

    def __init__(self, sequence: np.ndarray, highest: int, depth: int):
        n, bits = len(sequence), max(int(highest).bit_length(), 1)
        padded = np.concatenate([sequence, np.zeros(depth, sequence.dtype)])
        together = max(min(63 // bits, depth), 1)
        order = np.arange(n)
        # Stable sorts from the last words to the first, several words to a number.
        for first in reversed(range(0, depth, together)):
            key = np.zeros(n, np.int64)
            for k in range(first, min(first + together, depth)):
                key = (key << bits) | padded[k : k + n]
            order = order[np.argsort(key[order], kind="stable")]
        self.before = sequence[order - 1]  # the first place follows the last one
        del order, padded
        by_word = np.argsort(self.before, kind="stable")
        self.last_to_first = np.empty(n, np.int32)
        self.last_to_first[by_word] = np.arange(n, dtype=np.int32)

    def extend(self, start: np.ndarray, size: np.ndarray, other: np.ndarray, highest: int):
        """(phrase, word, how often, place here, place in the other order) of every extension."""
        ends = np.cumsum(size)
        rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        phrase = np.repeat(np.arange(len(size)), size)
        key = phrase * (highest + 1) + self.before[rows]
        del phrase
        order = np.argsort(key, kind="stable")
        key = key[order]
        group = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        many = np.diff(np.append(group, len(key)))
        phrase, word = key[group] // (highest + 1), key[group] % (highest + 1)
        here = self.last_to_first[rows[order[group]]]
        there = other[phrase] + group - (ends - size)[phrase]
        found = np.flatnonzero(word)  # 0 ends a piece of text
        return phrase[found], word[found], many[found], here[found], there[found]


class BidirectionalIndex:
    """`sequence` has words from 1 on; 0 stands between pieces, at the start and at the end."""

    def __init__(self, sequence: np.ndarray, depth: int):
        self.highest = int(sequence.max(initial=0))
        self.ahead = _Transform(sequence, self.highest, depth)
        self.behind = _Transform(sequence[::-1], self.highest, depth)
        counts = np.bincount(sequence, minlength=self.highest + 1)
        self.first, self.counts = np.cumsum(counts) - counts, counts

    def words(self) -> Phrases:
        found = np.flatnonzero(self.counts[1:]) + 1
        return Phrases(found[:, None], self.counts[found], self.first[found], self.first[found])

    def left(self, phrases: Phrases) -> Phrases:
        """Every phrase with every word that stands before it."""
        phrase, word, size, here, there = self.ahead.extend(phrases.ahead, phrases.size, phrases.behind, self.highest)
        return Phrases(np.column_stack([word, phrases.words[phrase]]), size, here, there)

    def right(self, phrases: Phrases) -> Phrases:
        """Every phrase with every word that stands behind it."""
        phrase, word, size, here, there = self.behind.extend(phrases.behind, phrases.size, phrases.ahead, self.highest)
        return Phrases(np.column_stack([phrases.words[phrase], word]), size, there, here)
