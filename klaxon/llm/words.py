"""Words and shingles of texts as 64-bit numbers, in numpy.

A word is a run of bytes other than space and tab to carriage return, with A-Z in lower
case and everything else as it is. Numbers come from xxh3, so they are the same in every
process.
"""

import numpy as np
import xxhash

from klaxon.llm.memory import remembered

WORDS_KEPT = 150_000


class WordNumbers(dict):
    """word -> number, for a bounded number of words."""

    def __missing__(self, word):
        if len(self) >= WORDS_KEPT:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def word_list(text):
    return text.encode().lower().split() if text else []


def numbers_of(words):
    number = remembered(WordNumbers, WordNumbers).__getitem__
    return np.fromiter(map(number, words), np.uint64, len(words))


def mixed(x):
    """A bijection on 64-bit numbers that leaves no visible pattern."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles_in_order(numbers, width):
    """Number of each run of ``width`` words, by position; a shorter text is one run."""
    if len(numbers) == 0:
        return numbers
    width = min(width, len(numbers))
    last = len(numbers) - width + 1
    found = np.full(last, width, np.uint64)
    for i in range(width):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + last])
    return found


def shingle_set(text, width):
    """Distinct shingles of a text, ascending."""
    return np.unique(shingles_in_order(numbers_of(word_list(text)), width))
