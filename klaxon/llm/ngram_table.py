"""Runs of words of a batch, interned in one open-addressed table of NumPy arrays.

A batch's words are written one after another with single spaces, so a run of words is a
span of bytes. Spans are hashed by xxhash64 and inserted all at once: in each round every
pending span looks at its next slot, takes it if it is empty, and is done if the span that
has the slot holds the same bytes. A slot stores its bucket (crc32) and how often it was met.
"""

import zlib

import numpy as np
import xxhash

SLOTS_PER_SPAN = 2
# Longer words are left to zlib.
TABLED = 64

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        # Fixed values of xxhash64.
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)


def _word_bytes():
    """(lower, is_word) for each byte: A-Z in lower case; digits, letters and bytes of other
    alphabets make up words."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[97:123] = is_word[128:] = True
    return lower, is_word[lower]


_LOWER, _IS_WORD = _word_bytes()


class Words:
    """Words of a batch of texts: ``data`` has them joined by single spaces, ``start`` and ``end``
    bound each, ``row`` is its text's."""

    def __init__(self, texts):
        """``texts``: a string array of Arrow; null counts as empty."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        body = texts.buffers()[2]
        raw = np.frombuffer(body, np.uint8)[first:last] if last > first else np.empty(0, np.uint8)
        inside = _IS_WORD[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        # A text's first byte begins a word whatever the text before ended with.
        edges = offsets[:-1][np.diff(offsets) > 0] - first
        begins[edges] = inside[edges]
        kept = np.flatnonzero(inside)
        at = np.flatnonzero(begins[kept])
        length = np.diff(np.append(at, len(kept)))
        self.start = at + np.arange(len(at))
        self.end = self.start + length
        self.row = np.searchsorted(offsets - first, kept[at], side="right") - 1
        self.data = np.full(len(kept) + len(at), 32, np.uint8)
        self.data[np.arange(len(kept)) + np.repeat(np.arange(len(at)), length)] = _LOWER[raw[kept]]

    def spans(self, longest):
        """(first word, words, start, end) of all runs of 1 to ``longest`` words of one text."""
        firsts, sizes = [], []
        for size in range(1, longest + 1):
            n = max(0, len(self.row) - size + 1)
            first = np.flatnonzero(self.row[:n] == self.row[len(self.row) - n :])
            firsts.append(first)
            sizes.append(np.full(len(first), size))
        first, size = np.concatenate(firsts), np.concatenate(sizes)
        return first, size, self.start[first], self.end[first + size - 1]


def lanes(data):
    """Eight bytes from each place on as a little-endian number; zeros follow the end."""
    one = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    two = one[:-1] | (one[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


def _turn(x, by):
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(data, eight, start, length):
    """xxhash64 with seed 0 of spans of ``data``, whose lanes are ``eight``."""
    h = _P5 + length.astype(np.uint64)
    at, left = start.copy(), np.where(length < 32, length, 0)
    while True:
        some = np.flatnonzero(left >= 8)
        if not len(some):
            break
        lane = _turn(eight[at[some]] * _P2, 31) * _P1
        h[some] = _turn(h[some] ^ lane, 27) * _P1 + _P4
        at[some] += 8
        left[some] -= 8
    some = np.flatnonzero(left >= 4)
    lane = eight[at[some]] & np.uint64(0xFFFFFFFF)
    h[some] = _turn(h[some] ^ (lane * _P1), 23) * _P2 + _P3
    at[some] += 4
    left[some] -= 4
    for _ in range(3):
        some = np.flatnonzero(left >= 1)
        byte = data[at[some]].astype(np.uint64)
        h[some] = _turn(h[some] ^ (byte * _P5), 11) * _P1
        at[some] += 1
        left[some] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    # From 32 bytes on the algorithm is another one; such spans are few.
    view = memoryview(data)
    for i in np.flatnonzero(length >= 32):
        h[i] = xxhash.xxh64_intdigest(view[start[i] : start[i] + length[i]])
    return h


def same_bytes(eight, start, other, length):
    """Whether spans of equal ``length`` at two places hold the same bytes."""
    same = np.ones(len(start), bool)
    todo, done = np.arange(len(start)), 0
    while len(todo):
        left = length[todo] - done
        differ = eight[start[todo] + done] ^ eight[other[todo] + done]
        spare = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        bad = (differ << spare) != 0
        same[todo[bad]] = False
        todo = todo[~bad & (left > 8)]
        done += 8
    return same


def _byte_table():
    """What a crc32's lowest byte turns into when a byte moves out."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


_STEP = _byte_table()


def _shift_tables():
    """For 0 to TABLED bytes appended: what each of the four bytes of a crc32 turns into."""
    tables = np.empty((TABLED + 1, 4, 256), np.uint32)
    places = 8 * np.arange(4, dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << places[:, None]
    for n in range(1, TABLED + 1):
        before = tables[n - 1]
        tables[n] = _STEP[before & 255] ^ (before >> np.uint32(8))
    return tables


_SHIFT = _shift_tables()


def crc32_of(data, start, end):
    """crc32 of spans of ``data``, byte by byte for all at once; zlib takes the long ones."""
    found = np.full(len(start), 0xFFFFFFFF, np.uint32)
    length = end - start
    order = np.argsort(-np.minimum(length, TABLED + 1), kind="stable")
    order = order[np.count_nonzero(length > TABLED) :]
    ends = np.searchsorted(-length[order], -np.arange(TABLED), side="left")
    for k in range(TABLED):
        some = order[: ends[k]]
        if not len(some):
            break
        now = found[some]
        found[some] = _STEP[(now ^ data[start[some] + k]) & 255] ^ (now >> np.uint32(8))
    found ^= np.uint32(0xFFFFFFFF)
    view = memoryview(data)
    for i in np.flatnonzero(length > TABLED):
        found[i] = zlib.crc32(view[start[i] : end[i]])
    return found


def _shifted(crc, by):
    """crc32 values as they stand after ``by`` more zero bytes, of 0 to TABLED."""
    found = np.zeros_like(crc)
    for place in range(4):
        found ^= _SHIFT[by, place, (crc >> np.uint32(8 * place)) & np.uint32(255)]
    return found


class NgramTable:
    """The distinct runs of 1 to ``longest`` words of a batch.

    ``slot`` has the table's slot of every occurrence, and ``row`` its text. By slot: ``owner``
    (an occurrence, -1 if empty), ``bucket`` and ``count``.
    """

    def __init__(self, texts, longest, buckets):
        words = Words(texts)
        self.words = words
        first, size, start, end = words.spans(longest)
        self.row, self.start, self.length = words.row[first], start, end - start
        self.eight = lanes(words.data)
        key = xxhash64(words.data, self.eight, start, self.length)
        self._insert(key)
        taken = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slot, minlength=len(self.owner))
        self.bucket = np.zeros(len(self.owner), np.int64)
        who = self.owner[taken]
        crc = self._crc32(taken, first[who], size[who], start[who], end[who])
        self.bucket[taken] = crc % np.uint32(buckets)

    def _insert(self, key):
        n = len(key)
        slots = 1 << max(1, (SLOTS_PER_SPAN * n - 1).bit_length()) if n else 1
        self.owner = np.full(slots, -1, np.int64)
        self.slot = np.empty(n, np.int64)
        mask = np.uint64(slots - 1)
        pending, at = np.arange(n), (key & mask).astype(np.int64)
        while len(pending):
            empty = self.owner[at] < 0
            self.owner[at[empty]] = pending[empty]
            owner = self.owner[at]
            same = (key[owner] == key[pending]) & (self.length[owner] == self.length[pending])
            some = np.flatnonzero(same)
            one, other = pending[some], owner[some]
            same[some] = same_bytes(
                self.eight, self.start[one], self.start[other], self.length[one]
            )
            self.slot[pending[same]] = at[same]
            pending, at = pending[~same], (at[~same] + 1) & (slots - 1)

    def _crc32(self, taken, first, size, start, end):
        """crc32 of the runs in taken slots by those of their words: that of a text and a text after it follows from
        both and the second one's length."""
        words = self.words
        length = words.end - words.start
        single = np.flatnonzero(size == 1)
        by_slot = np.zeros(len(self.owner), np.uint32)
        at = first[single]
        by_slot[taken[single]] = crc32_of(words.data, words.start[at], words.end[at])
        # The first occurrences of all are those of single words.
        of_word = by_slot[self.slot[: len(words.start)]]
        space = np.uint32(zlib.crc32(b" "))
        found = of_word[first]
        for more in range(1, int(size.max(initial=1))):
            some = np.flatnonzero(size > more)
            word = first[some] + more
            tabled = length[word] <= TABLED
            some, word = some[tabled], word[tabled]
            spaced = _shifted(found[some], 1) ^ space
            found[some] = _shifted(spaced, length[word]) ^ of_word[word]
        # Runs with a long word after their first.
        long = np.concatenate([[0], np.cumsum(length > TABLED)])
        some = np.flatnonzero(long[first + size] > long[first + 1])
        view = memoryview(words.data)
        for i in some:
            found[i] = zlib.crc32(view[start[i] : end[i]])
        return found
