"""Benchmark items in documents, found by shared seeds and greedy string tiling.

Every run of ``TILE`` words of the benchmark is a seed. Documents are searched for the seeds
of one block of items after another, each block of bounded size; a text that shares seeds
with an item is cut down to the words around them and tiled against the item. The share
of the item's words under tiles counts, whatever their order in the text.

Words are lower-cased and bared of punctuation around them; of scripts that are written
without spaces every character is a word. An item of fewer than ``TILE`` words has no seed. One of
``LEAST`` words or more is found as a whole, as consecutive words of a text; a shorter one
says too little for that, and is found where it is all that a text says.
"""

import math

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import slices, to_batch
from klaxon.llm.memory import remembered
from klaxon.llm.tiling import tiles, window_hashes
from klaxon.llm.words import mixed
from klaxon.operators.joins import fits_broadcast
from klaxon.session import settle

TILE = 5
LEAST = 3
COVERAGE = 0.5
# Words of a block of items, which every task receives: 16 MB.
BLOCK_WORDS = 500_000
WORDS_KEPT = 300_000

MATCHES = "doc_id bigint, item_id bigint, item_words int, covered int, tiles int, coverage double"
_PUNCTUATION = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


class _Numbers(dict):
    def __missing__(self, word):
        if len(self) >= WORDS_KEPT:
            self.clear()
        bare = word.strip(_PUNCTUATION)
        # 0 is no word.
        self[word] = xxhash.xxh3_64_intdigest(bare.encode()) if bare else 0
        return self[word]


_UNSPACED = regex.compile(
    r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
)


def _spaced(text):
    """The text with spaces around each character of a script that has none between words."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _UNSPACED.sub(r" \1 ", text)
    return text


def word_numbers(text):
    words = _spaced(text).lower().split() if text else []
    number = remembered(_Numbers, _Numbers).__getitem__
    numbers = np.fromiter(map(number, words), np.uint64, len(words))
    return numbers[numbers != 0]


class Seeds:
    """The items of a block by their seeds."""

    def __init__(self, items):
        self.items = [(item, word_numbers(text)) for item, text in items]
        self.sizes = np.array([len(words) for _, words in self.items], np.int64)
        hashes, owners, places = [], [], []
        # Short items by their length, each as its words' numbers.
        self.short = {}
        for owner, (_, words) in enumerate(self.items):
            if len(words) < TILE:
                self.short.setdefault(len(words), {}).setdefault(tuple(words.tolist()), []).append(owner)
                continue
            found = mixed(window_hashes(words, TILE))
            hashes.append(found)
            owners.append(np.full(len(found), owner))
            places.append(np.arange(len(found)))
        hashes = np.concatenate(hashes or [np.empty(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owners = np.concatenate(owners or [np.empty(0, np.int64)])[order]
        self.places = np.concatenate(places or [np.empty(0, np.int64)])[order]
        # Most runs of words are no seed; their upper bits tell without a search.
        self.some = np.zeros(1 << 20, bool)
        self.some[self.hashes >> np.uint64(44)] = True
        self.short_hashes = {
            size: np.sort(np.array([_number(key) for key in keys], np.uint64))
            for size, keys in self.short.items()
            if size >= LEAST
        }

    def _short_matches(self, words):
        """Items without seeds: (item_id, item words, covered words, tiles)."""
        owners = set()
        if len(words) < TILE:
            owners.update(self.short.get(len(words), {}).get(tuple(words.tolist()), ()))
        for size, known in self.short_hashes.items():
            found = window_hashes(words, size)
            at = np.flatnonzero(np.isin(found, known))
            for place in at.tolist():
                owners.update(self.short[size].get(tuple(words[place : place + size].tolist()), ()))
        return [(self.items[o][0], int(self.sizes[o]), int(self.sizes[o]), 1) for o in sorted(owners) if self.sizes[o]]

    def _met(self, hashes):
        """(item, its places, places in the text) for the items whose words under shared seeds may
        suffice; no tile reaches beyond them."""
        at = np.flatnonzero(self.some[hashes >> np.uint64(44)])
        first = np.searchsorted(self.hashes, hashes[at], side="left")
        last = np.searchsorted(self.hashes, hashes[at], side="right")
        at, first, last = (x[first < last] for x in (at, first, last))
        # A sentence of many items shares its seeds: each seed of the text counts once.
        kinds, which = np.unique(first, return_inverse=True)
        if not len(kinds):
            return []
        count = np.zeros(len(kinds), np.int64)
        count[which] = last - first
        seeds = np.repeat(kinds - (np.cumsum(count) - count), count) + np.arange(count.sum())
        kind = np.repeat(np.arange(len(kinds)), count)
        order = np.lexsort((self.places[seeds], self.owners[seeds]))
        owner, place, kind = self.owners[seeds][order], self.places[seeds][order], kind[order]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        # Words that seeds of an item cover: each up to the next seed, the last one whole.
        step = np.minimum(np.diff(place, append=0), TILE)
        step[np.append(starts[1:], len(place)) - 1] = TILE
        most = np.add.reduceat(step, starts)
        enough = most >= COVERAGE * self.sizes[owner[starts]]
        texts = [at[which == k] for k in range(len(kinds))] if enough.any() else []
        ends = np.append(starts[1:], len(place))
        return [
            (int(owner[a]), np.concatenate([texts[k] for k in np.unique(kind[a:b])]))
            for a, b in zip(starts[enough], ends[enough])
        ]

    def matches(self, text):
        """(item_id, item words, covered words, tiles) of every item with a tile in a text."""
        words = word_numbers(text)
        found = self._short_matches(words) if self.short else []
        for owner, places in self._met(mixed(window_hashes(words, TILE))):
            item, item_words = self.items[owner]
            under = np.zeros(len(words) + 1, np.int64)
            np.add.at(under, places, 1)
            np.add.at(under, places + TILE, -1)
            covered = np.flatnonzero(np.cumsum(under[:-1]))
            # Gaps between the words around seeds become a word that no item has.
            gaps = np.flatnonzero(np.diff(covered) > 1) + 1
            parts = np.insert(words[covered], gaps, 0)
            marked = tiles(parts, item_words, TILE)
            if marked:
                size = sum(length for length, _, _ in marked)
                found.append((item, len(item_words), size, len(marked)))
        return found


def _number(words):
    return window_hashes(np.array(words, np.uint64), len(words))[0]


def _blocks(benchmark: DataFrame):
    """Seeds of the benchmark, a broadcast for each block of items.

    Items are dealt to blocks by hash, so that a block holds about BLOCK_WORDS words.
    """
    spark = benchmark.sparkSession
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("bigint"), "text")
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = math.ceil(size / BLOCK_WORDS)
    for block in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(row["item_id"], row["text"]) for row in chosen.collect()]
        yield spark.sparkContext.broadcast(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """MATCHES for every document and item of which it holds at least ``coverage``.

    Items of fewer than TILE words match whole or not at all. Items without words match
    nothing, and neither do null or empty texts. Repeated documents and items match each by
    itself. Other columns play no part.
    """
    if coverage < COVERAGE:
        raise ValueError(f"coverage below {COVERAGE} is not searched for")
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for sent in _blocks(benchmark):

        def search(batches, sent=sent):
            seeds = Seeds(sent.value)
            for batch in slices(batches):
                rows = []
                for doc, text in zip(*[column.to_pylist() for column in batch.columns]):
                    for item, size, covered, number in seeds.matches(text):
                        if covered >= coverage * size:
                            rows.append((doc, item, size, covered, number, covered / size))
                if rows:
                    yield to_batch(rows, MATCHES)

        block = chosen.mapInArrow(search, MATCHES)
        found = block if found is None else found.unionByName(block)
    if found is None:
        found = docs.sparkSession.createDataFrame([], MATCHES)
    return found


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold less than ``coverage`` of
    every item."""
    if coverage < COVERAGE:
        raise ValueError(f"coverage below {COVERAGE} is not searched for")
    at = docs.columns.index("text")
    blocks = list(_blocks(benchmark))
    if not blocks:
        return docs
    if len(blocks) > 1:
        # A pass for each block finds rows to drop, by id and text; no task holds two blocks.
        key = F.xxhash64("text").alias("_key")
        keyed = docs.select(F.col("doc_id").alias("_id"), key, "text")
        gone = None
        for sent in blocks:
            some = _filtered(keyed, sent, coverage, 2, False).select("_id", "_key")
            gone = some if gone is None else gone.unionByName(some)
        gone = settle(gone.distinct())
        gone = F.broadcast(gone) if fits_broadcast(gone) else gone
        same = docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_key"])
        return docs.join(gone, same, "left_anti")
    return _filtered(docs, blocks[0], coverage, at, True)


def _filtered(docs, sent, coverage, at, clean) -> DataFrame:
    """Rows whose text in column ``at`` is clean of a block's items, or those that are not."""

    def keep(batches):
        seeds = Seeds(sent.value)
        for batch in slices(batches):
            kept = [
                clean != any(covered >= coverage * size for _, size, covered, _ in found)
                for found in map(seeds.matches, batch.column(at).to_pylist())
            ]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
