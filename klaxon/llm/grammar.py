"""Token ids in binary shards, compressed by Re-Pair grammars with random access.

Documents are encoded in ascending ``doc_id`` order and cut into shards of about
``SHARD_IDS`` ids. In each shard, frequent pairs of neighbours are replaced by nonterminals
round after round, most frequent first where they overlap, until no pair occurs often enough
to pay for its rule. A shard stores its rules, the ids that each rule stands for in number
(its expansion length), the compressed sequence, and its documents' lengths. An id range
is decoded from those symbols alone whose expansions overlap it.

File format: a Parquet table with a row per shard, numbers as little-endian uint32 in
binary columns. Spark's writer reaches any store a cluster has, commits shards only when
their task succeeds, and lets readers fetch single shards and columns.
"""

import zlib
from typing import NamedTuple

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from klaxon.llm.batches import to_batch
from klaxon.llm.numbering import partitions_of
from klaxon.llm.tokens import WORD, encoder, pieces
from klaxon.session import new_folder, settle

SHARD_IDS = 1 << 20
# A rule takes three numbers, so a pair pays from its fourth place on.
LEAST_FREQUENCY = 4

# Text that is encoded at once.
TEXT_BYTES = 16 << 20

SHARDS = (
    "part int, shard int, first_id bigint, n_ids bigint, terminals bigint, "
    "doc_ids binary, doc_missing binary, doc_lengths binary, "
    "rules binary, expansions binary, sequence binary"
)
TOKENS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class Grammar(NamedTuple):
    """Symbols below ``terminals`` are ids; symbol ``terminals + i`` stands for ``rules[i]``,
    which stands for ``expansions[i]`` ids."""

    terminals: int
    rules: np.ndarray
    expansions: np.ndarray
    sequence: np.ndarray


def _candidates(sequence, active):
    """Places of the active pairs of neighbours. Of a run of one symbol, whose pairs are all active,
    every other pair counts, as the others overlap with it."""
    place = np.flatnonzero(active)
    equal = np.flatnonzero(sequence[place] == sequence[place + 1])
    if len(equal):
        at = place[equal]
        first = np.diff(at, prepend=-2) != 1
        start = at[first][np.cumsum(first) - 1]
        place = np.delete(place, equal[(at - start) % 2 == 1])
    return place


def _places_of(kinds, pairs):
    """For each pair its place among ``kinds``, all different, or -1; by a hash table that is made
    anew for the kinds that lost their slot."""
    found = np.full(len(pairs), -1, np.int64)
    left, look, factor = np.arange(len(kinds)), np.arange(len(pairs)), np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(60 - len(kinds).bit_length())
    while len(left):
        table = np.full(1 << int(64 - shift), -1, np.int32)
        own = (kinds[left] * factor) >> shift
        table[own] = left
        owner = table[(pairs[look] * factor) >> shift]
        met = np.flatnonzero(owner >= 0)
        hit = kinds[owner[met]] == pairs[look[met]]
        found[look[met[hit]]] = owner[met[hit]]
        # A pair that lost its slot has met the one that has it.
        left, look = left[table[own] != left], look[met[~hit]]
        factor = np.uint64((int(factor) ** 2 + 2) % 2**64)
    return found


def _ranked(sequence, place):
    """Places of the pairs that occur often enough, the rank of each, 0 for the most frequent, and
    the pairs by rank."""
    bits, places = int(sequence.max()).bit_length(), len(place).bit_length()
    together = 2 * bits + places <= 64
    if not together:
        bits, places = 32, 0
    pairs = (sequence[place].astype(np.uint64) << np.uint64(bits)) | sequence[place + 1]
    # With its number behind it, where there is room, a pair is found again when they are sorted.
    ordered = pairs << np.uint64(places)
    if together:
        ordered |= np.arange(len(place), dtype=np.uint64)
    ordered.sort()
    kind = ordered >> np.uint64(places)
    starts = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    count = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(count >= LEAST_FREQUENCY)
    often = often[np.argsort(-count[often], kind="stable")]
    kinds, count = kind[starts[often]], count[often]
    if together:
        rank = np.full(len(place), -1)
        from_start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        numbers = ordered[np.repeat(starts[often], count) + from_start]
        rank[numbers & np.uint64((1 << places) - 1)] = np.repeat(np.arange(len(kinds)), count)
    else:
        rank = _places_of(kinds, pairs)
    found = rank >= 0
    right = kinds & np.uint64((1 << bits) - 1)
    return place[found], rank[found], np.stack([kinds >> np.uint64(bits), right], 1).astype(np.uint32)


def compress(ids: np.ndarray) -> Grammar:
    """Re-Pair grammar of a sequence of ids: rounds until no pair is worth a rule.

    A round counts all pairs exactly and replaces those that occur ``LEAST_FREQUENCY`` times
    or more, a pair giving way where a more frequent one overlaps it. What is replaced fewer
    times than that waits for the next round. A pair that was rare stays rare, so only pairs
    with a new symbol, pairs that had to give way and those of equal symbols count again.
    """
    sequence = ids.astype(np.uint32)
    terminals = int(sequence.max()) + 1 if len(sequence) else 0
    rules, lengths = [], np.ones(terminals, np.uint32)
    active = np.ones(max(0, len(sequence) - 1), bool)
    while active.any():
        place, rank, pairs = _ranked(sequence, _candidates(sequence, active))
        if not len(place):
            break
        weak = np.zeros(len(place), bool)
        touching = np.diff(place) == 1
        weak[1:] |= touching & (rank[:-1] < rank[1:])
        weak[:-1] |= touching & (rank[1:] < rank[:-1])
        count = np.bincount(rank[~weak], minlength=rank.max() + 1)
        taken = ~weak & (count[rank] >= LEAST_FREQUENCY)
        used = np.flatnonzero(count >= LEAST_FREQUENCY)
        first = len(lengths)
        symbol = np.zeros(len(count), np.uint32)
        symbol[used] = first + np.arange(len(used), dtype=np.uint32)
        at, rank, pairs = place[taken], rank[taken], pairs[used]
        rules.append(pairs)
        lengths = np.append(lengths, lengths[pairs].sum(1, dtype=np.uint32))
        again = np.zeros(len(sequence), bool)
        again[place[~taken]] = True
        sequence[at] = symbol[rank]
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence, again = sequence[keep], again[keep]
        new = sequence >= first
        # Which pairs of a run of one symbol overlap changes with what is cut off before it.
        active = again[:-1] | new[:-1] | new[1:] | (sequence[:-1] == sequence[1:])
    every = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return Grammar(terminals, every, lengths[terminals:], sequence)


class Decoder:
    """Any range of the ids of a grammar, from the symbols whose expansions overlap it."""

    def __init__(self, grammar: Grammar):
        # What each symbol stands for, one behind the other: ids first, then rules, whose
        # symbols are replaced level by level.
        symbols = grammar.terminals + np.arange(len(grammar.rules), dtype=np.uint32)
        while (inner := symbols >= grammar.terminals).any():
            ends = np.cumsum(1 + inner)
            longer = np.empty(ends[-1], np.uint32)
            longer[ends[~inner] - 1] = symbols[~inner]
            pair = grammar.rules[symbols[inner] - grammar.terminals]
            longer[ends[inner] - 2], longer[ends[inner] - 1] = pair[:, 0], pair[:, 1]
            symbols = longer
        ids = np.arange(grammar.terminals, dtype=np.uint32)
        self.expansions = np.concatenate([ids, symbols])
        self.lengths = np.concatenate([np.ones(len(ids), np.int64), grammar.expansions])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.sequence = grammar.sequence
        self.ends = np.cumsum(self.lengths[self.sequence])

    def ids(self, start: int, end: int) -> np.ndarray:
        if start >= end:
            return np.empty(0, np.uint32)
        first = int(np.searchsorted(self.ends, start, side="right"))
        last = int(np.searchsorted(self.ends, end, side="left")) + 1
        symbols = self.sequence[first:last]
        lengths = self.lengths[symbols]
        before = np.cumsum(lengths) - lengths
        place = np.repeat(self.starts[symbols] - before, lengths)
        place += np.arange(len(place))
        skipped = start - (int(self.ends[first - 1]) if first else 0)
        return self.expansions[place][skipped : skipped + end - start]


def decode(grammar: Grammar, start: int, end: int) -> np.ndarray:
    """Ids from ``start`` up to ``end``."""
    return Decoder(grammar).ids(start, end)


def _bytes(numbers, kind="<u4"):
    return np.asarray(numbers, kind).tobytes()


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int = 2) -> None:
    """Write the ids of every document, each with ``end_id`` behind it, to the folder ``out``.

    Documents go in ascending ``doc_id`` order, nulls first, repeated ids next to each
    other in the order of their texts. A null or empty text has ``end_id`` alone. Other
    columns of ``docs`` play no part. A shard is closed behind the document that fills it.
    """

    def shards(batches):
        encode = encoder(path, WORD).encode
        part = TaskContext.get().partitionId()
        end, shard, first, ids, total, names = end_id.to_bytes(4, "little"), 0, 0, [], 0, []

        def row():
            sequence = np.frombuffer(b"".join(ids), "<u4")
            grammar = compress(sequence)
            return (
                part,
                shard,
                first,
                total,
                grammar.terminals,
                _bytes([name or 0 for name in names], "<i8"),
                _bytes([name is None for name in names], "u1"),
                _bytes([len(one) // 4 for one in ids]),
                _bytes(grammar.rules),
                _bytes(grammar.expansions),
                _bytes(grammar.sequence),
            )

        for some in pieces(batches, 1, TEXT_BYTES):
            found, starts = encode(some.column(1))
            for name, a, b in zip(some.column(0).to_pylist(), starts[:-1], starts[1:]):
                names.append(name)
                ids.append(found[a:b].astype("<u4").tobytes() + end)
                total += len(ids[-1]) // 4
                if total >= SHARD_IDS:
                    yield to_batch([row()], SHARDS)
                    shard, first, ids, total, names = shard + 1, first + total, [], 0, []
        if names:
            yield to_batch([row()], SHARDS)

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = partitions_of(docs.sparkSession)
    ordered = chosen.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shards, SHARDS).write.parquet(out)


def read_tokens(spark, out: str) -> DataFrame:
    """Per document of a folder: doc_id, start among all ids, n_tokens and the ids' crc32."""
    files = spark.read.schema(SHARDS).parquet(out)
    # One row per part, as many as the writer had tasks.
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    )

    def documents(batches):
        for batch in batches:
            for at in range(len(batch)):
                one = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                grammar = Grammar(
                    one["terminals"],
                    np.frombuffer(one["rules"], "<u4").reshape(-1, 2),
                    np.frombuffer(one["expansions"], "<u4"),
                    np.frombuffer(one["sequence"], "<u4"),
                )
                names = np.frombuffer(one["doc_ids"], "<i8").tolist()
                missing = np.frombuffer(one["doc_missing"], "u1").tolist()
                lengths = np.frombuffer(one["doc_lengths"], "<u4").tolist()
                # All documents are wanted, so the shard's whole range is decoded at once.
                ids = Decoder(grammar).ids(0, one["n_ids"]).astype("<u4")
                start, rows = 0, []
                for name, gone, length in zip(names, missing, lengths):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    place = one["before"] + one["first_id"] + start
                    rows.append((None if gone else name, place, length, crc))
                    start += length
                yield to_batch(rows, TOKENS)

    placed = files.join(F.broadcast(starts), "part")
    return placed.mapInArrow(documents, TOKENS)


def token_table(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write all documents to a folder of their own and read them back."""
    out = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, out, path, end_id)
    return read_tokens(docs.sparkSession, out)
