"""Repeated passages by fixed-block anchors: every word that an earlier passage already gave.

A window is ``window`` consecutive words of one document. Blocks of half as many words are
indexed at every multiple of their length, and every rolling window of a block's length
probes that index: wherever a window lies, it holds a whole indexed block, so each repeat
has a hit. Hits are extended to the windows around them. Equal windows meet by a digest of
96 bits, and all but the earliest go; runs of such windows are the maximal repeats.

The index is divided by hash into parts, the documents into batches. A batch sends each part
one row: its distinct probes of 32 bits in ascending order. The part answers with one bit
per probe, which the batch reads against the same ascending order. So a passage that a
third of all documents hold is one number per batch, no pair of places becomes a row, and
no task holds more than a batch or a part. Texts are shuffled once; the passes share that
exchange. What is computed per batch depends on its rows only, not on their order.

A word counts by its 64-bit number, a window by 96 bits of two independent chains: among
10**13 windows two different ones agree with probability below 0.001.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import schema_of, to_batch
from klaxon.llm.words import mixed

WINDOW = 20
# Bytes of text in a batch and behind a part of the index.
BATCH_BYTES = 8 << 20
PART_BYTES = 16 << 20

PROBES = "part int, batch int, probes binary, blocks binary, twice binary"
WINDOWS = "part int, batch int, high binary, low binary, docs binary"
ANSWERS = "batch int, step int, part int, bits binary"
KEPT = "doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, kept string"

# Rows without an id count as later than all others.
NO_ID = np.iinfo(np.int64).max
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _pair(left, right):
    """Number of two runs of words in this order."""
    return mixed(left * _ODD + right)


def rolling(numbers, width):
    """Number of every run of ``width`` words, by its first; runs are put together from runs of
    powers of two. Shorter than ``width``: none."""
    if len(numbers) < width:
        return numbers[:0]
    found, covered, power, size = None, 0, mixed(numbers), 1
    while True:
        if width & size:
            if found is None:
                found = power
            else:
                last = min(len(found), len(power) - covered)
                found = _pair(found[:last], power[covered : covered + last])
            covered += size
        if covered == width:
            return found[: len(numbers) - width + 1]
        power = _pair(power[:-size], power[size:])
        size *= 2


class Batch:
    """Documents of a batch as one row of words and their numbers, with ``row``, the document of each,
    and ``starts``, the place where each document begins."""

    def __init__(self, table, window):
        self.window, self.block = window, window // 2
        table = table.combine_chunks()
        ids, texts = (_one(table.column(name)) for name in ("doc_id", "text"))
        self.ids = ids.fill_null(NO_ID).to_numpy()
        # Arrow's white space in ASCII is space and tab to carriage return.
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words, row = lists.flatten(), pc.list_parent_indices(lists)
        # White space at the ends leaves empty words.
        full = pc.greater(pc.binary_length(words), 0)
        self.words, self.row = words.filter(full), row.filter(full).to_numpy()
        self.lengths = np.bincount(self.row, minlength=len(ids)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        found = self.words.dictionary_encode()
        each = np.fromiter(
            map(xxhash.xxh3_64_intdigest, found.dictionary.to_numpy(zero_copy_only=False)),
            np.uint64,
            len(found.dictionary),
        )
        self.numbers = each[found.indices.to_numpy()]

    def _whole(self, width):
        """Whether the run of ``width`` words from each place stays in its document."""
        n = max(0, len(self.row) - width + 1)
        return self.row[:n] == self.row[len(self.row) - n :]

    def probes(self, parts):
        """(keys, place): distinct probes as part << 32 | value, ascending, and which one stands
        at each place (-1: none)."""
        number = rolling(self.numbers, self.block)
        part = (number & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
        key = (part << np.uint64(32)) | (number >> np.uint64(32))
        whole = self._whole(self.block)
        keys, inverse = np.unique(key[whole], return_inverse=True)
        place = np.full(len(whole), -1, np.int64)
        place[whole] = inverse
        return keys, place

    def at_block(self, places):
        """Whether an indexed block starts at each of the first ``places`` places."""
        at = np.arange(places)
        return (at - self.starts[self.row[:places]]) % self.block == 0

    def windows(self, hit):
        """Places of the windows around hits, and their digests of 64 and 32 bits."""
        whole = self._whole(self.window)
        if not len(whole):
            nothing = np.empty(0, np.int64)
            return nothing, nothing.astype(np.uint64), nothing.astype(np.uint32)
        sums = np.concatenate([[0], np.cumsum(hit)])
        inner = self.window - self.block + 1
        around = sums[inner : inner + len(whole)] > sums[: len(whole)]
        places = np.flatnonzero(whole & around)
        high = rolling(self.numbers, self.window)[places]
        low = rolling(self.numbers ^ _SALT, self.window)[places]
        return places, high, (low >> np.uint64(32)).astype(np.uint32)


def _one(column):
    """A column of a table as one array."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _by_part(parts_of):
    """(part, from, to) of the runs of equal parts."""
    edges = np.flatnonzero(np.diff(parts_of)) + 1
    for start, end in zip([0, *edges], [*edges, len(parts_of)]):
        if end > start:
            yield int(parts_of[start]), int(start), int(end)


def _bits(flags):
    return np.packbits(flags).tobytes()


def _flags(bits, size):
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)


def _send_probes(window, parts):
    def send(table: pa.Table) -> pa.Table:
        batch = Batch(table, window)
        number = table["batch"][0].as_py()
        keys, place = batch.probes(parts)
        used = place >= 0
        count = np.bincount(place[used], minlength=len(keys))
        block = np.zeros(len(keys), bool)
        block[place[used & batch.at_block(len(place))]] = True
        values = keys.astype(np.uint32)
        rows = [
            (part, number, values[a:b].tobytes(), _bits(block[a:b]), _bits(count[a:b] > 1))
            for part, a, b in _by_part(keys >> np.uint64(32))
        ]
        return pa.Table.from_batches([to_batch(rows, PROBES)])

    return send


def _answer_probes(table: pa.Table) -> pa.Table:
    """For each row of a part, which of its probes are an indexed block and occur elsewhere too."""
    rows = table.to_pylist()
    values = [np.frombuffer(row["probes"], np.uint32) for row in rows]
    sizes = [len(one) for one in values]
    flags = [[_flags(row[k], n) for row, n in zip(rows, sizes)] for k in ("blocks", "twice")]
    _, inverse, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    block, twice = (np.bincount(inverse, np.concatenate(one)) > 0 for one in flags)
    hit = (block & (twice | (count > 1)))[inverse]
    return _answers(rows, sizes, hit, 0)


def _answers(rows, sizes, flags, step):
    """One row of ANSWERS for each row with a flag."""
    edges = np.cumsum([0, *sizes])
    found = [
        (row["batch"], step, row["part"], _bits(flags[a:b]))
        for row, a, b in zip(rows, edges[:-1], edges[1:])
        if flags[a:b].any()
    ]
    return pa.Table.from_batches([to_batch(found, ANSWERS)])


def _read_answers(table, step, parts_of):
    """A flag per distinct value from the answers of its part."""
    found = np.zeros(len(parts_of), bool)
    bits = {
        row["part"]: row["bits"] for row in table.to_pylist() if row["step"] == step
    }
    for part, a, b in _by_part(parts_of):
        if part in bits:
            found[a:b] = _flags(bits[part], b - a)
    return found


def _hits(batch, answers, parts):
    keys, place = batch.probes(parts)
    hit = _read_answers(answers, 0, keys >> np.uint64(32))
    return np.where(place >= 0, hit[place], False) if len(keys) else np.zeros(len(place), bool)


def _distinct_windows(batch, places, high, low, parts):
    """(order, first, part): windows by part and digest, earliest document first; ``first`` marks
    the first of each digest in that order."""
    part = (high % np.uint64(parts)).astype(np.int64)
    doc = batch.ids[batch.row[places]]
    order = np.lexsort((places, doc, low, high, part))
    same = np.zeros(len(order), bool)
    same[1:] = (np.diff(high[order].view(np.int64)) == 0) & (low[order][1:] == low[order][:-1])
    return order, ~same, part[order]


def _send_windows(window, parts):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if len(table) and len(answers):
            batch = Batch(table, window)
            number = table["batch"][0].as_py()
            places, high, low = batch.windows(_hits(batch, answers, parts))
            order, first, part = _distinct_windows(batch, places, high, low, parts)
            chosen = order[first]
            high, low, docs = high[chosen], low[chosen], batch.ids[batch.row[places[chosen]]]
            rows = [
                (one, number, high[a:b].tobytes(), low[a:b].tobytes(), docs[a:b].tobytes())
                for one, a, b in _by_part(part[first])
            ]
        return pa.Table.from_batches([to_batch(rows, WINDOWS)])

    return send


def _answer_windows(table: pa.Table) -> pa.Table:
    """For each row of a part, which of its windows a document of smaller id has in another batch."""
    rows = table.to_pylist()
    kinds = (("high", np.uint64), ("low", np.uint32), ("docs", np.int64))
    high, low, docs = (
        np.concatenate([np.frombuffer(row[name], kind) for row in rows]) for name, kind in kinds
    )
    order = np.lexsort((docs, low, high))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(high[order].view(np.int64)) != 0) | (np.diff(low[order].view(np.int32)) != 0)
    least = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = least < docs[order]
    return _answers(rows, [len(row["low"]) // 4 for row in rows], earlier, 1)


def repeated_places(batch, answers, parts):
    """Places of the windows whose words also start earlier."""
    places, high, low = batch.windows(_hits(batch, answers, parts))
    order, first, part = _distinct_windows(batch, places, high, low, parts)
    if not len(order):
        return places
    earlier = _read_answers(answers, 1, part[first])
    group = np.cumsum(first) - 1
    row = batch.row[places[order]]
    leader = row[np.flatnonzero(first)][group]
    # Repeated in a document of smaller id, here or elsewhere, or earlier in the same row.
    repeated = earlier[group] | (batch.ids[row] > batch.ids[leader])
    # Rows of one id stand apart: sorted by place, the first window of a row has no earlier one.
    again = np.zeros(len(order), bool)
    again[1:] = (row[1:] == row[:-1]) & ~first[1:]
    return places[order[repeated | again]]


def _keep(window, parts):
    def keep(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return pa.Table.from_batches([], schema=schema_of(KEPT))
        batch = Batch(table, window)
        change = np.zeros(len(batch.row) + 1, np.int64)
        if len(answers):
            places = repeated_places(batch, answers, parts)
            np.add.at(change, places, 1)
            np.add.at(change, places + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        # Runs of removed words, none across documents.
        own = batch.starts[:-1][batch.lengths > 0]
        first, last = gone.copy(), gone.copy()
        first[1:] &= ~gone[:-1]
        first[own] = gone[own]
        last[:-1] &= ~gone[1:]
        last[own[1:] - 1] = gone[own[1:] - 1]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        runs = np.concatenate([[0], np.cumsum(np.bincount(batch.row[first], minlength=len(batch.ids)))])
        left = np.concatenate([[0], np.cumsum(~gone)])[batch.starts]
        kept = pa.ListArray.from_arrays(
            pa.array(left, pa.int32()), batch.words.filter(pa.array(~gone, pa.bool_()))
        )
        begin = batch.starts[batch.row]
        columns = [
            _one(table.column("doc_id")),
            pa.array(batch.lengths),
            pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.array(first - begin[first])),
            pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.array(last + 1 - begin[last])),
            pc.binary_join(kept, " "),
        ]
        return pa.Table.from_arrays(columns, schema=schema_of(KEPT))

    return keep


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of every document that no window of an earlier passage covers.

    A window counts as repeated if the same ``window`` words also start in a document of
    smaller ``doc_id``, or earlier in the same row; windows are judged on the texts as they
    are. Words are runs of bytes other than space and tab to carriage return.

    Returns one row per row of ``docs``: doc_id, n_words, starts and ends (the maximal
    repeated runs, as word positions from 0, ends excluded) and kept (the other words,
    joined by a space). Null, empty and short texts lose nothing. Rows that share a doc_id
    are not earlier than each other. Rows without doc_id come after all others and are not
    earlier than each other either. Other columns play no part. ``window`` is even.
    """
    if window < 2 or window % 2:
        raise ValueError(f"window must be an even number of words, not {window}")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    batches, parts = 1 + size // BATCH_BYTES, 1 + size // PART_BYTES
    # The input partition spreads a row that a table holds many times.
    number = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(batches))
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", number.cast("int").alias("batch")
    )
    probes = placed.groupBy("batch").applyInArrow(_send_probes(window, parts), PROBES)
    hits = probes.groupBy("part").applyInArrow(_answer_probes, ANSWERS)
    by_batch = placed.groupBy("batch")
    windows = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(
        _send_windows(window, parts), WINDOWS
    )
    earlier = windows.groupBy("part").applyInArrow(_answer_windows, ANSWERS)
    answers = hits.unionByName(earlier)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(_keep(window, parts), KEPT)
