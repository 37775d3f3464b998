"""Best-fit packing of tokenized documents after Martello and Toth's dominance reduction.

Each document becomes pieces of at most ``length`` tokens. Only the number of pieces of each
size matters for a packing, so the plan is made from a histogram with at most ``length``
rows: the reduction fixes pieces whose place is proven to be as good as any, and best fit
places the others. The plan says which ranks of which size go to which sequences; a join
on size and rank then places all pieces, wherever they are.
"""

import bisect
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import to_batch
from klaxon.llm.numbering import ranked
from klaxon.llm.tokens import BYTE, encoder
from klaxon.llm.tokens import pieces as texts_of
from klaxon.session import store

# Text that is encoded at once, and words that a worker remembers: packing comes last in a
# pipeline, when executors have grown.
TEXT_BYTES = 4 << 20
WORDS_KEPT = 100_000

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"
PLAN = "size int, first bigint, last bigint, sequence bigint, each int, place int"


def pieces_of(total, length):
    """(start, end) of each piece: full ones, behind one that holds the rest."""
    cuts = list(range(total % length or length, total, length))
    return zip([0, *cuts], [*cuts, total])


def cut_documents(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Pieces of the token ids of every document, ``end_id`` included.

    A null or empty text is one piece that holds ``end_id`` alone. Columns of ``docs`` other
    than ``doc_id`` and ``text`` play no part; a null ``doc_id`` stays null.
    """

    schema = PIECES + (", ids binary" if keep_ids else "")

    def cut(batches):
        encode = encoder(path, BYTE, WORDS_KEPT).encode
        end_bytes = end_id.to_bytes(4, "little")
        for batch in texts_of(batches, 1, TEXT_BYTES):
            rows = []
            ids, starts = encode(batch.column(1))
            for doc, a, b in zip(batch.column(0).to_pylist(), starts[:-1], starts[1:]):
                encoded = ids[a:b].astype("<u4").tobytes() + end_bytes
                for piece, (start, end) in enumerate(pieces_of(len(encoded) // 4, length)):
                    body = encoded[4 * start : 4 * end]
                    row = (doc, piece, start, end - start, zlib.crc32(body))
                    rows.append((*row, body) if keep_ids else row)
            yield to_batch(rows, schema)

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return chosen.mapInArrow(cut, schema)


# -- the plan, from the number of pieces of each size ----------------------------------


class _Sizes:
    """Sizes still to be placed, ascending, with their numbers."""

    def __init__(self, counts):
        self.count = {size: n for size, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, size, n):
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.order[bisect.bisect_left(self.order, size)]

    def fitting(self, room):
        """The largest size that fits, or 0."""
        at = bisect.bisect_right(self.order, room)
        return self.order[at - 1] if at else 0

    def smallest(self, n, beside):
        """Sum of the ``n`` smallest pieces besides one of size ``beside``."""
        total = 0
        for size in self.order:
            number = min(n, self.count[size] - (size == beside))
            total, n = total + size * number, n - number
            if not n:
                return total
        return float("inf")


def reduce_by_dominance(sizes, capacity):
    """Fix sequences that dominate every other sequence with their largest piece.

    For a piece with room ``r`` beside it, largest pieces first:

    - nothing fits: it stays alone;
    - the largest fitting piece fills ``r``: it takes the place of whatever else could;
    - no two pieces fit together: the largest fitting one takes the place of any other.

    In each case some best packing holds the fixed sequence, so it may be cut off and the
    rules applied to the rest. Yields (sizes of the sequence, how often).
    """
    for size in list(reversed(sizes.order)):
        while size in sizes.count:
            room, number = capacity - size, sizes.count[size]
            other = sizes.fitting(room)
            if other == size and number == 1:
                at = bisect.bisect_left(sizes.order, size)
                other = sizes.order[at - 1] if at else 0
            if not other:
                yield (size,), number
                sizes.take(size, number)
            elif other == room or sizes.smallest(2, size) > room:
                times = number // 2 if other == size else min(number, sizes.count[other])
                yield (size, other), times
                sizes.take(size, times)
                sizes.take(other, times)
            else:
                break


def best_fit(sizes, capacity):
    """Best fit, largest piece first: each goes where it leaves the least room.

    Sequences with the same pieces are kept together with their number. A sequence that
    takes a piece is the fullest that fits the next one of that size, so it takes as many
    as it can. Yields (sizes of the sequence, how often).
    """
    by_room, rooms = {}, []

    def add(pattern, room, times):
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((pattern, times))

    for size in reversed(sizes.order):
        left = sizes.count[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = min(capacity // size, left)
                add((size,) * each, capacity - each * size, left // each)
                left %= each
                continue
            room = rooms[at]
            pattern, times = by_room[room].pop()
            each = min(room // size, left)
            filled = min(times, left // each)
            if filled < times:
                by_room[room].append((pattern, times - filled))
            elif not by_room[room]:
                del by_room[room]
                del rooms[at]
            add(pattern + (size,) * each, room - each * size, filled)
            left -= filled * each
    for patterns in by_room.values():
        yield from patterns


def plan_sequences(counts, capacity):
    """Rows of PLAN for all pieces.

    Ranks ``first`` to ``last`` of a size go to sequences from ``sequence`` on, ``each`` to
    a sequence, from offset ``place`` on.
    """
    sizes = _Sizes(counts)
    used, sequence, rows = dict.fromkeys(counts, 0), 0, []
    patterns = [*reduce_by_dominance(sizes, capacity), *best_fit(sizes, capacity)]
    for pattern, times in patterns:
        place = 0
        for size, each in Counter(pattern).items():
            rows.append((size, used[size], used[size] + each * times, sequence, each, place))
            used[size] += each * times
            place += each * size
        sequence += times
    return rows


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    # At most one row for each size up to the capacity.
    counts = pieces.groupBy("length").count().collect()
    rows = plan_sequences({row["length"]: row["count"] for row in counts}, capacity)
    plan = spark.createDataFrame(rows, PLAN)
    numbered = ranked(pieces, ["length"], "_rank")
    # The plan holds a few rows for each size, however many pieces there are.
    matched = numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("size"))
        & (F.col("_rank") >= F.col("first"))
        & (F.col("_rank") < F.col("last")),
    )
    at = F.col("_rank") - F.col("first")
    return matched.select(
        *pieces.columns,
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("place") + (at % F.col("each")) * F.col("size")).cast("bigint").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """All documents packed into as few sequences of ``length`` tokens as best fit finds.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id,
    offset. Repeated documents are packed as often as they occur; an empty table gives no
    rows. Pieces are cut once and stored, as they are counted before they are placed.
    """
    pieces = store(cut_documents(docs, path, length, end_id, keep_ids), "pieces")
    placed = place(pieces, length)
    return placed.withColumn("length", F.col("length").cast("bigint"))
