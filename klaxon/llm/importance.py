"""Documents drawn by importance: those whose runs of words a target text collection favours.

Every run of 1 to 3 words falls into one of ``BUCKETS`` buckets. A bucket's gain compares its
share among the target's runs with that among all documents'. A document's weight is the
sum of its runs' gains, a score adds Gumbel noise from a hash of its id, and the highest
scores are drawn: sampling without replacement in proportion to the weights' exponentials.

Tables grow with nothing but ``BUCKETS``: a task sends one count per bucket, the driver
sends one gain per bucket. Two passes read the texts, none shuffles them.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import schema_of, slices
from klaxon.llm.ngram_table import NgramTable
from klaxon.llm.numbering import partitions_of, ranked
from klaxon.session import settle, store

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# A text of this many bytes is put into a table of its own.
BYTES_AT_ONCE = 2 << 20

COUNTS = "bucket bigint, n bigint"
WEIGHTS = "doc_id bigint, n_features bigint, weight bigint, n_words bigint"


def _pieces(batches):
    """Batches of at most 256 rows and about ``BYTES_AT_ONCE`` bytes of text."""
    for batch in slices(batches):
        texts = batch.column(batch.num_columns - 1)
        sizes = pc.binary_length(texts).fill_null(0).to_pylist()
        start, total = 0, 0
        for at, size in enumerate(sizes):
            if at > start and total + size > BYTES_AT_ONCE:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += size
        yield batch.slice(start)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many runs of all ``texts`` (one column) fall into each bucket."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for piece in _pieces(batches):
            table = NgramTable(piece.column(0), LONGEST, BUCKETS)
            # Exact: a batch has fewer runs than a double has whole numbers.
            total += np.bincount(table.bucket, table.count, BUCKETS).astype(np.int64)
        some = np.flatnonzero(total)
        columns = [pa.array(some), pa.array(total[some])]
        yield pa.RecordBatch.from_arrays(columns, schema=schema_of(COUNTS))

    found = texts.mapInArrow(count, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, object)
    for bucket, n in found.collect():
        counts[bucket] = n
    return counts


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's share in the target over that in all documents,
    each count raised by one."""
    s_all, t_all = float(sum(documents) + BUCKETS), float(sum(target) + BUCKETS)
    shares = [(t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(documents, target)]
    return np.array([math.floor(1000 * math.log(share)) for share in shares], np.int64)


def weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """Number of runs, sum of their gains and number of words of every document."""

    def weigh(batches):
        for piece in _pieces(batches):
            table = NgramTable(piece.column(1), LONGEST, BUCKETS)
            rows = len(piece)
            gain = gains[table.bucket][table.slot]
            found = np.bincount(table.row, gain, rows).astype(np.int64)
            columns = [
                piece.column(0),
                pa.array(np.bincount(table.row, minlength=rows)),
                pa.array(found),
                pa.array(np.bincount(table.words.row, minlength=rows)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema_of(WEIGHTS))

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return chosen.mapInArrow(weigh, WEIGHTS)


def importance_sample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Every document with its score, and its rank if it is drawn.

    Words are runs of digits, letters A-Z (in lower case) and characters beyond ASCII.
    Drawn are the ``PERCENT`` per cent (rounded down) with the highest scores of the
    documents of ``LEAST_WORDS`` words or more; of equal scores the smaller ``doc_id``, then
    the fewer runs.

    Returns doc_id, n_features, weight, score, rank (from 1; null if not drawn). Null and
    empty texts have no runs and weight 0. Each row counts by itself: rows that share a
    doc_id share their noise. Rows without doc_id take that of an empty id and lose ties. Other
    columns play no part. With an empty target all gains are those of its smoothing.
    """
    known = bucket_counts(docs.select("text"))
    gains = bucket_gains(known, bucket_counts(target.select("text")))
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))
    # Sorting reads them twice.
    weighed = store(weights(docs, gains), "weights")
    scored = weighed.select(
        "*",
        (F.col("weight") + noise).alias("score"),
        (F.col("n_words") >= LEAST_WORDS).alias("eligible"),
    )
    order = [
        F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
        F.col("n_features"), F.col("weight"),
    ]
    parts = partitions_of(docs.sparkSession)
    # Kept partition by partition, so a row's place is that of its partition and its own in it.
    placed = settle(scored.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    drawn = placed.filter("eligible").count() * PERCENT // 100
    return ranked(placed, [], "place").select(
        "doc_id",
        "n_features",
        "weight",
        "score",
        F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"),
    )
