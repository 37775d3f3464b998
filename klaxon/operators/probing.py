"""Approximate neighbours by multi-probe hashing, with tables and probes chosen by measurement.

A table hashes a vector to the sides on which it lies of some random planes through the mean
of the corpus. A query probes the occupied buckets of a table in the order of their distance:
the squares of its distances to those planes that lie between. It goes on until the
buckets hold a given share of the corpus. Which share in how many tables gives the wanted
recall at the least work is measured on a bounded sample of queries, whose exact
neighbours say how far down the order each would have had to go.

The directory of occupied buckets is all that goes to the driver and to every task. It has
at most ``BUCKETS`` rows per table: beyond that many corpus rows a code has so many bits.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.functions.nearest import matrix
from klaxon.operators import similarity
from klaxon.session import settle, store

TABLES = 16
BUCKETS = 1 << 16
# Bits of a code where the corpus has few rows.
BITS = 32
# Queries whose exact neighbours are searched to choose the plan.
SAMPLE = 200
# Distances between queries and buckets that are held at once.
SCORES_AT_ONCE = 1 << 19
# Queries that a task probes at once, and numbers of buckets that it lists for them.
QUERIES_AT_ONCE = 64
LISTED_AT_ONCE = 1 << 19


@dataclass(frozen=True)
class ProbingPlan:
    """Tables to use, share of the corpus to probe in each, and what the sample showed."""

    tables: int
    share: float
    recall: float


class ProbingIndex:
    """Codes of a corpus in all tables, stored, and their directory."""

    def __init__(
        self, corpus: DataFrame, corpus_id: str = "id", vector: str = "embedding", seed: int = 42
    ):
        self.corpus_id, self.vector = corpus_id, vector
        corpus = corpus.select(corpus_id, vector).filter(F.col(vector).isNotNull())
        self.rows, mean = corpus.count(), np.empty(0)
        if self.rows:
            summary = Summarizer.mean(array_to_vector(vector))
            mean = np.array(corpus.agg(vector_to_array(summary)).first()[0])
        self.dim = len(mean)
        bits = BITS if self.rows <= BUCKETS else BUCKETS.bit_length() - 1
        rng = np.random.default_rng(seed)
        self.planes = [_planes(rng, self.dim, bits) for _ in range(TABLES)]
        self.offsets = [mean @ planes for planes in self.planes]
        self.corpus = store(self._coded(corpus), "codes")
        sizes = self.corpus.select(F.explode("_buckets").alias("bucket")).groupBy("bucket").count()
        # Bounded by TABLES * BUCKETS.
        found = sizes.toArrow()
        buckets, counts = (found.column(i).to_numpy() for i in range(2))
        order = np.argsort(buckets)
        self.buckets, self.counts = buckets[order], counts[order]

    def _coded(self, df: DataFrame) -> DataFrame:
        planes, offsets, dim = self.planes, self.offsets, self.dim

        def code(batches):
            for batch in batches:
                vectors = matrix(batch.column(1), dim)
                codes = np.empty((len(batch), TABLES), np.int64)
                for table in range(TABLES):
                    sides = vectors @ planes[table] > offsets[table]
                    weights = np.int64(1) << np.arange(sides.shape[1])
                    codes[:, table] = sides @ weights + (table << BITS)
                ends = np.arange(len(batch) + 1, dtype=np.int32) * TABLES
                listed = pa.ListArray.from_arrays(ends, codes.ravel())
                columns = [*batch.columns, listed]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_buckets"])

        numbers = T.StructField("_buckets", T.ArrayType(T.LongType()))
        return df.mapInArrow(code, T.StructType([*df.schema.fields, numbers]))

    def plan(
        self,
        queries: DataFrame,
        k: int,
        recall: float = 0.9,
        query_id: str = "query_id",
        sample: int = SAMPLE,
    ) -> ProbingPlan:
        """The cheapest plan that finds ``recall`` of the exact ``k`` nearest of a sample of queries.

        The sample are the queries of smallest hash. As it only shows the queries it holds,
        the plan aims above ``recall`` by twice the standard error of its mean.
        """
        some = queries.select(query_id, self.vector).filter(F.col(self.vector).isNotNull())
        some = settle(some.orderBy(F.xxhash64(query_id), query_id).limit(sample))
        nothing = ProbingPlan(1, 1.0, 1.0)
        if not self.rows or some.isEmpty():
            return nothing
        # One query per row of the sample, so few that they are sent to the corpus.
        numbered = some.select(F.xxhash64(query_id).alias("_q"), self.vector).dropDuplicates(["_q"])
        numbered = settle(numbered)
        corpus = self.corpus.select(self.corpus_id, self.vector)
        found = settle(similarity.knn_exact(numbered, corpus, k, "_q", self.corpus_id, self.vector))
        codes = self.corpus.select(self.corpus_id, "_buckets")
        wanted = codes.join(F.broadcast(found.select("_q", self.corpus_id)), self.corpus_id)
        wanted = wanted.dropDuplicates(["_q", self.corpus_id]).select("_q", "_buckets").toArrow()
        vectors = numbered.toArrow()
        row_of = {q: row for row, q in enumerate(vectors.column("_q").to_pylist())}
        rows = np.array([row_of[q] for q in wanted.column("_q").to_pylist()])
        given = np.array(wanted.column("_buckets").to_pylist()).reshape(len(rows), TABLES)
        asked = matrix(vectors.column(self.vector), self.dim)
        # Share of the corpus up to each wanted row's bucket, by table.
        need = np.empty(given.shape)
        for table in range(TABLES):
            for first, buckets, counts, scores in _scores(self, table, asked):
                order = np.argsort(scores, axis=1, kind="stable")
                shares = np.empty(scores.shape)
                np.put_along_axis(shares, order, np.cumsum(counts[order], axis=1) / self.rows, axis=1)
                here = np.flatnonzero((rows >= first) & (rows < first + len(scores)))
                at = np.searchsorted(buckets, given[here, table])
                need[here, table] = shares[rows[here] - first, at]
        n = len(need)
        aim = min(1.0, recall + 2 * (recall * (1 - recall) / n) ** 0.5)
        plans = []
        for tables in range(1, TABLES + 1):
            least = np.sort(need[:, :tables].min(axis=1))
            share = float(least[min(n, int(np.ceil(aim * n))) - 1])
            plans.append(ProbingPlan(tables, share, float((least <= share).mean())))
        return min(plans, key=lambda plan: (plan.tables * plan.share, plan.tables))

    def probes(
        self, queries: DataFrame, plan: ProbingPlan, query_id: str = "query_id"
    ) -> DataFrame:
        """Queries with their buckets: id, vector, ``_buckets``, ``_compared`` (rows in them, those
        that share several buckets counted for each)."""
        queries = queries.select(query_id, self.vector).filter(F.col(self.vector).isNotNull())
        directory = queries.sparkSession.sparkContext.broadcast((self.buckets, self.counts))
        small = _Directory(self, directory)

        def probe(batches):
            for batch in batches:
                for at in range(0, len(batch), QUERIES_AT_ONCE):
                    yield from small.probed(batch.slice(at, QUERIES_AT_ONCE), plan)

        fields = [
            *queries.schema.fields,
            T.StructField("_buckets", T.ArrayType(T.LongType())),
            T.StructField("_compared", T.LongType()),
        ]
        return queries.mapInArrow(probe, T.StructType(fields))

    def search(
        self, queries: DataFrame, k: int, plan: ProbingPlan, query_id: str = "query_id"
    ) -> DataFrame:
        """Up to ``k`` near corpus rows of every query, as :func:`knn_lsh` gives them."""
        schema = similarity._result_schema(
            queries.schema[query_id], self.corpus.schema[self.corpus_id]
        )
        if not self.rows:
            return queries.sparkSession.createDataFrame([], schema)
        similarity._check_query_ids(queries, query_id)
        probed = store(self.probes(queries, plan, query_id).drop("_compared"), "probes")
        tables = F.slice("_buckets", 1, plan.tables).alias("_buckets")
        corpus = self.corpus.select(self.corpus_id, self.vector, tables)
        cell_rows = similarity._rows_within(similarity.CELL_BYTES, self.dim)
        found = similarity.compare_shared(probed, corpus, k, self.dim, schema, cell_rows)
        return similarity._best(found.drop("rank").distinct(), k, query_id, self.corpus_id)


def knn_probed(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    recall: float = 0.9,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "embedding",
) -> DataFrame:
    """Up to ``k`` near corpus rows of every query, of which about ``recall`` of the exact nearest.

    Distances are exact. The recall is that of a sample of ``SAMPLE`` queries, aimed at with
    a margin. Vectors that vary alike in all directions take many probes, those with
    structure few. Ids and vectors as in :mod:`klaxon.operators.similarity`; corpus rows
    with the same id at the same distance count once.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    index = ProbingIndex(corpus, corpus_id, vector)
    return index.search(queries, k, index.plan(queries, k, recall, query_id), query_id)


def _planes(rng, dim, bits):
    """Directions of planes; at right angles as far as there are dimensions."""
    blocks = []
    for start in range(0, bits, max(1, dim)):
        made = rng.normal(size=(dim, dim))
        blocks.append(np.linalg.qr(made)[0] if dim else made)
    return np.concatenate(blocks, axis=1)[:, :bits] if dim else np.empty((0, bits))


def _scores(index, table, vectors):
    """(first vector, buckets, counts, squared distance of each vector to every bucket) of a table,
    for so many vectors at a time that their distances stay within ``SCORES_AT_ONCE``."""
    first, last = np.searchsorted(index.buckets, [table << BITS, (table + 1) << BITS])
    buckets, counts = index.buckets[first:last], index.counts[first:last]
    planes = index.planes[table]
    gap = vectors @ planes - index.offsets[table]
    square = gap**2
    # Planes between: those on whose other side the bucket lies.
    above = np.where(gap > 0, square, 0)
    either = square - 2 * above
    sides = np.empty((planes.shape[1], len(buckets)))
    for bit, side in enumerate(sides):
        side[:] = (buckets >> bit) & 1
    step = max(1, SCORES_AT_ONCE // max(1, len(buckets)))
    for at in range(0, len(vectors), step):
        some = slice(at, at + step)
        scores = either[some] @ sides
        scores += above[some].sum(axis=1)[:, None]
        yield at, buckets, counts, scores


class _Directory:
    """What a task needs to probe: planes and the broadcast directory."""

    def __init__(self, index, directory):
        self.planes, self.offsets, self.dim = index.planes, index.offsets, index.dim
        self.rows, self.directory = index.rows, directory

    def probed(self, batch, plan):
        self.buckets, self.counts = self.directory.value
        vectors = matrix(batch.column(1), self.dim)
        chosen, compared = [[] for _ in range(len(batch))], np.zeros(len(batch), np.int64)
        for table in range(plan.tables):
            for first, buckets, counts, scores in _scores(self, table, vectors):
                order = np.argsort(scores, axis=1, kind="stable")
                sums = np.cumsum(counts[order], axis=1)
                # The bucket that reaches the share is the last.
                last = np.count_nonzero(sums < plan.share * self.rows * (1 - 1e-12), axis=1)
                last = np.minimum(last, len(buckets) - 1)
                compared[first : first + len(last)] += sums[np.arange(len(last)), last]
                for row, end in enumerate(last):
                    chosen[first + row].append(buckets[order[row, : end + 1]])
        names = [*batch.schema.names, "_buckets", "_compared"]
        ends = np.cumsum([sum(map(len, one)) for one in chosen])
        start = 0
        while start < len(batch):
            # As many queries as fit, at least one.
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + LISTED_AT_ONCE, "right")))
            listed = [one for some in chosen[start:end] for one in some]
            bounds = np.concatenate([[0], ends[start:end] - before]).astype(np.int32)
            found = pa.ListArray.from_arrays(bounds, np.concatenate(listed))
            columns = [*batch.slice(start, end - start).columns, found, pa.array(compared[start:end])]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            start = end
