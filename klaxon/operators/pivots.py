"""Exact neighbours of two large sides by pivots and the triangle inequality.

Every corpus row belongs to the cell of its nearest pivot. A query first visits its nearest
cells until they hold ``k`` rows; the distance of the k-th nearest of those bounds its
search. In a second round it visits the other cells that may still hold something as near: a
row of a cell is at least as far from the query as the cell's ring around its pivot, and as
the plane between that pivot and the query's own. All other cells are proven empty for it.

Pivots are a bounded sample of the corpus; with one row of bounds per cell they are all that
goes to the driver and to every task. The corpus moves once a round, to its cell; a query
moves once for every cell it visits. How many that are is the data's: vectors that vary
alike in many directions rule nothing out, and each query then visits all cells.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.functions.nearest import matrix
from klaxon.operators import similarity
from klaxon.session import store

# Pivots, and bytes of them, at most.
PIVOTS = 4096
PIVOT_BYTES = 16 << 20
# Relative error of a distance that a product of matrices gives, with a margin.
ERROR = 1e-6
ROWS_AT_ONCE = 1024


def knn_pivots(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    cell_bytes: int = similarity.CELL_BYTES,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query, exactly, for sides of any size.

    Answers as :func:`klaxon.operators.similarity.knn_exact` does, repeated corpus ids
    included. The number of pivots is the square root of the corpus's rows within ``pivots``.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    queries = similarity._keyed(queries, query_id, vector)
    corpus = similarity._keyed(corpus, corpus_id, vector)
    similarity._check_query_ids(queries, query_id)
    schema = similarity._result_schema(queries.schema[query_id], corpus.schema[corpus_id])
    rows = corpus.count()
    if not rows:
        return queries.sparkSession.createDataFrame([], schema)
    dim = corpus.select(F.size(vector)).first()[0]
    number = min(pivots, math.isqrt(rows) + 1, max(1, PIVOT_BYTES // (8 * max(1, dim))))
    order = [F.xxhash64(vector), F.xxhash64(corpus_id)]
    # Rows of one vector have one hash, so they take one place among the candidates.
    some = corpus.dropDuplicates([vector]).orderBy(*order).limit(number).select(vector).toArrow()
    shipped = queries.sparkSession.sparkContext.broadcast(matrix(some.column(0), dim).astype(float))

    placed = store(_nearest_pivot(corpus, vector, shipped, dim), "cells")
    # One row per pivot.
    bounds = placed.groupBy("_cell").agg(
        F.count("*").alias("n"), F.min("_gap").alias("least"), F.max("_gap").alias("most")
    )
    cells = {row["_cell"]: (row["n"], row["least"], row["most"]) for row in bounds.collect()}
    members = placed.select(corpus_id, vector, F.array("_cell").alias("_buckets"))
    cell_rows = similarity._rows_within(cell_bytes, dim)

    first = store(_visits(queries, vector, shipped, cells, dim, k, None), "visits")
    near = store(_in_cells(first, members, k, dim, schema, cell_rows, corpus_id), "near")
    # The k-th distance of a query, infinite if its cells hold fewer rows.
    kth = near.filter(F.col("rank") == k).select(F.col(query_id).alias("_id"), F.col("l2").alias("_l2"))
    left = first.join(kth, first[query_id] == kth["_id"], "left")
    left = left.select(query_id, vector, F.coalesce("_l2", F.lit(float("inf"))).alias("_l2"))
    rest = store(_visits(left, vector, shipped, cells, dim, k, "_l2"), "visits")
    far = _in_cells(rest, members, k, dim, schema, cell_rows, corpus_id)
    return similarity._best(near.unionByName(far), k, query_id, corpus_id)


def _in_cells(visits, members, k, dim, schema, cell_rows, corpus_id) -> DataFrame:
    found = similarity.compare_shared(visits, members, k, dim, schema, cell_rows)
    return similarity._best(found, k, schema.names[0], corpus_id)


def _gaps(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every vector to every pivot."""
    square = np.einsum("ij,ij->i", vectors, vectors)[:, None]
    square = square + np.einsum("ij,ij->i", pivots, pivots) - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def _nearest_pivot(corpus, vector, shipped, dim) -> DataFrame:
    """Corpus rows with ``_cell`` and ``_gap``, the distance to the cell's pivot."""

    def place(batches):
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                gaps = _gaps(matrix(some.column(1), dim).astype(float), shipped.value)
                cell = gaps.argmin(axis=1)
                columns = [pa.array(cell), pa.array(gaps[np.arange(len(some)), cell])]
                names = [*some.schema.names, "_cell", "_gap"]
                yield pa.RecordBatch.from_arrays([*some.columns, *columns], names=names)

    fields = [T.StructField("_cell", T.LongType()), T.StructField("_gap", T.DoubleType())]
    return corpus.mapInArrow(place, T.StructType([*corpus.schema.fields, *fields]))


def least_gaps(gaps: np.ndarray, pivots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A lower bound of the distance of every query to any row of every cell.

    ``gaps``: distances of queries to pivots; ``bounds``: least and greatest distance of a cell's
    rows to its pivot.
    """
    ring = np.maximum(gaps - bounds[:, 1], bounds[:, 0] - gaps)
    own = gaps.argmin(axis=1)
    between = _gaps(pivots, pivots)[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (gaps**2 - gaps.min(axis=1)[:, None] ** 2) / (2 * between)
    plane = np.where(between > 0, plane, 0)
    # What rounding may have added.
    scale = np.maximum(gaps, np.sqrt(np.einsum("ij,ij->i", pivots, pivots)).max(initial=0))
    return np.maximum(np.maximum(ring, plane) - ERROR * (scale + bounds[:, 1]), 0)


def _visits(queries, vector, shipped, cells, dim, k, bound) -> DataFrame:
    """Queries with ``_buckets``, the cells they visit: in the first round the nearest ones with
    ``k`` rows, in the second all others within ``bound`` (a squared distance)."""
    numbers = np.array(sorted(cells))
    known = np.array([cells[cell] for cell in numbers], float)
    id_name = queries.columns[0]

    def visit(batches):
        pivots = shipped.value[numbers]
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                gaps = _gaps(matrix(some.column(1), dim).astype(float), pivots)
                order = np.argsort(gaps, axis=1, kind="stable")
                before = np.cumsum(known[order, 0], axis=1) - known[order, 0]
                chosen = np.zeros(gaps.shape, bool)
                np.put_along_axis(chosen, order, before < k, axis=1)
                if bound is not None:
                    limit = some.column(2).to_numpy()[:, None]
                    chosen = ~chosen & (least_gaps(gaps, pivots, known[:, 1:]) ** 2 <= limit)
                ends = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))]).astype(np.int32)
                listed = pa.ListArray.from_arrays(ends, numbers[np.nonzero(chosen)[1]])
                names = [id_name, vector, "_buckets"]
                yield pa.RecordBatch.from_arrays([*some.columns[:2], listed], names=names)

    fields = [queries.schema[id_name], queries.schema[vector]]
    fields.append(T.StructField("_buckets", T.ArrayType(T.LongType())))
    return queries.mapInArrow(visit, T.StructType(fields))
