"""Neighbours by L2 distance between vectors stored in ``array<float>`` columns.

Ids are numbers or text, and not NULL. A query id names one query: repeated ones are an
error. A corpus id may repeat: each of its rows is a neighbour of its own, whichever route
a search takes. Rows whose vector is NULL neither find nor are neighbours; vectors of mixed
lengths are an error. Frames are measured before they are searched, so pass stored ones
rather than long plans. Results have the two ids, ``l2`` (squared distance, double) and
``rank`` from 1; equal distances rank by corpus id.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.functions.nearest import Nearest, NearestInBuckets, matrix, sortable_ids
from klaxon.operators.joins import fits_broadcast, left_join_settled
from klaxon.session import settle, store

# Bytes of vectors that may be sent to every task, and that one side of a cell may hold.
SHIP_BYTES = 64 << 20
CELL_BYTES = 64 << 20
# Rows that one task may emit for queries that were sent to it.
EMIT_ROWS = 500_000


def knn_exact(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "embedding",
    ship_bytes: int = SHIP_BYTES,
    cell_bytes: int = CELL_BYTES,
    all_pairs: bool = False,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query, exactly.

    The route follows from measured sizes, the answer does not depend on it. A corpus
    within ``ship_bytes`` goes to the tasks that read the queries, and no vector shuffles.
    Otherwise queries within bounds go to the tasks that read the corpus, of which each
    returns its best ``k`` per query. With both sides large, cells of bounded size are
    compared. That takes work in proportion to queries x corpus and happens only with
    ``all_pairs``; without it such sides are an error, and ``knn_pivots`` or ``knn_probed`` are
    the way.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    queries = _keyed(queries, query_id, vector)
    corpus = _keyed(corpus, corpus_id, vector)
    _check_query_ids(queries, query_id)
    schema = _result_schema(queries.schema[query_id], corpus.schema[corpus_id])
    first = corpus.select(F.size(vector)).first()
    if first is None:
        return queries.sparkSession.createDataFrame([], schema)
    dim = first[0]
    ship_rows = _rows_within(ship_bytes, dim)
    if not _more_than(corpus, ship_rows):
        return _scan_queries(queries, corpus, k, dim, schema)
    if not _more_than(queries, min(ship_rows, max(1, EMIT_ROWS // k))):
        found = _scan_corpus(queries, corpus, k, dim, schema)
    elif not all_pairs:
        raise ValueError(
            f"queries and corpus both exceed {ship_bytes} bytes: pass all_pairs=True to compare"
            " every pair, or use knn_pivots or knn_probed"
        )
    else:
        cell_rows = _rows_within(cell_bytes, dim)
        found = _compare_cells(queries, corpus, k, dim, schema, cell_rows)
    return _best(found, k, query_id, corpus_id)


def knn_lsh(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    bucket_length: float,
    tables: int = 8,
    hashes_per_table: int = 6,
    seed: int = 42,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "embedding",
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Up to ``k`` near corpus rows of every query, from shared hash buckets only.

    Distances are exact, but a neighbour that shares no bucket is missed. More ``tables``
    find more; more ``hashes_per_table`` or a smaller ``bucket_length`` compare less. They
    are the caller's to choose, by the distances that matter and the size of the corpus.

    Every pair that shares a bucket is compared, however full the bucket is: full ones
    are cut into cells on both sides. Corpus rows with the same id at the same distance
    count once here, as a pair may meet in several buckets.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    queries = _keyed(queries, query_id, vector)
    corpus = _keyed(corpus, corpus_id, vector)
    _check_query_ids(queries, query_id)
    schema = _result_schema(queries.schema[query_id], corpus.schema[corpus_id])
    first = corpus.select(F.size(vector)).first()
    if first is None:
        return queries.sparkSession.createDataFrame([], schema)
    dim = first[0]
    cell_rows = _rows_within(cell_bytes, dim)
    # Fitting draws random directions and takes no more than the dimension from its input.
    zero = F.array_repeat(F.lit(0.0), dim)
    sample = queries.sparkSession.range(1).select(array_to_vector(zero).alias("_vector"))
    hasher = BucketedRandomProjectionLSH(
        inputCol="_vector",
        outputCol="_hashes",
        bucketLength=bucket_length,
        numHashTables=tables * hashes_per_table,
        seed=seed,
    ).fit(sample)

    def hashed(df: DataFrame) -> DataFrame:
        """Rows with their bucket of each table, written once and read three times."""
        rows = hasher.transform(df.withColumn("_vector", array_to_vector(vector)))
        buckets = [
            F.xxhash64(F.lit(t), F.slice("_hashes", t * hashes_per_table + 1, hashes_per_table))
            for t in range(tables)
        ]
        return store(rows.select(*df.columns, F.array(*buckets).alias("_buckets")), "hashed")

    found = compare_shared(hashed(queries), hashed(corpus), k, dim, schema, cell_rows)
    # A pair that shares several buckets comes once for each.
    return _best(found.drop("rank").distinct(), k, query_id, corpus_id)


def compare_shared(
    queries: DataFrame, corpus: DataFrame, k: int, dim: int, schema: T.StructType, cell_rows: int
) -> DataFrame:
    """Best ``k`` corpus rows of every query within each bucket that both have.

    Both sides are stored and have an id, a vector and ``_buckets``, an array of numbers.
    Full buckets are cut into cells of ``cell_rows`` on both sides.
    """
    query_id, corpus_id, vector = *schema.names[:2], queries.columns[1]
    bucket = F.explode("_buckets").alias("_bucket")
    sizes = (
        queries.select(bucket, F.lit(1).alias("_q"), F.lit(0).alias("_c"))
        .union(corpus.select(bucket, F.lit(0), F.lit(1)))
        .groupBy("_bucket")
        .agg(F.sum("_q").alias("_q"), F.sum("_c").alias("_c"))
    )
    def cells(rows: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / cell_rows), F.lit(1)).cast("int")

    shared = settle(
        sizes.filter((F.col("_q") > 0) & (F.col("_c") > 0)).select(
            "_bucket",
            cells("_q").alias("_q_cells"),
            cells("_c").alias("_c_cells"),
            (F.col("_q") + F.col("_c")).alias("_rows"),
        )
    )
    placed_rows = shared.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    shared = shared.drop("_rows")
    few = fits_broadcast(shared)
    full = shared.filter((F.col("_q_cells") > 1) | (F.col("_c_cells") > 1))
    slots = max(1, math.ceil(placed_rows / cell_rows))

    def placed(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        rows = df.select(key, vector, bucket)
        if few:
            # Rows in buckets of one side only stay where they are.
            rows = rows.join(F.broadcast(shared), "_bucket")
        else:
            rows = left_join_settled(rows, full, ["_bucket"])
        own_cells = F.coalesce(F.col(own + "s"), F.lit(1))
        other_cells = F.coalesce(F.col(other + "s"), F.lit(1))
        return rows.select(
            key,
            vector,
            "_bucket",
            F.pmod("_bucket", F.lit(slots)).alias("_slot"),
            F.pmod(F.xxhash64(key), own_cells).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), other_cells - 1)).alias(other),
        )

    return _cogroup(
        placed(queries, query_id, "_q_cell", "_c_cell"),
        placed(corpus, corpus_id, "_c_cell", "_q_cell"),
        ["_slot", "_q_cell", "_c_cell"],
        k, dim, schema, (query_id, corpus_id, vector, "_bucket"),
    )


def _rows_within(size: int, dim: int) -> int:
    """Vectors of double precision that fit into ``size`` bytes, at least one."""
    return max(1, size // (8 * max(dim, 1)))


def _keyed(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, vector).filter(F.col(vector).isNotNull())


def _result_schema(query: T.StructField, neighbour: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query.name, query.dataType),
            T.StructField(neighbour.name, neighbour.dataType),
            T.StructField("l2", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )


def _check_query_ids(queries: DataFrame, query_id: str) -> None:
    repeated = queries.groupBy(query_id).count().filter("count > 1").first()
    if repeated is not None:
        raise ValueError(f"query id {repeated[0]} names {repeated[1]} queries")


def _more_than(df: DataFrame, rows: int) -> bool:
    """Whether a frame has more than ``rows`` rows."""
    return df.count() > rows


def _answer(nearest: Nearest, query_ids: pa.Array, id_type: pa.DataType, names) -> pa.RecordBatch:
    columns = [
        query_ids.take(pa.array(nearest.rows)),
        pa.array(nearest.ids, type=id_type),
        pa.array(nearest.distances),
        pa.array(nearest.ranks),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _scan_queries(queries, corpus, k, dim, schema) -> DataFrame:
    """Send the corpus, whose size is checked, to the tasks that read the queries."""
    names = schema.names
    table = corpus.toArrow()
    shipped = queries.sparkSession.sparkContext.broadcast(
        (table.column(0).combine_chunks(), matrix(table.column(1), dim))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        sorted_ids = sortable_ids(ids)
        for batch in batches:
            nearest = Nearest(matrix(batch.column(1), dim), k)
            nearest.add(sorted_ids, vectors)
            yield _answer(nearest, batch.column(0), ids.type, names)

    return queries.mapInArrow(search, schema)


def _scan_corpus(queries, corpus, k, dim, schema) -> DataFrame:
    """Send the queries, whose number is checked, to the tasks that read the corpus."""
    names = schema.names
    table = queries.toArrow()
    shipped = queries.sparkSession.sparkContext.broadcast(
        (table.column(0).combine_chunks(), matrix(table.column(1), dim))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shipped.value
        nearest, id_type = Nearest(vectors, k), None
        for batch in batches:
            id_type = batch.column(0).type
            nearest.add(sortable_ids(batch.column(0)), matrix(batch.column(1), dim))
        if id_type is not None:
            yield _answer(nearest, ids, id_type, names)

    return corpus.mapInArrow(search, schema)


def _compare_cells(queries, corpus, k, dim, schema, cell_rows) -> DataFrame:
    """Cut both sides by id into cells of about ``cell_rows`` and compare cell by cell."""
    query_id, corpus_id = schema.names[:2]
    q_cells = max(1, math.ceil(queries.count() / cell_rows))
    c_cells = max(1, math.ceil(corpus.count() / cell_rows))

    def placed(df: DataFrame, key: str, own: str, own_cells: int, other: str, other_cells: int):
        cells = F.sequence(F.lit(0), F.lit(other_cells - 1))
        own_cell = F.pmod(F.xxhash64(key), F.lit(own_cells)).cast("int")
        return df.select("*", own_cell.alias(own), F.explode(cells).alias(other))

    return _cogroup(
        placed(queries, query_id, "_q_cell", q_cells, "_c_cell", c_cells),
        placed(corpus, corpus_id, "_c_cell", c_cells, "_q_cell", q_cells),
        ["_q_cell", "_c_cell"],
        k, dim, schema, (query_id, corpus_id, queries.columns[1], None),
    )


def _cogroup(queries, corpus, cell, k, dim, schema, columns) -> DataFrame:
    """Best ``k`` per query within every cell; with a bucket column, within its buckets."""
    query_id, corpus_id, vector, bucket = columns
    names = schema.names
    # Two frames of one table share columns; under names of their own the sides keep apart.
    queries = queries.withColumnRenamed(vector, "_q_vector")
    corpus = corpus.withColumnRenamed(vector, "_c_vector")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids = left.column(query_id).combine_chunks()
        corpus_ids = right.column(corpus_id).combine_chunks()
        batches = []
        if len(left) and len(right):
            ids = sortable_ids(corpus_ids)
            q_vectors = matrix(left.column("_q_vector"), dim)
            c_vectors = matrix(right.column("_c_vector"), dim)
            if bucket is None:
                nearest = Nearest(q_vectors, k)
                nearest.add(ids, c_vectors)
            else:
                buckets = left.column(bucket).to_numpy(), right.column(bucket).to_numpy()
                nearest = NearestInBuckets(q_vectors, c_vectors, ids, *buckets, k)
            batches.append(_answer(nearest, query_ids, corpus_ids.type, names))
        if not batches:
            nothing = Nearest(np.empty((0, dim)), k)
            batches.append(_answer(nothing, query_ids, corpus_ids.type, names))
        return pa.Table.from_batches(batches)

    return queries.groupBy(*cell).cogroup(corpus.groupBy(*cell)).applyInArrow(search, schema)


def _best(found: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    """Merge the best of many tasks in two steps, so no task takes all rows of a query."""
    by_distance = [F.col("l2"), F.col(corpus_id)]
    part = Window.partitionBy(query_id, "_part").orderBy(*by_distance)
    whole = Window.partitionBy(query_id).orderBy(*by_distance)
    parts = found.drop("rank").withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(256)))
    some = parts.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    return (
        some.drop("rank", "_part")
        .withColumn("rank", F.row_number().over(whole))
        .filter(F.col("rank") <= k)
    )
