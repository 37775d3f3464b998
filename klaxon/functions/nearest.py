"""Nearest neighbours within one task: the numeric helper of the similarity operators."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Block of the distance matrix that is held at a time, and pairs measured exactly at once.
QUERY_BLOCK = 512
CORPUS_BLOCK = 2048
PAIR_BLOCK = 1 << 16


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of a list column as a 2-D array; all have to be of length ``dim``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column)
    if column.null_count or (len(column) and pc.any(pc.not_equal(lengths, dim)).as_py()):
        raise ValueError(f"every vector needs {dim} elements")
    values = pc.list_flatten(column)
    if values.null_count:
        raise ValueError("a vector holds a NULL element")
    vectors = values.to_numpy(zero_copy_only=False).reshape(-1, dim)
    if not np.isfinite(vectors).all():
        raise ValueError("a vector holds an element that is no finite number")
    return vectors


def sortable_ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as an array that sorts as Spark sorts them: numbers, or text by code point."""
    # Text stays as objects: an array of fixed width would pad every id to the longest one.
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(False)


class Nearest:
    """The ``k`` nearest corpus vectors of every query, over corpus blocks seen so far.

    Distance is squared L2 in double precision; equal distances rank by id. ``rows``,
    ``ids``, ``distances`` and ``ranks`` list the neighbours, ordered by query row and rank.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self._blocks = [
            _QueryBlock(queries[start:start + QUERY_BLOCK], k)
            for start in range(0, len(queries), QUERY_BLOCK)
        ]
        self._k = k

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for start in range(0, len(vectors), CORPUS_BLOCK):
            stop = start + CORPUS_BLOCK
            block = _CorpusBlock(ids[start:stop], vectors[start:stop])
            for queries in self._blocks:
                queries.add(block)

    @property
    def rows(self) -> np.ndarray:
        starts = range(0, len(self._blocks) * QUERY_BLOCK, QUERY_BLOCK)
        parts = [block.rows + start for block, start in zip(self._blocks, starts)]
        return np.concatenate([np.empty(0, dtype=np.int64), *parts])

    @property
    def distances(self) -> np.ndarray:
        return np.concatenate([np.empty(0), *(block.distances for block in self._blocks)])

    @property
    def ids(self) -> np.ndarray:
        parts = [block.ids for block in self._blocks if len(block.rows)]
        return np.concatenate(parts) if parts else np.empty(0)

    @property
    def ranks(self) -> np.ndarray:
        return (_place_in_run(self.rows) + 1).astype(np.int32)


def _square_sums(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors, vectors)


class _CorpusBlock:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype(np.float64)
        self.norms = _square_sums(self.vectors)


class _QueryBlock:
    """Neighbours of some queries, as parallel arrays ordered by query row and rank.

    A product of matrices bounds every distance from below but for its rounding error, and
    rules most pairs out; only the others are measured.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries.astype(np.float64), k
        self.rows = np.empty(0, dtype=np.int64)
        self.distances = np.empty(0)
        self.ids: np.ndarray | None = None
        self._worst = np.full(len(queries), np.inf)
        self._norms = _square_sums(self.queries)
        self._error = 4 * (queries.shape[1] + 4) * np.finfo(np.float64).eps

    def add(self, corpus: _CorpusBlock) -> None:
        rows, columns = self._candidates(corpus)
        for start in range(0, len(rows), PAIR_BLOCK):
            piece = slice(start, start + PAIR_BLOCK)
            self._measure(corpus, rows[piece], columns[piece])

    def _candidates(self, corpus: _CorpusBlock):
        scale = self._norms[:, None] + corpus.norms[None, :]
        bound = (1 - self._error) * scale - 2.0 * (self.queries @ corpus.vectors.T)
        limit = self._worst
        if np.isinf(limit).any() and bound.shape[1] > self.k:
            kth = np.partition(bound, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(limit, kth + 2 * self._error * scale.max(axis=1))
        return np.nonzero(bound <= limit[:, None])

    def _measure(self, corpus: _CorpusBlock, rows: np.ndarray, columns: np.ndarray) -> None:
        gap = self.queries[rows] - corpus.vectors[columns]
        distances = np.einsum("ij,ij->i", gap, gap)
        closer = distances <= self._worst[rows]
        rows, columns, distances = rows[closer], columns[closer], distances[closer]
        if len(rows) == 0:
            return
        known = corpus.ids[:0] if self.ids is None else self.ids
        rows = np.concatenate([self.rows, rows])
        distances = np.concatenate([self.distances, distances])
        ids = np.concatenate([known, corpus.ids[columns]])
        order = np.lexsort((ids, distances, rows))
        rows, distances, ids = rows[order], distances[order], ids[order]
        place = _place_in_run(rows)
        kept = place < self.k
        self.rows, self.distances, self.ids = rows[kept], distances[kept], ids[kept]
        last = place == self.k - 1
        self._worst[rows[last]] = distances[last]


def _place_in_run(rows: np.ndarray) -> np.ndarray:
    """Position of each element among equal neighbours, from 0."""
    if len(rows) == 0:
        return np.empty(0, dtype=np.int64)
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    lengths = np.diff(np.r_[starts, len(rows)])
    return np.arange(len(rows)) - np.repeat(starts, lengths)


def common_runs(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of equal keys on both sides, one pair of position arrays per key."""
    left_order, right_order = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    left_keys, left_starts, left_sizes = np.unique(
        left[left_order], return_index=True, return_counts=True
    )
    right_keys, right_starts, right_sizes = np.unique(
        right[right_order], return_index=True, return_counts=True
    )
    _, left_at, right_at = np.intersect1d(
        left_keys, right_keys, assume_unique=True, return_indices=True
    )
    for i, j in zip(left_at, right_at):
        yield (
            left_order[left_starts[i]:left_starts[i] + left_sizes[i]],
            right_order[right_starts[j]:right_starts[j] + right_sizes[j]],
        )


class NearestInBuckets:
    """The ``k`` nearest corpus vectors of every query row among those of its bucket.

    Small buckets are measured together, pair by pair in blocks of bounded size; a bucket
    of many pairs by itself, where a product of matrices rules most pairs out.
    """

    def __init__(self, queries, corpus, ids, query_buckets, corpus_buckets, k: int):
        small, parts = [], [(np.empty(0, np.int64), np.empty(0), ids[:0])]
        pairs = 0
        for q_rows, c_rows in common_runs(query_buckets, corpus_buckets):
            size = len(q_rows) * len(c_rows)
            if size > PAIR_BLOCK // 16:
                nearest = Nearest(queries[q_rows], k)
                nearest.add(ids[c_rows], corpus[c_rows])
                parts.append((q_rows[nearest.rows], nearest.distances, nearest.ids))
                continue
            small.append((np.repeat(q_rows, len(c_rows)), np.tile(c_rows, len(q_rows))))
            pairs += size
            if pairs >= PAIR_BLOCK:
                parts.append(_measured(queries, corpus, ids, small, k))
                small, pairs = [], 0
        if small:
            parts.append(_measured(queries, corpus, ids, small, k))
        self.rows, self.distances, self.ids = (np.concatenate(one) for one in zip(*parts))
        # A query row is in one bucket, so its neighbours lie together.
        self.ranks = (_place_in_run(self.rows) + 1).astype(np.int32)


def _measured(queries, corpus, ids, pairs, k):
    """(query row, distance, id) of the best ``k`` per query row among pairs of rows."""
    rows, columns = (np.concatenate(one) for one in zip(*pairs))
    gap = queries[rows].astype(np.float64) - corpus[columns]
    distances, found = np.einsum("ij,ij->i", gap, gap), ids[columns]
    order = np.lexsort((found, distances, rows))
    order = order[_place_in_run(rows[order]) < k]
    return rows[order], distances[order], found[order]
