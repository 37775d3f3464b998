"""Probed and pivoted searches against brute force."""

import os
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_similarity import answers, brute_force, frames, vectors

from klaxon.operators import pivots, probing
from klaxon.operators.pivots import knn_pivots, least_gaps
from klaxon.operators.probing import ProbingIndex, ProbingPlan, knn_probed
from klaxon.operators.similarity import knn_exact

TABLES = "/root/testdata"


def clusters(rows, centres, dim=8, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    made = middle[rng.integers(0, centres, rows)] + spread * rng.normal(size=(rows, dim))
    return made.astype(np.float32)


# -- pivots -----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["even", "clustered", "copies", "shifted"])
def test_pivots_equal_brute_force(spark, kind):
    corpus = clusters(600, 12, seed=2) if kind == "clustered" else vectors(400, seed=2)
    if kind == "copies":
        corpus[:200] = corpus[0]
    queries = np.concatenate([corpus[:10], corpus[50:60] + np.float32(0.01), vectors(10, seed=4)])
    if kind == "shifted":
        corpus, queries = corpus + 1000, queries + 1000
    found = knn_pivots(*frames(spark, queries, corpus), 7)
    assert answers(found) == brute_force(queries, corpus, 7)


def test_pivots_cut_full_cells_and_keep_repeated_ids(spark):
    corpus = clusters(300, 2, seed=3)
    ids = [f"i{number // 3}" for number in range(300)]
    queries = clusters(80, 2, seed=3)
    found = knn_pivots(*frames(spark, queries, corpus, ids), 5, cell_bytes=8 * 8 * 20)
    assert answers(found) == brute_force(queries, corpus, 5, ids)


@pytest.mark.parametrize("rows", [1, 3, 4])
def test_pivots_with_fewer_rows_than_k(spark, rows):
    queries, corpus = vectors(9, seed=1), vectors(rows, seed=2)
    found = knn_pivots(*frames(spark, queries, corpus), 5)
    assert answers(found) == brute_force(queries, corpus, 5)


def test_pivots_without_corpus_or_queries(spark):
    left, right = frames(spark, vectors(3), vectors(3))
    assert knn_pivots(left, right.limit(0), 2).isEmpty()
    assert knn_pivots(left.limit(0), right, 2).isEmpty()
    nulls = right.withColumn("embedding", F.lit(None).cast("array<float>"))
    assert knn_pivots(left, nulls, 2).isEmpty()


def test_bounds_hold_and_rule_most_cells_out_of_clustered_data():
    corpus = clusters(3000, 40, seed=5).astype(float)
    queries = clusters(100, 40, seed=5).astype(float)
    chosen = corpus[:60]
    gaps = pivots._gaps(corpus, chosen)
    cell = gaps.argmin(axis=1)
    own = gaps[np.arange(len(corpus)), cell]
    some = [own[cell == c] for c in range(len(chosen))]
    bounds = np.array([(one.min(), one.max()) for one in some])
    least = least_gaps(pivots._gaps(queries, chosen), chosen, bounds)
    exact = pivots._gaps(queries, corpus)
    for c in range(len(chosen)):
        assert (least[:, c] <= exact[:, cell == c].min(axis=1) + 1e-9).all()
    kth = np.sort(exact, axis=1)[:, 4]
    assert (least <= kth[:, None]).mean() < 0.2


def test_pivots_visit_few_cells_of_clustered_data(spark):
    """Queries move to the cells that may hold a neighbour, not to all."""
    corpus, queries = clusters(2000, 40, seed=6), clusters(50, 40, seed=6)
    moved = []
    whole = pivots.similarity.compare_shared

    def watched(visits, *others):
        moved.append(visits.agg(F.sum(F.size("_buckets"))).first()[0])
        return whole(visits, *others)

    pivots.similarity.compare_shared = watched
    try:
        found = answers(knn_pivots(*frames(spark, queries, corpus), 5))
    finally:
        pivots.similarity.compare_shared = whole
    assert found == brute_force(queries, corpus, 5)
    assert sum(moved) < 0.35 * 50 * 45


# -- probes -----------------------------------------------------------------------------


def measured(queries, corpus, found, k):
    """Share of the exact neighbours that were found; distances have to be exact."""
    exact = brute_force(queries, corpus, k)
    hits = 0
    for query, some in answers(found).items():
        distances = ((corpus.astype(float) - queries[query].astype(float)) ** 2).sum(axis=1)
        assert all(abs(distances[number] - l2) < 1e-6 for number, l2 in some)
        hits += len(set(some) & set(exact[query]))
    return hits / (k * len(queries))


@pytest.mark.parametrize("dim", [2, 8, 40])
def test_recall_is_what_was_asked_for(spark, dim):
    corpus, queries = vectors(1500, dim, seed=2), vectors(120, dim, seed=3)
    left, right = frames(spark, queries, corpus)
    index = ProbingIndex(right)
    plan = index.plan(left, 5)
    assert measured(queries, corpus, index.search(left, 5, plan), 5) >= 0.9
    compared = index.probes(left, plan).agg(F.sum("_compared")).first()[0]
    assert compared < 0.35 * 120 * 1500


def test_all_buckets_give_the_exact_answer(spark):
    queries, corpus = vectors(30, seed=1), vectors(200, seed=2)
    left, right = frames(spark, queries, corpus)
    index = ProbingIndex(right)
    found = index.search(left, 7, ProbingPlan(2, 1.0, 1.0))
    assert answers(found) == brute_force(queries, corpus, 7)


def test_one_vector_many_times_and_far_from_zero(spark):
    corpus = vectors(300, seed=2, copies=150) + 500
    queries = np.concatenate([corpus[:3], corpus[200:220]])
    found = knn_probed(*frames(spark, queries, corpus), 3)
    assert measured(queries, corpus, found, 3) >= 0.9


def test_few_bits_for_a_large_corpus(spark, monkeypatch):
    monkeypatch.setattr(probing, "BUCKETS", 64)
    corpus, queries = clusters(900, 30, seed=2), clusters(60, 30, seed=2)
    left, right = frames(spark, queries, corpus)
    index = ProbingIndex(right)
    assert len(index.buckets) <= 64 * probing.TABLES
    assert measured(queries, corpus, index.search(left, 4, index.plan(left, 4)), 4) >= 0.9


def test_few_distances_and_buckets_at_once(spark, monkeypatch):
    corpus, queries = vectors(300, 8, seed=2), vectors(90, 8, seed=3)
    left, right = frames(spark, queries, corpus)
    index = ProbingIndex(right)
    plan = index.plan(left, 4)
    key = lambda row: row["query_id"]
    found = sorted(index.probes(left, plan).collect(), key=key)
    monkeypatch.setattr(probing, "SCORES_AT_ONCE", 700)
    monkeypatch.setattr(probing, "LISTED_AT_ONCE", 50)
    assert index.plan(left, 4) == plan
    assert sorted(index.probes(left, plan).collect(), key=key) == found


def test_memory_of_probing_does_not_grow_with_queries_times_buckets():
    rng = np.random.default_rng(1)
    directory = np.arange(1 << 16), np.ones(1 << 16, np.int64)
    index = SimpleNamespace(planes=[rng.normal(size=(16, 16))], offsets=[np.zeros(16)], dim=16, rows=1 << 16)
    small = probing._Directory(index, SimpleNamespace(value=directory))
    asked = pa.array(rng.normal(size=(64, 16)).astype(np.float32).tolist(), pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(64)), asked], names=["query_id", "embedding"])
    tracemalloc.start()
    found = list(small.probed(batch, ProbingPlan(1, 0.1, 1.0)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
    assert sum(map(len, found)) == 64
    for one in found:
        assert one.column("_compared").to_pylist() == [len(some) for some in one.column("_buckets").to_pylist()]


def test_probing_without_corpus_or_queries(spark):
    left, right = frames(spark, vectors(3), vectors(3))
    assert knn_probed(left, right.limit(0), 2).isEmpty()
    assert knn_probed(left.limit(0), right, 2).isEmpty()


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables not here")
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    """Even vectors, the hardest ones: nine tenths found by comparing less than a fifth."""
    table = spark.read.parquet(f"{TABLES}/{sf}/embeddings.parquet")
    corpus = table.select(F.col("vec_id").alias("id"), "embedding")
    every = corpus.withColumnRenamed("id", "query_id")
    queries = every.filter("query_id % 50 = 0")
    index = ProbingIndex(corpus)
    plan = index.plan(every, 5)
    key = lambda r: (r["query_id"], r["id"])
    exact = set(map(key, knn_exact(queries, corpus, 5).collect()))
    found = set(map(key, index.search(queries, 5, plan).collect()))
    assert len(exact & found) >= 0.9 * len(exact)
    compared = index.probes(queries, plan).agg(F.sum("_compared")).first()[0]
    assert compared < 0.2 * queries.count() * corpus.count()
