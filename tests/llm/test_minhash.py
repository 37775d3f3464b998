"""Near duplicates against all pairs."""

import itertools
import random

import numpy as np
import pytest
from data import documents, made_text, odd_rows, plain_components, plain_shingles

from klaxon.llm import minhash
from klaxon.llm.components import connected_components
from klaxon.llm.superminhash import signatures


def expected(rows, width, percent):
    sets = {i: plain_shingles(text, width) for i, text in rows if i is not None}
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(s), plain_components(sets, links)[i]) for i, s in sets.items()}


def near_copies(number, seed):
    """Copies of a text with more and more words replaced."""
    rng = random.Random(seed)
    base = made_text(seed, 150).split()
    for copy in range(number):
        words = list(base)
        for place in rng.sample(range(len(words)), rng.randint(0, 9)):
            words[place] = f"w{copy}x{place}"
        yield " ".join(words)


@pytest.mark.parametrize("width, percent, bands, rows", [(3, 85, 24, 5), (5, 80, 30, 4)])
def test_groups_are_those_of_all_pairs(spark, width, percent, bands, rows):
    table = odd_rows() + [(100 + i, t) for i, t in enumerate(near_copies(40, 5))]
    docs = documents(spark, table).repartition(3)
    found = minhash.near_duplicates(docs, width, percent, bands, rows).collect()
    assert len(found) == len(table)
    plain = expected(table, width, percent)
    for row in found:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert (row["n_shingles"], row["component_id"]) == plain[row["doc_id"]]
            assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    table = list(enumerate(near_copies(120, 9)))
    found = minhash.near_duplicates(documents(spark, table), 3, 85, 24, 5).collect()
    plain = expected(table, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: c for i, (_, c) in plain.items()}
    # The case is worth its name only if some copies stay apart.
    assert 1 < len({c for _, c in plain.values()}) < 100


def test_stage_keeps_one_row_of_each_group(spark):
    docs = documents(spark, odd_rows())
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [row["doc_id"] for row in kept.collect()]
    assert sorted(i or 0 for i in ids) == [0, 1, 4, 5, 6, 7, 9, 10, 11, 14]


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b, c = made_text(31, 60), made_text(32, 60), made_text(33, 60)
    rows = [(1, a), (1, b), (2, b + " end"), (3, c), (3, c), (None, b), (4, None), (4, a)]
    docs = documents(spark, rows)
    kept = sorted(((r["doc_id"], r["text"]) for r in minhash.without_near_duplicates(docs).collect()), key=str)
    some = [row for row in kept if row[1] in (b, b + " end") and row[0]]
    assert some == [(1, b)]
    assert kept == sorted([(1, a), (1, b), (3, c), (None, b), (4, None)], key=str)
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    expected_rows = {
        (1, 1, True), (2, 1, False), (3, 3, True), (None, None, True), (4, 4, True), (4, 1, False)
    }
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == expected_rows


def test_equal_rows_leave_the_first_by_other_columns(spark):
    text = made_text(34, 30)
    rows = [(1, text, lang, [k]) for k, lang in enumerate("dcba")] * 20 + [(2, "other words", "x", [9])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, more array<int>")
    kept = minhash.without_near_duplicates(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["lang"], r["more"]) for r in kept) == [(1, "a", [3]), (2, "x", [9])]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert minhash.near_duplicates(docs).isEmpty()
    assert minhash.without_near_duplicates(docs).isEmpty()


def test_signature_is_the_least_value_per_component_of_all_elements():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 2**63, 400).astype(np.uint64)
    whole = signatures([elements], 64)[0]
    singles = signatures([elements[i : i + 1] for i in range(400)], 64)
    assert (whole == singles.min(axis=0)).all()
    # Each element holds each rank once.
    assert (np.sort(singles >> 32, axis=1) == np.arange(64)).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = signatures([both[:250], both[50:]], 120)
        errors.append((a == b).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.05


def test_components_of_a_long_path(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame(
        [*zip(ids, ids[1:]), (500, 501), (7, 7)], "a bigint, b bigint"
    )
    found = {row["id"]: row["component"] for row in connected_components(edges).collect()}
    assert found == {**dict.fromkeys(ids, 0), 500: 500, 501: 500}
