"""Class-conditional models against a plain form, and held-out accuracy."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from data import documents, made_text, odd_rows

from klaxon.llm import kneserney, toxicity

BAD = ["grobzak", "grobzik", "mufflon"]


def plain_ratio(word, toxic, ordinary, everything):
    """Kneser-Ney by its definition, from word counts."""
    d = kneserney.DISCOUNT

    def grams(words, order):
        found = defaultdict(int)
        for one, n in words.items():
            letters = [None] * (kneserney.ORDER - 1) + list(one) + ["end"]
            for i in range(kneserney.ORDER - 1, len(letters)):
                found[tuple(letters[i - order + 1 : i + 1])] += n
        return found

    def levels(words):
        counts = {kneserney.ORDER: grams(words, kneserney.ORDER)}
        for order in range(kneserney.ORDER - 1, kneserney.SHARED, -1):
            counts[order] = defaultdict(int)
            for gram in counts[order + 1]:
                counts[order][gram[1:]] += 1
        return counts

    shared = {kneserney.SHARED: grams(everything, kneserney.SHARED)}
    for order in range(kneserney.SHARED - 1, 0, -1):
        shared[order] = defaultdict(int)
        for gram in shared[order + 1]:
            shared[order][gram[1:]] += 1

    def p(gram, counts):
        if not gram:
            return 1 / (1 << kneserney.BITS)
        own = counts.get(len(gram)) or shared[len(gram)]
        same = {g: n for g, n in own.items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:], counts)
        if not same:
            return lower
        total = sum(same.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(same) / total * lower

    letters = [None] * (kneserney.ORDER - 1) + list(word) + ["end"]
    total = 0
    for i in range(kneserney.ORDER - 1, len(letters)):
        gram = tuple(letters[i - kneserney.ORDER + 1 : i + 1])
        total += np.log(p(gram, levels(toxic)) / p(gram, levels(ordinary)))
    return total


def test_ratios_are_those_of_the_definition():
    toxic = {"bad": 3, "badly": 1, "the": 2, "é": 1}
    ordinary = {"good": 4, "the": 5, "then": 1, "bag": 1}
    everything = {**toxic, **ordinary, "the": 9, "other": 2}

    def counts(words, order):
        grams, owner = kneserney.ngrams(list(words))
        grams = grams & ((1 << kneserney.BITS * order) - 1)
        kinds, place = np.unique(grams, return_inverse=True)
        return kinds, np.bincount(place, np.array(list(words.values()), float)[owner])

    one, other = counts(toxic, kneserney.ORDER), counts(ordinary, kneserney.ORDER)
    grams = np.union1d(one[0], other[0])
    columns = np.zeros((2, len(grams)))
    columns[0, np.searchsorted(grams, one[0])] = one[1]
    columns[1, np.searchsorted(grams, other[0])] = other[1]
    model = kneserney.fit(grams, *columns, *counts(everything, kneserney.SHARED))
    words = ["bad", "good", "the", "bagly", "xyz", "", "é", "then"]
    plain = [plain_ratio(word, toxic, ordinary, everything) for word in words]
    assert np.allclose(kneserney.ratios(model, words), plain, atol=1e-5)


def corpus(seed, number):
    rng = random.Random(seed)
    rows, labels = [], []
    for doc in range(number):
        words = made_text(seed * 1000 + doc, rng.randint(20, 200)).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((1000 + doc, " ".join(words)))
        labels.append((1000 + doc, toxic))
    return rows, labels


def is_held_out(doc):
    return zlib.crc32(str(doc).encode()) % 3 == 1


def label_table(spark, labels):
    return spark.createDataFrame([(d, 1, t) for d, t in labels], "doc_id bigint, quality int, toxic int")


def test_held_out_documents(spark):
    rows, labels = corpus(1, 400)
    odd = labels + [(None, 1), (1000, None), (999_999, 1), labels[0]]
    docs = documents(spark, rows + odd_rows()).repartition(3)
    found = toxicity.score_toxicity(docs, label_table(spark, odd)).collect()
    assert len(found) == 400 + len(odd_rows())
    by_doc = {row["doc_id"]: row for row in found}
    for row in found:
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == (row["score"] >= 0.7)
        assert row["held_out"] == (row["doc_id"] is not None and is_held_out(row["doc_id"]))
    unseen = [(d, t) for d, t in labels if is_held_out(d)]
    right = [by_doc[d]["predicted"] == t for d, t in unseen]
    assert len(unseen) > 100 and np.mean(right) > 0.97
    assert by_doc[4]["score"] == by_doc[5]["score"] == by_doc[6]["score"] < 0.7


def test_labels_of_the_held_out_third_change_nothing(spark):
    rows, labels = corpus(2, 150)
    docs = documents(spark, rows)
    turned = [(d, 1 - t if is_held_out(d) else t) for d, t in labels]
    scores = [
        sorted((r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, label_table(spark, one)).collect())
        for one in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_stage_drops_what_the_query_predicts(spark):
    rows, labels = corpus(3, 200)
    docs, table = documents(spark, rows + odd_rows()), label_table(spark, labels)
    found = toxicity.score_toxicity(docs, table).collect()
    kept = toxicity.without_toxic(docs, table)
    assert kept.schema == docs.schema
    ids = sorted(row["doc_id"] or 0 for row in kept.collect())
    assert ids == sorted(row["doc_id"] or 0 for row in found if not row["predicted"])
    assert 0 < sum(row["predicted"] for row in found) < 100


@pytest.mark.parametrize("kind, score", [(0, 0.0), (1, 1.0), (None, 0.0)])
def test_labels_of_one_class(spark, kind, score):
    rows, labels = corpus(4, 30)
    table = label_table(spark, [(d, kind) for d, _ in labels])
    found = toxicity.score_toxicity(documents(spark, rows), table).collect()
    assert {row["score"] for row in found} == {score}


def test_empty_tables(spark):
    rows, labels = corpus(5, 30)
    docs, table = documents(spark, rows), label_table(spark, labels)
    assert toxicity.score_toxicity(docs.limit(0), table).isEmpty()
    assert toxicity.without_toxic(docs, table.limit(0)).count() == 30


def test_a_word_of_all_documents_is_not_toxic_by_chance(spark):
    """A name that by chance stands only in toxic sampled documents, and in many others."""
    rows, labels = corpus(1, 400)
    rng = random.Random(3)
    fitted = [at for at, (doc, toxic) in enumerate(labels) if toxic and not is_held_out(doc)]
    for at in rng.sample(fitted, 4):
        rows[at] = (rows[at][0], rows[at][1] + " zanquelo")
    others = []
    for n in range(200):
        words = made_text(900_000 + n, rng.randint(20, 200)).split()
        words.insert(rng.randrange(len(words)), "zanquelo")
        others.append((50_000 + n, " ".join(words)))
    docs = documents(spark, rows + others).repartition(3)
    found = toxicity.score_toxicity(docs, label_table(spark, labels)).collect()
    by_doc = {row["doc_id"]: row["predicted"] for row in found}
    assert sum(by_doc[doc] for doc, _ in others) <= 10
    unseen = [(doc, toxic) for doc, toxic in labels if is_held_out(doc)]
    assert np.mean([by_doc[doc] == toxic for doc, toxic in unseen]) > 0.97


def test_what_is_gathered_gives_the_ratios_of_all_counts(spark):
    rows, labels = corpus(6, 60)
    others = [(5000 + n, made_text(700_000 + n, 40)) for n in range(60)]
    docs, table = documents(spark, rows + others), label_table(spark, labels)
    sample = toxicity.labelled_sample(table)
    counts = toxicity.count_grams(docs, sample).toArrow()
    grams, toxic, ordinary = [column.to_numpy() for column in counts.columns]
    long = grams >= 0
    whole = kneserney.fit(grams[long], toxic[long], ordinary[long], -1 - grams[~long], toxic[~long])
    model = toxicity.fit_models(docs, sample)
    words = sorted({word for _, text in rows + others for word in text.lower().split()})
    assert np.allclose(kneserney.ratios(model, words), kneserney.ratios(whole, words), atol=1e-9)
    assert kneserney.SHARED >= 3 and len(model["base"][-1][0]) < len(whole["base"][-1][0])
