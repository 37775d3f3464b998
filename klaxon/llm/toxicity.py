"""Toxicity by class-conditional Kneser-Ney models.

Counts of letters in context come from two sources: a bounded sample of labelled documents
for each class's longest contexts, and all documents for the contexts that both classes
share. The latter are Spark tables that grow with the documents; what is gathered of them are
the letters that follow contexts of the sample. A text has two features, both normalised by
its number of words: the mean of its words' log-likelihood ratios, and the logarithm of the
mean ratio, which a few strong words in a long text decide. A logistic curve fitted to labelled documents that the models
have not seen turns them into a score.
"""

import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm import kneserney
from klaxon.llm.batches import schema_of, slices
from klaxon.llm.memory import forget, remembered
from klaxon.session import settle, store

# Labelled documents of each class that the models are fitted to, at most.
LABELLED_PER_CLASS = 20_000
# One in so many of them is kept for the curve.
FOLDS = 5
# Words whose counts a task sums before it hands them on, and whose ratios a worker remembers.
WORDS_SUMMED = 100_000
WORDS_KEPT = 300_000
HIGHEST = 40.0

GRAMS = "gram bigint, toxic bigint, ordinary bigint"
FEATURES = "doc_id bigint, mean double, peak double"


def _fold(doc_id, salt, folds):
    return F.crc32(F.concat(F.lit(salt), F.col(doc_id).cast("string")).cast("binary")) % folds


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are never learned."""
    return F.coalesce(_fold(doc_id, "", 3) == 1, F.lit(False))


def labelled_sample(labels: DataFrame, most: int = LABELLED_PER_CLASS) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` documents per class outside the held-out third,
    in the order of a hash. A document with several labels is toxic if one of them says so."""
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
    single = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ordinary = single.filter("toxic = 0").orderBy(*order).limit(most)
    return settle(single.filter("toxic = 1").orderBy(*order).limit(most).unionByName(ordinary))


def _gram_counts(tables):
    """GRAMS rows of word counts by class: toxic, ordinary, any document."""
    rows = []
    for kind, words in enumerate(tables):
        if not words:
            continue
        names = list(words)
        grams, owner = kneserney.ngrams(names)
        weights = np.fromiter(words.values(), np.float64, len(names))[owner]
        if kind == 2:
            grams = -1 - (grams & ((1 << kneserney.BITS * kneserney.SHARED) - 1))
        unique, place = np.unique(grams, return_inverse=True)
        counts = np.bincount(place, weights).astype(np.int64)
        none = np.zeros(len(unique), np.int64)
        rows.append((unique, counts if kind != 1 else none, counts if kind == 1 else none))
    columns = [np.concatenate(column) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema_of(GRAMS))


def count_grams(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Counts of n-grams: long ones of sampled documents by class, and, as negative numbers,
    short ones of all documents (in the column ``toxic``). Words are summed before they are
    cut into letters, and a table of words is handed on when it is full."""

    def count(batches):
        forget()
        tables = [Counter(), Counter(), Counter()]
        for batch in slices(batches):
            classes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for kind, text in zip(classes, texts):
                if text:
                    words = kneserney.fold(text).split()
                    tables[2].update(words)
                    if kind is not None:
                        tables[1 - kind].update(words)
                    if len(tables[2]) > WORDS_SUMMED:
                        yield _gram_counts(tables)
                        tables = [Counter(), Counter(), Counter()]
        if tables[2]:
            yield _gram_counts(tables)

    fitted = sample.filter(_fold("doc_id", "fit", FOLDS) != 0)
    fitted = fitted.select(F.col("doc_id").alias("_fitted"), "toxic")
    # At most two samples' rows.
    marked = docs.join(F.broadcast(fitted), docs["doc_id"] == fitted["_fitted"], "left")
    counts = marked.select("toxic", "text").mapInArrow(count, GRAMS)
    return counts.groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )


def _last(gram, order):
    """The last ``order`` letters of an n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << kneserney.BITS * order) - 1))


def _context(gram, order):
    """What an n-gram of ``order`` that ends a longer one has before its last letter."""
    return F.shiftright(_last(gram, order), kneserney.BITS)


def fit_models(docs: DataFrame, sample: DataFrame) -> dict | None:
    """Tables of both classes' models, or None where a class has no document.

    What reaches the driver are the distinct n-grams of the bounded sample, and of those of all
    documents the ones after a context that is in the sample: others favour neither class.
    """
    counts = store(count_grams(docs, sample), "grams")
    long = counts.filter("gram >= 0")
    grams, toxic, ordinary = [column.to_numpy() for column in long.toArrow().columns]
    if not toxic.any() or not ordinary.any():
        return None
    shared = counts.filter("gram < 0").select((-1 - F.col("gram")).alias("gram"), F.col("toxic").alias("n"))
    tables = []
    for order in range(kneserney.SHARED, 0, -1):
        if order < kneserney.SHARED:
            shared = shared.groupBy(_last("gram", order).alias("gram")).agg(F.count("*").alias("n"))
            shared = store(shared, "shared")
        contexts = long.select(_context("gram", order).alias("context")).distinct()
        some = shared.join(contexts, _context("gram", order) == F.col("context"), "left_semi")
        tables.append([column.to_numpy() for column in some.toArrow().columns])
    return kneserney.fit_tables(grams, toxic, ordinary, tables)


class Scorer:
    """Features and scores of texts; a worker scores a word once per fitted model."""

    def __init__(self, name, model, weights=None):
        self.model, self.weights = model, weights
        self.known = remembered(name, dict)

    def features(self, texts):
        """(mean, peak) of each text; 0 and 0 without words."""
        words = [kneserney.fold(text or "").split() for text in texts]
        new = {word for some in words for word in some}
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known.clear()
        new = [word for word in new if word not in self.known]
        self.known.update(zip(new, kneserney.ratios(self.model, new).tolist()))
        found = np.zeros((len(texts), 2))
        for row, some in enumerate(words):
            if some:
                values = np.fromiter(map(self.known.__getitem__, some), np.float64, len(some))
                values = np.clip(values, -HIGHEST, HIGHEST)
                found[row] = values.mean(), np.log(np.exp(values).mean())
        return found

    def scores(self, texts):
        if self.model is None:
            return np.full(len(texts), self.weights)
        place = self.features(texts) @ self.weights[:2] + self.weights[2]
        return 1 / (1 + np.exp(-np.clip(place, -500, 500)))


def features(docs: DataFrame, sent) -> DataFrame:
    """doc_id, mean and peak of every whole text."""

    def score(batches):
        scorer = Scorer(*sent.value)
        for some in slices(batches):
            found = scorer.features(some.column(1).to_pylist())
            columns = [some.column(0), pa.array(found[:, 0]), pa.array(found[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema_of(FEATURES))

    return docs.select("doc_id", "text").mapInArrow(score, FEATURES)


def fit_curve(table: pd.DataFrame) -> np.ndarray:
    """Weights of mean, peak and 1 in the logistic curve, by Newton's method; classes weigh
    the same, and a small penalty keeps the weights finite where the classes part cleanly."""
    y = table["toxic"].to_numpy(np.float64)
    x = np.column_stack([table["mean"], table["peak"], np.ones(len(y))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    penalty = np.diag([1e-3, 1e-4, 1e-9])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def _with_id(docs):
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))


def fit_scorer(docs: DataFrame, labels: DataFrame):
    """(name, models, weights of the curve) as a broadcast; without documents of both classes,
    no models and the score of all texts."""
    context = docs.sparkSession.sparkContext
    sample = labelled_sample(labels)
    model = fit_models(docs, sample)
    if model is None:
        return context.broadcast((None, None, float(sample.filter("toxic = 1").count() > 0)))
    # Tells the words of this model from those of another one in the same worker.
    name = f"toxicity-{uuid.uuid4().hex}"
    sent = context.broadcast((name, model))
    ids = sample.withColumnRenamed("doc_id", "_labelled")
    some = docs.join(F.broadcast(ids), docs["doc_id"] == ids["_labelled"])
    # Even the texts of the sample are read from the table, as those of the models were.
    kept_apart = _fold("doc_id", "fit", FOLDS) == 0
    found = features(some, sent).withColumn("unseen", kept_apart)
    found = found.join(F.broadcast(sample), "doc_id").toPandas()
    table = found[found["unseen"]]
    if table["toxic"].nunique() < 2:
        # Too few labels to keep some apart: the curve is fitted to those of the models.
        table = found
    return context.broadcast((name, model, fit_curve(table)))


def score_toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Only the texts enter a score. An empty or null text has the score of a text that favours
    neither class. If the labels lack one of the classes, every score is that of the other,
    and 0 without labels. A row without doc_id is scored like any other and counts as not
    held out. Other columns play no part; repeated rows come back as often as they occur.
    """
    docs = _with_id(docs)
    sent = fit_scorer(docs, labels)

    def score(batches):
        scorer = Scorer(*sent.value)
        for some in slices(batches):
            scores = pa.array(scorer.scores(some.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([some.column(0), scores], ["doc_id", "score"])

    found = docs.mapInArrow(score, "doc_id bigint, score double")
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose texts score below ``cut``."""
    sent = fit_scorer(_with_id(docs), labels)
    column = docs.columns.index("text")

    def keep(batches):
        scorer = Scorer(*sent.value)
        for some in slices(batches):
            scores = scorer.scores(some.column(column).to_pylist())
            yield some.filter(pa.array(scores < cut, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
