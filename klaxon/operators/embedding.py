"""Vectors of texts, computed where the rows are."""

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.session import store

DIMENSION = 256
# Neighbouring rows, 4096 at most, share one list of words while they are weighed.
BLOCK_BITS = 12
# Numbers of vectors that a task makes at once.
NUMBERS_AT_ONCE = 1 << 18


def embed(
    df: DataFrame, text: str = "text", output: str = "embedding", dimension: int = DIMENSION
) -> DataFrame:
    """Hashed word frequencies of unit length as ``array<float>``; NULL for NULL text.

    Words are what whitespace separates, in lower case; a text without words has length 0.
    Needs no model and no pass over the data, so equal texts have equal vectors in every
    run. Runs in the JVM and moves no rows.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    steps = PipelineModel(
        [
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimension),
            Normalizer(inputCol="_counts", outputCol="_unit", p=2.0),
        ]
    )
    hashed = steps.transform(df.withColumn("_words", words))
    vector = F.when(F.col(text).isNotNull(), vector_to_array("_unit", "float32"))
    return hashed.select(*df.columns, vector.alias(output))


def word_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, documents): in how many texts of ``df`` each word occurs, words as 64-bit hashes.

    One row per text and distinct word shuffles at most, combined on the map side.
    """
    words = df.select(F.explode(F.array_distinct(_word_hashes(text))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("documents"))


def embed_weighted(
    df: DataFrame,
    frequencies: DataFrame,
    documents: int,
    text: str = "text",
    output: str = "embedding",
    dimension: int = DIMENSION,
) -> DataFrame:
    """Word frequencies weighted by rarity, hashed to ``dimension`` numbers, of unit length.

    ``frequencies`` (:func:`word_frequencies`) come from a corpus of so many ``documents``. A word
    that occurs ``n`` times in a text and in ``m`` documents weighs n * ln((documents + 1) / (m +
    1)); a word unknown to the corpus weighs as if m were 0. So words that all incidents share,
    which lead an unweighted search astray, count for little.

    Rows are numbered and dealt in blocks of neighbours. Each block asks for the frequencies of
    its distinct words, which meet those of the corpus by a shuffle, and gets them sent ahead
    of its texts, so that a text moves once, whatever the vocabulary and however frequent a
    word. Every row is weighed by itself, repeated keys included. Returns ``df`` with the
    vector and ``weight``, the sum of a text's weights; both NULL for NULL text. A text without
    words, or of words alone that all documents have, has length 0.
    """
    # Stored, as a row's block has to be the same on both ways.
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("_block")
    given = store(df.select(block, "*"), "texts")
    distinct = F.explode(F.array_distinct(_word_hashes(text))).alias("word")
    # A word comes once for each block, so no word is too frequent for a task.
    asked = given.select("_block", distinct).distinct()
    rarity = F.ln((F.lit(documents) + 1.0) / (F.coalesce("documents", F.lit(0)) + 1.0))
    known = asked.join(frequencies.select("word", "documents"), "word", "left")
    known = known.select("_block", F.col("word").alias("_word"), rarity.alias("_rarity"))
    both = known.filter("_rarity > 0").unionByName(given, allowMissingColumns=True)
    # Within a block, its words in ascending order and then its texts.
    dealt = both.repartition("_block").sortWithinPartitions("_block", F.asc_nulls_last("_word"))
    # Hashed again behind the shuffle, as a text is smaller than its hashes.
    hashes = _word_hashes(text).alias("_hashes")
    dealt = dealt.select("_block", "_word", "_rarity", hashes, *df.columns)
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(output, T.ArrayType(T.FloatType())),
            T.StructField("weight", T.DoubleType()),
        ]
    )
    at = df.columns.index(text)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, NUMBERS_AT_ONCE // dimension)
        last, words, rarities = None, [], []
        for some, block, is_text in _runs(batches, rows):
            if block != last:
                last, words, rarities = block, [np.empty(0, np.int64)], [np.empty(0)]
            if not is_text:
                words.append(some.column(1).to_numpy())
                rarities.append(some.column(2).to_numpy())
                continue
            if len(words) > 1:
                words, rarities = _totals(np.concatenate(words), np.concatenate(rarities))
            vectors, weights = _weighed(some.column(3), words[0], rarities[0], dimension)
            columns = some.columns[4:]
            missing = columns[at].is_null()
            gone = missing.to_numpy(zero_copy_only=False)
            ends = np.arange(len(some) + 1, dtype=np.int32) * dimension
            listed = pa.ListArray.from_arrays(ends, vectors.ravel(), mask=missing)
            columns += [listed, pa.array(weights, pa.float64(), mask=gone)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return dealt.mapInArrow(weigh, schema)


def _runs(batches: Iterator[pa.RecordBatch], rows: int):
    """(rows, block, whether they are texts) for neighbours of one block and kind; of texts so many
    ``rows`` at most."""
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        texts = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (texts[1:] != texts[:-1])) + 1
        for start, end in pairwise([0, *cuts.tolist(), len(batch)]):
            step = rows if end > start and texts[start] else max(1, end - start)
            for at in range(start, end, step):
                yield batch.slice(at, min(step, end - at)), blocks[at], texts[at]


def _totals(words: np.ndarray, rarities: np.ndarray) -> tuple[list, list]:
    """The words, which ascend, each once; one that frequencies name twice weighs both times."""
    starts = np.flatnonzero(np.diff(words, prepend=words[:1] - 1))
    if len(starts) == len(words):
        return [words], [rarities]
    return [words[starts]], [np.add.reduceat(rarities, starts)]


def _weighed(hashes: pa.ListArray, words: np.ndarray, rarities: np.ndarray, dimension: int):
    """(unit vectors, sums of weights) of texts given as their words' hashes; ``words`` ascend, and
    one that is not among them weighs nothing."""
    flat = pc.list_flatten(hashes).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(hashes)), pc.list_value_length(hashes).to_numpy())
    if len(words):
        found = np.minimum(np.searchsorted(words, flat), len(words) - 1)
        weight = np.where(words[found] == flat, rarities[found], 0.0)
    else:
        weight = np.zeros(len(flat))
    place = row * dimension + flat % dimension
    sums = np.bincount(place, weight, len(hashes) * dimension).reshape(-1, dimension)
    length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
    vectors = (sums / np.where(length > 0, length, 1)[:, None]).astype(np.float32)
    return vectors, np.bincount(row, weight, len(hashes))


def _word_hashes(text: str) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+")
    return F.transform(F.array_remove(words, ""), lambda word: F.xxhash64(word))


def embed_with(
    df: DataFrame,
    load_model: Callable[[], Callable[[Sequence[str]], np.ndarray]],
    text: str = "text",
    output: str = "embedding",
) -> DataFrame:
    """Vectors from a model of the caller's choice as ``array<float>``; NULL for NULL text.

    ``load_model`` runs once per task and returns a function from texts to one row of
    numbers per text. A call gets one Arrow batch of texts, which
    ``spark.sql.execution.arrow.maxBytesPerBatch`` and ``maxRecordsPerBatch`` bound.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            given = texts.drop_null().to_pylist()
            if given and model is None:
                model = load_model()
            numbers = np.asarray(model(given) if given else np.empty((0, 0)), dtype=np.float32)
            # NULL texts take no numbers: their offset does not move.
            present = texts.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(present * numbers.shape[1])])
            column = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(numbers.ravel()), mask=pa.array(~present)
            )
            names = [*batch.schema.names, output]
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=names)

    return df.mapInArrow(encode, schema)
