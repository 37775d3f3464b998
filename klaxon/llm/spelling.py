"""Spelling variants: words one edit apart, found in dense tiles, and the form each stands for.

A single inserted, deleted or replaced code point leaves the first or the last half of a
word as it is. So words wait under both halves, those of length c with those of c - 1, and
only words that share one are compared. Tiles are dense: words of a tile become a padded
matrix of code points, and common prefix plus common suffix of every two of its rows follow
column by column. Two words are one edit apart if that sum reaches the longer length less
one. Small groups of words with a common half fill a tile together; a large group is cut
into blocks, and each two of its blocks are a tile. Each pair has one tile, so the counts of
tiles add up, and no pair becomes a row.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import slices, to_batch
from klaxon.operators.joins import left_join_measured
from klaxon.session import settle, store

LETTERS = "a-zÀ-ÿ"
# Words in a block of a large group, and about as many in a tile of small ones.
BLOCK = 256
# Distinct words that a task counts before it sends its counts on.
COUNTED = 100_000

COUNTS = "word string, n bigint"
NEAR = "word string, n_near bigint, best_n bigint, best string"


def word_counts(docs: DataFrame, least_length: int, every: int) -> DataFrame:
    """(word, n) of the runs of Latin letters of at least ``least_length``; of those whose crc32
    with the document's id ``every`` divides, one letter is lost first (0: of none)."""
    runs = regex.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches):
        total = Counter()
        for some in slices(batches):
            for number, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                # Only ASCII letters change their case in bytes.
                found = Counter(runs.findall(text.encode().lower().decode())) if text else {}
                start = zlib.crc32(f"{'' if number is None else number}:".encode())
                for run, n in found.items():
                    h = zlib.crc32(run.encode(), start)
                    if every and h % every == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < least_length:
                            continue
                    total[run] += n
            if len(total) >= COUNTED:
                yield to_batch(list(total.items()), COUNTS)
                total.clear()
        yield to_batch(list(total.items()), COUNTS)

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return chosen.mapInArrow(count, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


# -- comparing the words of a tile ------------------------------------------------------


def common_prefix(words):
    """Length of the common prefix of every two different rows of ``words``."""
    lengths = np.array([len(word) for word in words])
    codes = np.array(words).view(np.uint32).reshape(len(words), -1).T
    same = ~np.eye(len(words), dtype=bool)
    found = np.zeros(same.shape, np.int32)
    for column in codes:
        same &= column[:, None] == column[None, :]
        if not same.any():
            break
        found += same
    # Equal padding counts for nothing.
    return np.minimum(found, np.minimum(lengths[:, None], lengths[None, :]))


def near_words(rows):
    """NEAR rows for the words of one tile that have near ones in it."""
    words = rows["word"].to_pylist()
    n, c, side, group, own, i, j = (
        rows[name].to_numpy() for name in ("n", "c", "side", "group", "own", "i", "j")
    )
    prefix = common_prefix(words)
    suffix = common_prefix([word[::-1] for word in words])
    longer = np.array([len(word) for word in words]) == c
    pair = (group[:, None] == group) & (c[:, None] == c) & (side[:, None] == side)
    pair &= longer[:, None] | longer
    pair &= (own[:, None] != own) | (i == j)
    half = (c - 1) // 2
    # Words that share both halves meet under the first one.
    pair &= np.where(side == 0, prefix >= half, (suffix >= half) & (prefix < half))
    pair &= prefix + suffix >= c - 1
    np.fill_diagonal(pair, False)
    count = pair.sum(axis=1)
    order = sorted(range(len(words)), key=lambda at: (-n[at], words[at]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.where(pair, rank, len(words)).min(axis=1, initial=len(words))
    return [
        (words[at], int(count[at]), int(n[order[best[at]]]), words[order[best[at]]])
        for at in np.flatnonzero(count)
    ]


def _compare(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches([to_batch(near_words(table), NEAR)])


def _tiles(words: DataFrame) -> DataFrame:
    """Every word under its halves (c, side, group), in the tiles where it meets others: ``own`` is
    its block of a large group, (i, j) a pair of blocks, ``tile`` that of small groups."""
    length = F.char_length("word")
    places = []
    for c in (length, length + 1):
        half = F.floor((c - 1) / 2).cast("int")
        for side, key in enumerate((F.substring("word", F.lit(1), half), F.right("word", half))):
            # Groups that share a number by chance are told apart by their words.
            group = F.xxhash64(c, F.lit(side), key)
            places.append(F.struct(c.alias("c"), F.lit(side).alias("side"), group.alias("group")))
    rows = words.select("word", "n", F.explode(F.array(*places)).alias("at"))
    rows = store(rows.select("word", "n", "at.*"), "halves")
    large = rows.groupBy("group").count().filter(F.col("count") > BLOCK)
    large = large.select("group", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = left_join_measured(rows, large, ["group"])
    blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    tiles = 1 + words.count() * len(places) // BLOCK
    small = F.pmod(F.col("group"), F.lit(tiles)).cast("int")
    rows = rows.withColumn("tile", F.when(F.col("blocks").isNull(), small))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = rows.select("*", other.alias("other"))
    return rows.select(
        "word", "n", "c", "side", "group", "own",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "tile",
    )


def near_counts(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of the words (word, n) that have others one edit away; ``best`` is a
    struct of the commonest one's negative n and its text, of equal ones the smallest."""
    tiles = _tiles(words)
    # The rows of a large group belong to tiles of their own.
    key = F.when(F.col("tile").isNull(), F.col("group"))
    found = tiles.withColumn("key", key).groupBy("key", "i", "j", "tile").applyInArrow(_compare, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("negative"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following the forms ends. Forms have no cycles."""
    up = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        # Each round doubles the steps taken.
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = settle(left_join_measured(up, further, ["root"]))
        up = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next IS NOT NULL").isEmpty():
            return up


def spelling_variants(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    every: int = 0,
) -> DataFrame:
    """Words of ``docs`` with those one edit away.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, of at
    least ``least_length`` code points that occur ``least_count`` times or more. A word's
    form is its commonest near word (of equal ones the first in code-point order) if that
    is ``ratio`` times as common as the word or more. ``every`` damages words for trials,
    see :func:`word_counts`.

    Returns word, form, root (the end of the forms from a word on, or the word itself), n,
    n_near (0 without near words) and form_n. Null and empty texts have no words; repeated
    rows count each; rows without doc_id count like those of an empty id. Other columns
    play no part. An empty table gives none. ``ratio`` is 2 or more, so that forms end.
    """
    if ratio < 2:
        raise ValueError(f"ratio must be at least 2, not {ratio}")
    counts = word_counts(docs, least_length, every)
    words = store(counts.filter(F.col("n") >= least_count), "words")
    near = near_counts(words)
    is_form = -F.col("best.negative") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, -F.col("best.negative")).alias("form_n"),
    )
    found = store(found, "variants")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
