"""Repeated passages against a plain scan of all windows."""

import random
import re

import numpy as np
import pytest
from data import WORDS, documents, made_text, odd_rows

from klaxon.llm import anchors


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_kept(rows, window):
    """(doc_id, number of words, kept words) as a sorted list; rows of one id stand apart."""
    rank = lambda number: (number is None, number or 0)
    first = {}
    listed = [(rank(number), at, plain_words(text)) for at, (number, text) in enumerate(rows)]
    for number, at, words in listed:
        for start in range(len(words) - window + 1):
            key = tuple(words[start : start + window])
            first.setdefault(key, []).append((number, at, start))
    found = []
    for number, at, words in listed:
        gone = set()
        for start in range(len(words) - window + 1):
            for other in first[tuple(words[start : start + window])]:
                if other[0] < number or (other[1] == at and other[2] < start):
                    gone.update(range(start, start + window))
        kept = " ".join(word for i, word in enumerate(words) if i not in gone)
        found.append((number, len(words), kept))
    return sorted(found)


def found_kept(spark, rows, window):
    found = anchors.without_repeats(documents(spark, rows), window).collect()
    for row in found:
        assert len(row["starts"]) == len(row["ends"])
        left = row["n_words"] - sum(row["ends"]) + sum(row["starts"])
        assert left == len(plain_words(row["kept"]))
    return sorted(
        ((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["kept"]) for r in found
    )


def test_odd_rows(spark):
    assert found_kept(spark, odd_rows(), 20) == plain_kept(odd_rows(), 20)


@pytest.mark.parametrize("seed", range(3))
def test_many_batches_and_parts(spark, monkeypatch, seed):
    """Shared passages of any length and place, over several batches and parts."""
    monkeypatch.setattr(anchors, "BATCH_BYTES", 3000)
    monkeypatch.setattr(anchors, "PART_BYTES", 2000)
    rng = random.Random(seed)
    passages = [[rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(k)] for k in (9, 10, 11, 19, 30)]
    rows = []
    for number in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [rng.choice(WORDS) for _ in range(rng.randint(0, 15))]
            one = rng.choice(passages)
            start = rng.randint(0, 3)
            words += one[start : start + rng.randint(5, 30)]
        rows.append((rng.choice([number, number, None, 7]), " ".join(words)))
    assert found_kept(spark, rows, 10) == plain_kept(rows, 10)


def test_every_place_of_a_window_has_a_hit(spark, monkeypatch):
    """A passage of exactly one window, after any number of other words, in another batch."""
    monkeypatch.setattr(anchors, "BATCH_BYTES", 200)
    passage = made_text(5, 20)
    rows = [(i, made_text(100 + i, i) + " " + passage + " " + made_text(200 + i, 3)) for i in range(24)]
    assert found_kept(spark, rows, 20) == plain_kept(rows, 20)
    assert sum(passage in row[2] for row in found_kept(spark, rows, 20)) == 1


def test_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(anchors, "BATCH_BYTES", 20_000)
    text = made_text(8, 50)
    found = anchors.without_repeats(documents(spark, [(i, text) for i in range(500, 0, -1)]))
    kept = [row["doc_id"] for row in found.collect() if row["kept"]]
    assert kept == [1]


def test_repeats_within_one_text(spark):
    text = " ".join(["a b c d"] * 30)
    assert found_kept(spark, [(1, text)], 20) == plain_kept([(1, text)], 20)


def test_no_rows(spark):
    assert anchors.without_repeats(documents(spark, [])).count() == 0


def test_odd_window_is_refused(spark):
    with pytest.raises(ValueError):
        anchors.without_repeats(documents(spark, []), 5)


@pytest.mark.parametrize("width", [1, 2, 3, 7, 10, 20])
def test_rolling_numbers(width):
    numbers = np.random.default_rng(1).integers(0, 3, 300).astype(np.uint64)
    found = anchors.rolling(numbers, width)
    runs = [tuple(numbers[i : i + width]) for i in range(len(numbers) - width + 1)]
    assert len(found) == len(runs)
    assert len(set(zip(runs, found.tolist()))) == len(set(runs)) == len(set(found.tolist()))
    assert len(anchors.rolling(numbers[: width - 1], width)) == 0
