"""Tiles and contaminated documents against plain forms."""

import random
import time

import numpy as np
from data import documents, made_text, odd_rows

from klaxon.llm import decontamination
from klaxon.llm.tiling import tiles, window_hashes


def plain_tiles(left, right, least):
    """Longest common run of unmarked words, again and again."""
    used_left, used_right, found = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(left)):
            for j in range(len(right)):
                size = 0
                while (
                    i + size < len(left)
                    and j + size < len(right)
                    and left[i + size] == right[j + size]
                    and i + size not in used_left
                    and j + size not in used_right
                ):
                    size += 1
                if size > best[0]:
                    best = (size, i, j)
        if best[0] < least:
            return found
        size, i, j = best
        used_left.update(range(i, i + size))
        used_right.update(range(j, j + size))
        found.append(best)


def test_window_hashes_tell_windows_apart():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], np.uint64)
    for length in range(1, 10):
        found = window_hashes(words, length).tolist()
        windows = [tuple(words[i : i + length].tolist()) for i in range(len(words) - length + 1)]
        assert len(found) == len(windows)
        for i, a in enumerate(windows):
            for j, b in enumerate(windows):
                assert (found[i] == found[j]) == (a == b)


def test_tiles_cover_as_much_as_the_plain_form():
    rng = random.Random(2)
    for _ in range(60):
        left = [rng.randint(1, 5) for _ in range(rng.randint(0, 60))]
        right = [rng.randint(1, 5) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            right = left[30:] + right[:10] + left[:30]
        found = tiles(np.array(left, np.uint64), np.array(right, np.uint64), 3)
        seen_left, seen_right = [], []
        for size, i, j in found:
            assert left[i : i + size] == right[j : j + size]
            seen_left += range(i, i + size)
            seen_right += range(j, j + size)
        assert len(seen_left) == len(set(seen_left)) and len(seen_right) == len(set(seen_right))
        plain = plain_tiles(left, right, 3)
        if plain:
            assert max(found)[0] == max(plain)[0]
        # Lengths between two halvings are marked in another order than one by one.
        assert len(seen_left) >= 0.7 * sum(size for size, _, _ in plain)


def table(spark):
    item = made_text(50, 60).split()
    moved = item[40:] + item[:15] + ["between"] + item[15:40]
    half = item[:25]
    rows = [
        (100, " ".join(made_text(51, 300).split()[:150] + item + made_text(52, 80).split())),
        (101, "Before, " + " ".join(moved).upper() + "."),
        (102, " ".join(half + made_text(53, 100).split())),
        (103, ", ".join(item)),
        (104, made_text(54, 200)),
    ]
    items = [(1, " ".join(item)), (1, " ".join(item)), (2, "too short"), (3, None), (4, "")]
    benchmark = spark.createDataFrame(
        [(i, t, 0) for i, t in items], "item_id bigint, text string, doc_id int"
    )
    return documents(spark, odd_rows() + rows), benchmark


def test_copied_reordered_and_reworded_passages(spark):
    docs, benchmark = table(spark)
    found = decontamination.contaminated(docs.repartition(3), benchmark).collect()
    # The item comes twice, and so do its matches.
    assert sorted(row["doc_id"] for row in found) == [100, 100, 101, 101, 103, 103]
    assert all(row["item_id"] == 1 and row["item_words"] == 60 for row in found)
    by_doc = {row["doc_id"]: row for row in found}
    assert by_doc[100]["tiles"] == 1 and by_doc[100]["coverage"] == 1
    assert by_doc[101]["tiles"] == 3 and by_doc[101]["coverage"] == 1


def test_blocks_change_nothing(spark, monkeypatch):
    docs, benchmark = table(spark)
    whole = sorted(decontamination.contaminated(docs, benchmark).collect())
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 30)
    assert sorted(decontamination.contaminated(docs, benchmark).collect()) == whole


def test_stage_keeps_clean_rows_as_they_are(spark):
    docs, benchmark = table(spark)
    kept = decontamination.without_contaminated(docs, benchmark)
    assert kept.schema == docs.schema
    key = lambda row: (row["doc_id"] or 0, row["text"] or "")
    expected = [row for row in docs.collect() if row["doc_id"] not in (100, 101, 103)]
    assert sorted(kept.collect(), key=key) == sorted(expected, key=key)


def test_stage_with_many_blocks(spark, monkeypatch):
    docs, benchmark = table(spark)
    key = lambda row: (row["doc_id"] or 0, row["text"] or "")
    whole = sorted(decontamination.without_contaminated(docs, benchmark).collect(), key=key)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 30)
    assert sorted(decontamination.without_contaminated(docs, benchmark).collect(), key=key) == whole


def found_items(spark, texts, items):
    docs = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(enumerate(items), "item_id bigint, text string")
    found = decontamination.contaminated(docs, benchmark).collect()
    return sorted((row["doc_id"], row["item_id"], row["covered"]) for row in found)


def test_short_items_match_whole(spark):
    items = ["Ohm's law?", "who wrote Faust", "What is it, then", "", "..."]
    texts = [
        "ohm's law", "He asked: who wrote Faust? Nobody knew.", "who wrote the Faust", "we know Ohm's law well",
        "so what is it then now", "what is it. Then", None, "", "...",
    ]
    assert found_items(spark, texts, items) == [(0, 0, 2), (1, 1, 3), (4, 2, 4), (5, 2, 4)]


def test_scripts_without_spaces(spark):
    item = "水在标准大气压下的沸点是多少度"
    texts = ["前言。" + item + "?后文继续写下去。", "水在山上的沸点是多少", "Thai " + item[:9] + " " + item[9:]]
    assert [(doc, covered) for doc, _, covered in found_items(spark, texts, [item])] == [(0, 15), (2, 15)]


def test_items_that_share_a_sentence():
    """Thousands of items with one instruction cost a text that quotes it next to nothing."""
    instruction = "choose the one best answer to the following question and explain your choice"
    items = [(i, f"{instruction} {made_text(1000 + i, 30)}") for i in range(3000)]
    seeds = decontamination.Seeds(items)
    texts = [f"{made_text(i, 100)} {instruction} {made_text(50 + i, 100)}" for i in range(20)]
    began = time.process_time()
    assert [seeds.matches(text) for text in texts] == [[]] * 20
    assert time.process_time() - began < 2
    found = seeds.matches(f"{made_text(1, 100)} {items[17][1]} {made_text(2, 50)}")
    assert [(item, covered) for item, _, covered, _ in found] == [(17, 43)]


def test_seeds_that_come_many_times():
    """A text of one repeated word, and an item that repeats itself."""
    seeds = decontamination.Seeds([(1, "go " * 40), (2, "go " * 10 + made_text(3, 10))])
    found = {item: covered for item, _, covered, _ in seeds.matches("go " * 5000)}
    assert found == {1: 40, 2: 10}


def test_empty_tables(spark):
    docs, benchmark = table(spark)
    assert decontamination.contaminated(docs.limit(0), benchmark).isEmpty()
    assert decontamination.contaminated(docs, benchmark.limit(0)).isEmpty()
    assert decontamination.without_contaminated(docs, benchmark.limit(0)).count() == docs.count()
