"""Words one edit apart against a plain search over deletions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from data import documents, odd_rows

from klaxon.llm import spelling


def plain_counts(rows, least_length, every):
    found = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if number is None else number}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {word: n for word, n in found.items() if len(word) >= least_length}


def plain_near(words):
    near, gaps = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            gaps[word[:i], word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for some in gaps.values():
        for word in some:
            near[word] |= some - {word}
    return near


def plain_variants(rows, least_length=6, least_count=5, every=0):
    words = plain_counts(rows, least_length, every)
    words = {word: n for word, n in words.items() if n >= least_count}
    near, form = plain_near(words), {}
    for word, n in words.items():
        if near[word]:
            best = min(near[word], key=lambda one: (-words[one], one))
            if words[best] >= 5 * n:
                form[word] = best
    found = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        to = form.get(word)
        found.append((word, to, root, n, len(near[word]), words.get(to)))
    return sorted(found)


def found_variants(spark, rows, **options):
    docs = documents(spark, rows).withColumnRenamed("size", "word").withColumnRenamed("node", "n")
    return sorted(map(tuple, spelling.spelling_variants(docs, **options).collect()))


def random_rows(seed, letters, stems, documents_):
    """Texts of words that differ by single edits, some far commoner than others."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(stems)]
    for word in list(words):
        for _ in range(3):
            i = rng.randint(0, len(word) - 1)
            cut = rng.choice(["", rng.choice(letters), word[i] + rng.choice(letters)])
            words.append(word[:i] + cut + word[i + 1 :])
    weight = [rng.choice([1, 1, 8, 60, 500]) for _ in words]
    rows = []
    for number in range(documents_):
        some = rng.choices(words, weight, k=200)
        rows.append((number, " ".join(w.upper() if rng.random() < 0.1 else w for w in some)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_plain(spark, seed):
    rows = random_rows(seed, "abcéÿ×" if seed else "ab", 60, 60)
    found = found_variants(spark, rows, every=7)
    assert found == plain_variants(rows, every=7)
    assert any(row[1] for row in found)


def test_one_half_for_all(spark, monkeypatch):
    """Words that share a half fill many blocks; each pair counts once."""
    monkeypatch.setattr(spelling, "BLOCK", 8)
    rng = random.Random(4)
    stems = {"pre" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 5))) for _ in range(250)}
    rows = [(i, " ".join(sorted(stems) * rng.randint(1, 3))) for i in range(5)]
    assert found_variants(spark, rows) == plain_variants(rows)


def test_ends_and_repeated_letters(spark):
    words = "aaaaaa aaaaaaa aaaaaaaa baaaaaa aaaaaab abaaaaa axaaaa bcdefg bcdefgh abcdefg abcdefgh".split()
    rows = [(1, " ".join(words * 5 + ["aaaaaaa"] * 60 + ["aaaaaa"] * 400))]
    found = found_variants(spark, rows)
    assert found == plain_variants(rows)
    assert ("aaaaaaaa", "aaaaaaa", "aaaaaa") in {row[:3] for row in found}


def test_odd_rows(spark):
    rows = odd_rows()
    assert found_variants(spark, rows, least_length=2, every=3) == plain_variants(
        rows, least_length=2, every=3
    )


def test_very_long_word_and_empty_table(spark):
    rows = [(i, "x" * 5000 + " " + "x" * 4999) for i in range(5)]
    assert found_variants(spark, rows) == plain_variants(rows)
    assert found_variants(spark, []) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(documents(spark, []), ratio=1)
