"""Small documents with every odd case, and plain forms of what the operators compute."""

import random
import re

WORDS = "the of and to in is that it was for on are as with his they at be this from".split()


def made_text(seed, words):
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(words)
    )


def odd_rows():
    """(doc_id, text): nulls, blanks, one word, very long, ties, copies, a repeated row."""
    base = made_text(1, 120)
    rows = [
        (1, base),
        (2, base),
        (3, base + " end"),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one"),
        (8, "one"),
        (9, "two words"),
        (10, made_text(2, 30_000)),
        (11, "É È é <|endoftext|> don't  stop\n\nnow\t1234 ... ß"),
        (12, base.upper()),
        (None, "no number"),
        (14, made_text(3, 40)),
        (14, made_text(3, 40)),
    ]
    words = base.split()
    words[60] = "changed"
    rows.append((15, " ".join(words)))
    return rows


def documents(spark, rows):
    """A table with columns whose names operators use inside."""
    schema = "doc_id bigint, text string, lang string, node string, size string, bucket int, component string"
    return spark.createDataFrame([(d, t, "xx", None, "s", 1, "c") for d, t in rows], schema)


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain_shingles(text, width):
    words = plain_words(text)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_components(ids, linked):
    """Smallest id that links reach, for each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}
