"""A corpus kept up by key, a day rewritten alone, words weighted by rarity."""

import math
import os
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from klaxon import sinks
from klaxon.operators import embedding
from klaxon.operators.embedding import embed_weighted, word_frequencies
from klaxon.operators.similarity import knn_exact

VECTOR = "incident_id string, embedding array<float>, note string"


def files(folder):
    """Files of a table and when they were written."""
    return {
        os.path.join(top, name): os.stat(os.path.join(top, name)).st_mtime_ns
        for top, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    }


def incidents(spark, numbers, note="first"):
    rows = [(f"INC{n}", [float(n), float(n % 7)], note) for n in numbers]
    return spark.createDataFrame(rows, VECTOR)


def content(spark, path):
    return sorted(map(tuple, sinks.read_vectors(spark, path).collect()))


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "corpus")
    sinks.upsert_vectors(incidents(spark, range(300)), path, buckets=32)
    before = files(path)
    assert len(before) == 32
    changed = incidents(spark, [5, 300], "second")
    assert sinks.upsert_vectors(changed, path) == len(
        changed.select(F.pmod(F.xxhash64("incident_id"), F.lit(32))).distinct().collect()
    )
    after = files(path)
    assert len(after) == 32
    assert len(before.items() & after.items()) >= 30
    rebuilt = incidents(spark, [n for n in range(300) if n != 5]).unionByName(changed)
    assert content(spark, path) == sorted(map(tuple, rebuilt.collect()))
    queries = spark.createDataFrame([(1, [5.1, 5.0]), (2, [299.6, 6.0])], "query_id int, embedding array<float>")
    search = lambda corpus: sorted(
        map(tuple, knn_exact(queries, corpus, 3, corpus_id="incident_id").collect())
    )
    assert search(sinks.read_vectors(spark, path)) == search(rebuilt)


def test_upsert_again_changes_nothing_and_the_last_of_a_key_stands(spark, tmp_path):
    path = str(tmp_path / "corpus")
    twice = incidents(spark, [1, 2]).unionByName(incidents(spark, [1], "second"))
    for _ in range(2):
        sinks.upsert_vectors(twice, path, buckets=4)
        assert [(row[0], row[2]) for row in content(spark, path)] == [("INC1", "second"), ("INC2", "first")]
    assert sinks.upsert_vectors(incidents(spark, []), path) == 0
    assert len(content(spark, path)) == 2


def test_upsert_refuses_rows_without_key(spark, tmp_path):
    path = str(tmp_path / "corpus")
    sinks.upsert_vectors(incidents(spark, [1]), path, buckets=4)
    nameless = spark.createDataFrame([(None, [1.0], "x")], VECTOR)
    with pytest.raises(Exception, match="a vector has no incident_id"):
        sinks.upsert_vectors(nameless, path)
    with pytest.raises(ValueError):
        sinks.upsert_vectors(incidents(spark, [1]).drop("embedding"), path)
    assert len(content(spark, path)) == 1


def metrics(spark, day, counts):
    rows = [("A", n, datetime(2026, 1, day, hour), datetime(2026, 1, day, hour + 1)) for hour, n in enumerate(counts)]
    return spark.createDataFrame(
        rows, "system string, high_severity_count int, window_start timestamp, window_end timestamp"
    )


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_a_day_is_rewritten_alone(spark, tmp_path, file_format):
    path = str(tmp_path / "metrics")
    write = lambda rows, replace: sinks.write_metrics(
        rows, path, file_format, ["window_date"], replace=replace
    )
    write(metrics(spark, 1, [1, 2]).unionByName(metrics(spark, 2, [3])), "table")
    first = sorted((tmp_path / "metrics" / "window_date=2026-01-01").iterdir())
    stamps = [one.stat().st_mtime_ns for one in first]
    write(metrics(spark, 2, [7, 8]), "partitions")
    same = sorted((tmp_path / "metrics" / "window_date=2026-01-01").iterdir())
    assert same == first and [one.stat().st_mtime_ns for one in same] == stamps
    reader = spark.read.option("header", True) if file_format == "csv" else spark.read
    found = reader.format(file_format).load(path).groupBy("window_date").agg(
        F.sum(F.col("high_severity_count").cast("int")).alias("n")
    )
    assert sorted((str(row[0]), row[1]) for row in found.collect()) == [("2026-01-01", 3), ("2026-01-02", 15)]
    # The whole table is replaced whatever the session's default.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write(metrics(spark, 3, [1]), "table")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [one.name for one in (tmp_path / "metrics").glob("window*")] == ["window_date=2026-01-03"]


def test_partitions_need_names(spark, tmp_path):
    for replace, names in (("partitions", []), ("some", ["window_date"])):
        with pytest.raises(ValueError):
            sinks.write_metrics(metrics(spark, 1, [1]), str(tmp_path / "m"), partition_by=names, replace=replace)


TEXTS = ["disk full on node", "disk failed on node", "on On ON", None, "", "node down on friday night", "disk full on node"]


def plain_weights(texts, asked):
    words = [Counter(text.lower().split()) for text in texts if text is not None]
    known = sum(text is not None for text in texts) + sum(text is None for text in texts)
    in_documents = Counter(word for some in words for word in some)
    found = []
    for text in asked:
        counts = Counter((text or "").lower().split())
        found.append(sum(n * math.log((known + 1) / (in_documents[w] + 1)) for w, n in counts.items()))
    return found


def test_weights(spark):
    corpus = spark.createDataFrame(enumerate(TEXTS), "id int, text string")
    frequencies = word_frequencies(corpus)
    asked = [*TEXTS, "disk disk unknown", "on"]
    df = spark.createDataFrame([(7, t) for t in asked], "id int, text string").repartition(3)
    found = embed_weighted(df, frequencies, len(TEXTS)).collect()
    assert len(found) == len(asked)
    expected = sorted(zip(asked, plain_weights(TEXTS, asked)), key=str)
    rows = sorted(((row["text"], row["weight"], row["embedding"]) for row in found), key=str)
    for (text, weight), (found_text, found_weight, vector) in zip(expected, rows):
        assert text == found_text
        if text is None:
            assert found_weight is None and vector is None
            continue
        assert found_weight == pytest.approx(weight)
        assert len(vector) == 256
        assert np.linalg.norm(vector) == pytest.approx(1 if weight else 0, abs=1e-6)
    # Without collisions each word has a place of its own.
    full = next(row["embedding"] for row in found if row["text"] == "disk full on node")
    assert sum(x > 0 for x in full) == len("disk full on node".split())


def test_weights_in_many_blocks_move_a_text_once(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK_BITS", 1)
    monkeypatch.setattr(embedding, "NUMBERS_AT_ONCE", 256)
    texts = [None if n % 9 == 4 else " ".join(f"w{n * m % 23}" for m in range(n % 7)) for n in range(60)]
    corpus = spark.createDataFrame([(n, t, n / 2) for n, t in enumerate(texts)], "id int, text string, more double")
    frequencies = word_frequencies(corpus)
    found = embed_weighted(corpus.repartition(3), frequencies, len(texts))
    assert found.columns == ["id", "text", "more", "embedding", "weight"]
    rows = {row["id"]: row for row in found.collect()}
    assert len(rows) == found.count() == len(texts)
    for n, (text, weight) in enumerate(zip(texts, plain_weights(texts, texts))):
        assert (rows[n]["text"], rows[n]["more"]) == (text, n / 2)
        assert rows[n]["weight"] == (None if text is None else pytest.approx(weight))
    # Words shuffle for each block and not for each row, and no sums of a text are put together.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_row" not in plan and "ObjectHashAggregate" not in plan
    assert "hashpartitioning(_block" in plan
    # A word that the frequencies name twice weighs both times.
    twice = embed_weighted(corpus, frequencies.union(frequencies), len(texts)).collect()
    assert [row["weight"] for row in sorted(twice, key=lambda row: row["id"])] == [
        None if rows[n]["weight"] is None else pytest.approx(2 * rows[n]["weight"]) for n in range(60)
    ]


def test_rare_words_decide(spark):
    texts = [f"alarm on host in rack {n} today kernel" for n in range(20)] + ["alarm on host in rack 99 today zpmon"]
    corpus = spark.createDataFrame(enumerate(texts), "id int, text string")
    frequencies = word_frequencies(corpus)
    known = embed_weighted(corpus, frequencies, len(texts), dimension=4096).select("id", "embedding")
    asked = spark.createDataFrame([(1, "zpmon alarm on host in rack 3")], "query_id int, text string")
    asked = embed_weighted(asked, frequencies, len(texts), dimension=4096).select("query_id", "embedding")
    best = knn_exact(asked, known, 2).collect()
    assert {row["id"] for row in best} == {20, 3}
