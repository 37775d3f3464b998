"""

The ``events`` table stands in for alerts by the mapping in :func:`_alerts`; ``documents`` and ``benchmark`` stand in for alerts and past incidents
with long texts, ``embeddings`` for their vectors.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from contextlib import redirect_stdout
from datetime import date, timedelta
from functools import reduce
from io import StringIO

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klaxon import operators, plans, sinks, sources, streaming
from klaxon.functions import (
    checked_alerts,
    decode_alerts,
    encode_alerts,
    event_time,
    incident_text,
    is_normal,
)
from klaxon.operators.embedding import embed, embed_weighted, embed_with, word_frequencies
from klaxon.operators.pivots import knn_pivots
from klaxon.operators.probing import ProbingIndex
from klaxon.operators.similarity import knn_exact, knn_lsh
from klaxon.session import new_folder, store

WINDOW = "6 hours"
DAY = date(2024, 1, 2)
LAST_DAY = date(2024, 1, 28)
NTZ = "timestamp_ntz"


# -- inputs ---------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _alerts(events: DataFrame) -> DataFrame:
    """Alerts from events: forty systems, each with several components."""
    value = F.col("value")
    return events.select(
        F.concat(F.lit("E"), "event_id").alias("incident_id"),
        F.concat(F.lit("host-"), F.col("user_id") % 40).alias("system"),
        F.concat(F.lit("unit-"), F.col("user_id") % 7).alias("component"),
        F.col("event_type").alias("alert_type"),
        F.when(value >= 50, "HIGH").when(value >= 15, "MEDIUM").otherwise("LOW").alias("severity"),
        F.col("props").alias("message"),
        F.col("ts").alias("timestamp"),
    )


def _all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(_table(spark, sf_dir, "events"))


def _high_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above for queries on HIGH alerts. The mapping hides from the optimizer that HIGH
    means a range of ``value``; stated on the raw column it reaches the scan."""
    return _alerts(_table(spark, sf_dir, "events").filter("value >= 50"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.severity_counts(_high_alerts(spark, sf_dir), WINDOW)


def _bounds_as_ntz(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {name: F.col(name).cast(NTZ) for name in ("window_start", "window_end")}
    )


def _rounded(column: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(column)


# -- alerts ---------------------------------------------------------------------------


def severity_filter(spark, sf_dir):
    return _high_alerts(spark, sf_dir).filter("severity = 'HIGH'")


def window_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


def window_counts_short(spark, sf_dir):
    return operators.severity_counts(_high_alerts(spark, sf_dir), "10 seconds")


def decode_json(spark, sf_dir):
    # Stored, or else the filters on the payload would repeat the encoding.
    payloads = store(encode_alerts(_all_alerts(spark, sf_dir), key="incident_id"), "payloads")
    decoded = decode_alerts(payloads)
    return decoded.withColumn("timestamp", F.col("timestamp").cast(NTZ))


def decode_counts(spark, sf_dir):
    payloads = store(encode_alerts(_all_alerts(spark, sf_dir)), "payloads")
    return _bounds_as_ntz(plans.counts_of_stream(payloads, WINDOW))


def event_times(spark, sf_dir):
    texts = _table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("long"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("short"),
    )
    return texts.select(
        "event_id",
        event_time("long").cast(NTZ).alias("long_required"),
        event_time("short").cast(NTZ).alias("short_required"),
        event_time("long", "optional").cast(NTZ).alias("long_optional"),
        event_time("short", "optional").cast(NTZ).alias("short_optional"),
        event_time("event_type").cast(NTZ).alias("junk"),
    )


# -- daily metrics --------------------------------------------------------------------


def day_windows(spark, sf_dir):
    # The day on the window bound stays above the aggregate, the day on the alerts does not.
    alerts = operators.alerts_between(_high_alerts(spark, sf_dir), DAY, DAY + timedelta(days=1))
    return operators.for_day(operators.severity_counts(alerts, WINDOW), DAY)


def day_windows_text(spark, sf_dir):
    texts = _counts(spark, sf_dir).select(
        "system",
        F.concat("high_severity_count", F.lit(".0")).alias("high_severity_count"),
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("window_end"),
    )
    return operators.typed_counts(operators.for_day(texts, DAY))


def total_per_system(spark, sf_dir):
    return operators.totals(_counts(spark, sf_dir))


def avg_per_system(spark, sf_dir):
    return operators.averages(_counts(spark, sf_dir)).select("system", _rounded("avg_per_window"))


def system_stats(spark, sf_dir):
    return operators.system_stats(_counts(spark, sf_dir)).withColumn(
        "avg_per_window", _rounded("avg_per_window")
    )


def peak_window(spark, sf_dir):
    return operators.peak_window(_counts(spark, sf_dir))


def spikes(spark, sf_dir):
    return operators.spikes(_counts(spark, sf_dir))


def spike_check(spark, sf_dir):
    return operators.spike_check(_counts(spark, sf_dir))


def unknown_times(spark, sf_dir):
    """Window counts of events of which every seventh lacks its time."""
    known = F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts")
    events = _table(spark, sf_dir, "events")
    events = events.select(*[known if c == "ts" else c for c in events.columns])
    return operators.severity_counts(_alerts(events), WINDOW)


def _enriched(spark, sf_dir):
    # Stored first: the statistics and the join each read the counts.
    return operators.enrich(store(_counts(spark, sf_dir), "counts"))


def enriched_metrics(spark, sf_dir):
    return _enriched(spark, sf_dir).withColumn("avg_per_window", _rounded("avg_per_window"))


def metrics_csv(spark, sf_dir):
    path = new_folder(spark, "metrics")
    sinks.write_metrics(_enriched(spark, sf_dir), path)
    back = _bounds_as_ntz(sources.read_metrics(spark, path))
    return back.withColumn("avg_per_window", _rounded("avg_per_window"))


def replayed_totals(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return operators.totals(sources.union_runs(counts, counts))


def replayed_spikes(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return operators.spikes(sources.union_runs(counts, counts))


# -- overview -------------------------------------------------------------------------


def system_summary(spark, sf_dir):
    return operators.system_summary(_counts(spark, sf_dir)).withColumn(
        "avg_per_window", _rounded("avg_per_window")
    )


def kpis(spark, sf_dir):
    return operators.kpis(_counts(spark, sf_dir)).withColumn(
        "avg_per_window", _rounded("avg_per_window")
    )


def system_list(spark, sf_dir):
    return operators.system_list(_counts(spark, sf_dir))


def series_points(spark, sf_dir):
    return operators.in_time_order(operators.series(_counts(spark, sf_dir), threshold=10))


def series_of_system(spark, sf_dir):
    points = operators.series(_counts(spark, sf_dir), threshold=10, system="host-7")
    return operators.in_time_order(points)


def normal_windows(spark, sf_dir):
    return window_counts_short(spark, sf_dir).filter(is_normal())


def union_runs(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return sources.union_runs(counts, counts.drop("window_end"))


def backfilled_runs(spark, sf_dir):
    bare = _counts(spark, sf_dir).select("system", "window_start")
    return _bounds_as_ntz(sources.backfill(bare))


# -- streams --------------------------------------------------------------------------


def _closed_counts(spark: SparkSession, path: str, **options) -> DataFrame:
    counts = sources.typed_metrics(sources.read_counts(spark, path, **options))
    return _bounds_as_ntz(counts).select(
        "system",
        F.col("high_severity_count").cast("bigint").alias("high_severity_count"),
        "window_start",
        "window_end",
    )


def _send(spark: SparkSession, alerts: DataFrame, inbox: str) -> None:
    """More files of JSON payloads for a stream of files, one per task."""
    sinks.write_alerts(alerts, "text", inbox)


def _count_inbox(spark: SparkSession, inbox: str, path: str, progress: str, **options) -> None:
    """Work off what is new in an inbox, in one batch, into Parquet and onto the console."""
    raw = sources.stream_alerts(spark, "text", inbox)
    # The console sink prints; whoever runs this query reads other things there.
    with redirect_stdout(StringIO()):
        query = plans.count_stream(raw, path, progress, trigger=None, window=WINDOW, **options)
        query.awaitTermination()


def _thirds(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Alerts in three parts by time."""
    alerts = _all_alerts(spark, sf_dir)
    numbered = alerts.withColumn("_at", F.unix_micros(F.col("timestamp").cast("timestamp")))
    first, second = numbered.approxQuantile("_at", [1 / 3, 2 / 3], 0.01)
    at = F.col("_at")
    parts = [at <= first, (at > first) & (at <= second), at > second]
    return [numbered.filter(part).drop("_at") for part in parts]


def stream_window_counts(spark, sf_dir):
    """Events as a stream of files, counted into CSV files by a streaming aggregate."""
    schema = _table(spark, sf_dir, "events").schema
    # A stream takes a pattern where it refuses the path of one file.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    alerts = _alerts(events.filter("value >= 50"))
    alerts = alerts.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = new_folder(spark, "run")
    counts = operators.severity_counts(alerts, WINDOW)
    query = streaming.start_stream(counts, "csv", new_folder(spark, "progress"), path, trigger=None)
    query.awaitTermination()
    return _closed_counts(spark, path, file_format="csv")


def stream_json_counts(spark, sf_dir):
    """JSON payloads as a stream of text files, counted by the query that feeds both sinks."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    _send(spark, _all_alerts(spark, sf_dir), inbox)
    _count_inbox(spark, inbox, path, new_folder(spark, "progress"))
    return _closed_counts(spark, path)


def stream_late(spark, sf_dir):
    """The first third of the alerts comes again after all others, too late to count."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    progress = new_folder(spark, "progress")
    thirds = _thirds(spark, sf_dir)
    for part in (*thirds, thirds[0]):
        _send(spark, part, inbox)
        _count_inbox(spark, inbox, path, progress, console_rows=0)
    return _closed_counts(spark, path)


def stream_restart(spark, sf_dir):
    """The stream ends after the first third and goes on from its checkpoint with the others."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    progress = new_folder(spark, "progress")
    for part in _thirds(spark, sf_dir):
        _send(spark, part, inbox)
        _count_inbox(spark, inbox, path, progress, console_rows=0)
    return _closed_counts(spark, path)


def replayed_runs(spark, sf_dir):
    """Two runs over the same alerts, read together: totals count once per run."""
    inbox, runs = new_folder(spark, "inbox"), new_folder(spark, "runs")
    _send(spark, _all_alerts(spark, sf_dir), inbox)
    for run in ("run_1", "run_2"):
        _count_inbox(spark, inbox, f"{runs}/{run}", new_folder(spark, "progress"), console_rows=0)
    return operators.totals(_closed_counts(spark, runs, all_runs=True))


def stream_to_day(spark, sf_dir):
    """From payloads over the stream's table to the statistics of a day, which read its folder."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    _send(spark, _all_alerts(spark, sf_dir), inbox)
    _count_inbox(spark, inbox, path, new_folder(spark, "progress"), console_rows=0)
    stats = plans.daily_metrics(sources.read_counts(spark, path), DAY)["stats"]
    return stats.withColumn("avg_per_window", _rounded("avg_per_window"))


def stream_all_windows(spark, sf_dir):
    """What the stream has written and what it still holds when it ends: all windows."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    progress = new_folder(spark, "progress")
    _send(spark, _all_alerts(spark, sf_dir), inbox)
    _count_inbox(spark, inbox, path, progress, console_rows=0)
    closed = _closed_counts(spark, path).withColumn("open", F.lit(False))
    left = _bounds_as_ntz(streaming.open_windows(spark, progress))
    return closed.unionByName(left.withColumn("open", F.lit(True)))


def stream_time_of_all(spark, sf_dir):
    """Alerts of every severity close windows; the last day's are LOW ones here."""
    alerts = _all_alerts(spark, sf_dir)
    last = F.col("timestamp") >= F.lit(LAST_DAY.isoformat()).cast(NTZ)
    alerts = alerts.withColumn("severity", F.when(last, "LOW").otherwise(F.col("severity")))
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    _send(spark, alerts, inbox)
    progress = new_folder(spark, "progress")
    _count_inbox(spark, inbox, path, progress, console_rows=0, time_of="all")
    return _closed_counts(spark, path)


def stream_triggered(spark, sf_dir):
    """Batches by processing time instead of all at once."""
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    _send(spark, _all_alerts(spark, sf_dir), inbox)
    raw = sources.stream_alerts(spark, "text", inbox)
    query = plans.count_stream(
        raw, path, new_folder(spark, "progress"), "1 second", console_rows=0, window=WINDOW
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _closed_counts(spark, path)


def stream_dropped(spark, sf_dir):
    """Groups of alerts that a stream dropped, as its listener wrote them: those of a day that
    comes again behind all others."""
    alerts = _all_alerts(spark, sf_dir)
    day = operators.alerts_between(alerts, DAY, DAY + timedelta(days=1))
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "run")
    progress, dropped = new_folder(spark, "progress"), new_folder(spark, "dropped")
    listener = streaming.DroppedRows(spark, dropped)
    spark.streams.addListener(listener)
    try:
        # The watermark that drops is that of the batch before the last.
        for part in (alerts, day.filter("severity != 'HIGH'"), day):
            _send(spark, part, inbox)
            _count_inbox(spark, inbox, path, progress, console_rows=0)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    return streaming.read_dropped(spark, dropped).agg(F.sum("dropped").alias("dropped"))


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of sound alerts and of payloads with a problem; every thirteenth alert is no JSON,
    the one behind it has no time."""
    alerts = _all_alerts(spark, sf_dir)
    number = F.substring("key", 2, 20).cast("bigint") % 13
    lost = F.concat(F.lit('{"incident_id":"'), "key", F.lit('","severity":"HIGH"}'))
    payload = F.when(number == 5, F.concat(F.lit("broken {"), "key")).when(number == 6, lost)
    payloads = encode_alerts(alerts, key="incident_id")
    inbox = new_folder(spark, "inbox")
    payloads.select(F.coalesce(payload, "value").alias("value")).write.text(inbox)
    sound, others = new_folder(spark, "sound"), new_folder(spark, "quarantine")
    checked = checked_alerts(sources.stream_alerts(spark, "text", inbox))
    query = streaming.start_checked(checked, sound, others, new_folder(spark, "progress"), None)
    query.awaitTermination()
    return sound, others


def quarantine(spark, sf_dir):
    return spark.read.parquet(_quarantined(spark, sf_dir)[1]).select("payload", "problem")


def quarantine_counts(spark, sf_dir):
    alerts = spark.read.parquet(_quarantined(spark, sf_dir)[0])
    return _bounds_as_ntz(operators.severity_counts(alerts, WINDOW))


def metrics_rerun(spark, sf_dir):
    """Metrics by day, of which one day is computed again and replaced alone."""
    counts = store(_counts(spark, sf_dir), "counts")
    path = new_folder(spark, "metrics")
    sinks.write_metrics(counts, path, "parquet", ["window_date"])
    again = operators.for_day(counts, DAY)
    again = again.withColumn("high_severity_count", F.col("high_severity_count") * 10)
    sinks.write_metrics(again, path, "parquet", ["window_date"], replace="partitions")
    return spark.read.parquet(path).drop("window_date")


def empty_run(spark, sf_dir):
    """A run that has written nothing yet adds nothing to another one."""
    counts = store(_counts(spark, sf_dir), "counts")
    path = new_folder(spark, "run")
    sinks.write_metrics(counts.limit(0), path)
    nothing = _bounds_as_ntz(sources.read_metrics(spark, path)).select(*counts.columns)
    return sources.union_runs(counts, nothing)


def series_order(spark, sf_dir):
    """Points in the order of time with their place in it."""
    points = operators.series(_counts(spark, sf_dir), threshold=10)
    return operators.with_places(operators.in_time_order(points))


# -- similarity -----------------------------------------------------------------------


def incident_texts(spark, sf_dir):
    alerts = _all_alerts(spark, sf_dir)
    return alerts.select("incident_id", incident_text("message").alias("text"))


def history_csv(spark, sf_dir):
    """Documents as past incidents: texts with line breaks and quotes, columns in another order."""
    past = _table(spark, sf_dir, "documents").select(
        F.col("source").alias("system"),
        F.concat(F.lit('say "'), "text", F.lit('" twice')).alias("description"),
        F.concat(F.lit("D"), "doc_id").alias("incident_id"),
        F.col("n_chars").alias("mean_time_to_fix"),
        F.lit("REPORT").alias("alert_type"),
        F.concat(F.lit("restart\n"), "lang").alias("resolution"),
        F.col("lang").alias("component"),
    )
    path = new_folder(spark, "history")
    sinks.write_metrics(past, path)
    return sources.read_history(spark, path)


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    vectors = _table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return queries, vectors.select(F.col("vec_id").alias("id"), "embedding")


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth vector as a query."""
    return _vectors(spark, sf_dir)[0].filter("query_id % 50 = 0")


def _few(spark: SparkSession, sf_dir: str) -> int:
    """A bound that the queries keep and the corpus does not; it stands for a corpus as large as
    the small tables do not have."""
    return 8 * 64 * max(1, _asked(spark, sf_dir).count())


def knn(spark, sf_dir):
    """The vectors nearest to every fiftieth one."""
    found = knn_exact(_asked(spark, sf_dir), _vectors(spark, sf_dir)[1], 5)
    return found.withColumn("l2", _rounded("l2"))


def knn_sent(spark, sf_dir):
    """As above by the route for few queries on a large corpus."""
    corpus, few = _vectors(spark, sf_dir)[1], _few(spark, sf_dir)
    found = knn_exact(_asked(spark, sf_dir), corpus, 5, ship_bytes=few)
    return found.withColumn("l2", _rounded("l2"))


def knn_cells(spark, sf_dir):
    """As above by the route that compares two large sides whole."""
    corpus = _vectors(spark, sf_dir)[1]
    found = knn_exact(_asked(spark, sf_dir), corpus, 5, ship_bytes=0, cell_bytes=8 * 64 * 256, all_pairs=True)
    return found.withColumn("l2", _rounded("l2"))


def knn_by_pivots(spark, sf_dir):
    """As above by cells around pivots, of which a query visits those that its bound allows."""
    found = knn_pivots(_asked(spark, sf_dir), _vectors(spark, sf_dir)[1], 5)
    return found.withColumn("l2", _rounded("l2"))


def knn_recall(spark, sf_dir):
    """Probed against exact neighbours of every fiftieth vector: how many there are, the sum of
    their distances, whether nine tenths were found, and by comparing less than a fifth."""
    everything, corpus = _vectors(spark, sf_dir)
    asked = store(_asked(spark, sf_dir), "asked")
    index = ProbingIndex(corpus)
    plan = index.plan(everything, 5)
    exact = store(knn_exact(asked, corpus, 5), "exact")
    found = index.search(asked, 5, plan).select("query_id", "id", F.lit(1).alias("hit"))
    hits = exact.join(found, ["query_id", "id"], "left").select("query_id", "l2", "hit")
    compared = index.probes(asked, plan).select(F.col("_compared").alias("compared"))
    pairs = F.count_distinct("query_id") * index.rows
    return hits.unionByName(compared, allowMissingColumns=True).agg(
        F.count("l2").alias("neighbours"),
        F.round(F.sum("l2"), 6).alias("l2"),
        (F.count("hit") >= 0.9 * F.count("l2")).alias("recalled"),
        (F.sum("compared") < 0.2 * pairs).alias("below_a_fifth"),
    )


def knn_repeated_ids(spark, sf_dir):
    """A corpus in which every id names two vectors, by all three routes."""
    corpus = _vectors(spark, sf_dir)[1].withColumn("id", F.floor(F.col("id") / 2))
    asked, few = _asked(spark, sf_dir), _few(spark, sf_dir)
    routes = {
        "corpus sent": {},
        "queries sent": {"ship_bytes": few},
        "cells": {"ship_bytes": 0, "cell_bytes": 8 * 64 * 256, "all_pairs": True},
    }
    found = [
        knn_exact(asked, corpus, 5, **options).withColumn("route", F.lit(route))
        for route, options in routes.items()
    ]
    return reduce(DataFrame.unionByName, found).withColumn("l2", _rounded("l2"))


def knn_near(spark, sf_dir):
    """Every vector's nearest among those in its hash buckets: itself, or an equal one."""
    queries, corpus = _vectors(spark, sf_dir)
    found = knn_lsh(queries, corpus, 1, bucket_length=0.25, hashes_per_table=6)
    return found.withColumn("l2", _rounded("l2"))


def embed_text(spark, sf_dir):
    """What holds for hashed vectors whatever the hash: unit length, no more entries than
    words, equal vectors for equal texts."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # The table may be a single row group, and counting words is work for many tasks.
    vectors = embed(documents.repartition(spark.sparkContext.defaultParallelism))
    words = F.array_distinct(F.array_remove(F.split(F.lower("text"), r"\s+"), ""))
    entries = F.size(F.array_remove("embedding", F.lit(0).cast("float")))
    square = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda total, x: total + x * x)
    facts = store(
        vectors.select(
            "doc_id",
            F.xxhash64("text").alias("digest"),
            F.round(F.sqrt(square), 4).alias("length"),
            (entries <= F.size(words)).alias("sparse"),
            F.xxhash64("embedding").alias("vector"),
        ),
        "vectors",
    )
    same = facts.groupBy("digest").agg((F.min("vector") == F.max("vector")).alias("one_vector"))
    return facts.join(same, "digest").select("doc_id", "length", "sparse", "one_vector")


def weighted_text(spark, sf_dir):
    """Sum of a text's word weights, by how rare the words are in all documents."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    frequencies = store(word_frequencies(documents), "frequencies")
    vectors = embed_weighted(documents, frequencies, documents.count())
    return vectors.select("doc_id", _rounded("weight", 4), F.size("embedding").alias("dimension"))


def embed_model(spark, sf_dir):
    """A model of the caller's; here characters and lines of a text stand in for one."""

    # Defined in here, so that it travels with the job and workers need not import this file.
    def load():
        return lambda texts: [[len(text), text.count("\n") + 1] for text in texts]

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = embed_with(documents, load, output="v")
    return vectors.select(
        "doc_id",
        F.col("v")[0].cast("bigint").alias("characters"),
        F.col("v")[1].cast("bigint").alias("lines"),
    )


def vector_table(spark, sf_dir):
    path = new_folder(spark, "vectors")
    sinks.write_vectors(_table(spark, sf_dir, "embeddings"), path, key="vec_id")
    return spark.read.parquet(path).select("vec_id", "label", F.size("embedding").alias("dimension"))


def vector_upkeep(spark, sf_dir):
    """A corpus to which every fiftieth vector comes again with another label."""
    vectors, path = _table(spark, sf_dir, "embeddings"), new_folder(spark, "vectors")
    sinks.upsert_vectors(vectors, path, key="vec_id", buckets=64)
    changed = vectors.filter("vec_id % 50 = 0").withColumn("label", F.col("label") + 100)
    sinks.upsert_vectors(changed, path, key="vec_id")
    found = sinks.read_vectors(spark, path)
    return found.select("vec_id", "label", F.size("embedding").alias("dimension"))


def indexed_count(spark, sf_dir):
    path = new_folder(spark, "vectors")
    sinks.write_vectors(_table(spark, sf_dir, "embeddings"), path, key="vec_id")
    return spark.read.parquet(path).agg(F.count("*").alias("indexed"))


def _measures(texts: DataFrame) -> DataFrame:
    """An embedding that SQL can state: characters, blanks and commas of a text."""
    counts = [F.length("text")]
    counts += [F.length("text") - F.length(F.replace("text", F.lit(sign))) for sign in (" ", ",")]
    return texts.withColumn("embedding", F.array(*counts).cast("array<float>"))


def similar_incidents(spark, sf_dir):
    """Documents as alerts, benchmark items as past incidents."""
    alerts = _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("system"),
        F.col("lang").alias("component"),
        F.lit("REPORT").alias("alert_type"),
        F.col("text").alias("message"),
    )
    history = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("incident_id"),
        F.lit("archive").alias("system"),
        F.lit("library").alias("component"),
        F.lit("REPORT").alias("alert_type"),
        F.col("text").alias("description"),
    )
    path = new_folder(spark, "corpus")
    plans.index_history(history, path, _measures)
    found = plans.similar_incidents(alerts, spark.read.parquet(path), 3, _measures)
    return found.select("doc_id", "similar_id", "l2", "rank")


# -- contract -------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: window counts with the statistics of their system."""
    return enriched_metrics(spark, os.environ.get("KLAXON_ENTRY_SF", "/root/testdata/sf0.001"))


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the optional package for training data and of its pipeline."""
    try:
        import corpus_pipeline
        import klaxon.llm.queries as llm
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "klaxon.llm"):
            raise
        return {}, {}
    oracles = dict(llm.oracle_sql())
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.queries(), "pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_training_data()[0],
        "severity_filter": severity_filter,
        "window_counts": window_counts,
        "window_counts_short": window_counts_short,
        "decode_json": decode_json,
        "decode_counts": decode_counts,
        "event_times": event_times,
        "day_windows": day_windows,
        "day_windows_text": day_windows_text,
        "total_per_system": total_per_system,
        "avg_per_system": avg_per_system,
        "system_stats": system_stats,
        "peak_window": peak_window,
        "spikes": spikes,
        "spike_check": spike_check,
        "unknown_times": unknown_times,
        "enriched_metrics": enriched_metrics,
        "metrics_csv": metrics_csv,
        "replayed_totals": replayed_totals,
        "replayed_spikes": replayed_spikes,
        "system_summary": system_summary,
        "kpis": kpis,
        "system_list": system_list,
        "series_points": series_points,
        "series_of_system": series_of_system,
        "normal_windows": normal_windows,
        "union_runs": union_runs,
        "backfilled_runs": backfilled_runs,
        "stream_window_counts": stream_window_counts,
        "stream_json_counts": stream_json_counts,
        "stream_late": stream_late,
        "stream_restart": stream_restart,
        "replayed_runs": replayed_runs,
        "stream_to_day": stream_to_day,
        "stream_all_windows": stream_all_windows,
        "stream_time_of_all": stream_time_of_all,
        "stream_triggered": stream_triggered,
        "stream_dropped": stream_dropped,
        "quarantine": quarantine,
        "quarantine_counts": quarantine_counts,
        "metrics_rerun": metrics_rerun,
        "empty_run": empty_run,
        "series_order": series_order,
        "incident_text": incident_texts,
        "history_csv": history_csv,
        "knn_exact": knn,
        "knn_sent": knn_sent,
        "knn_cells": knn_cells,
        "knn_repeated_ids": knn_repeated_ids,
        "knn_pivots": knn_by_pivots,
        "knn_recall": knn_recall,
        "knn_lsh": knn_near,
        "embed_text": embed_text,
        "weighted_text": weighted_text,
        "embed_model": embed_model,
        "vector_table": vector_table,
        "vector_upkeep": vector_upkeep,
        "indexed_count": indexed_count,
        "similar_incidents": similar_incidents,
    }


_ALERTS = """alerts AS (
  SELECT 'E' || event_id AS incident_id,
         'host-' || (user_id % 40) AS system,
         'unit-' || (user_id % 7) AS component,
         event_type AS alert_type,
         CASE WHEN value >= 50 THEN 'HIGH' WHEN value >= 15 THEN 'MEDIUM'
              ELSE 'LOW' END AS severity,
         props AS message,
         ts AS "timestamp"
  FROM events)"""


def _counts_sql(window: str = "6 hours") -> str:
    return f"""{_ALERTS}, counts AS (
  SELECT system,
         count(incident_id) AS high_severity_count,
         time_bucket(INTERVAL '{window}', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL '{window}', "timestamp", TIMESTAMP '1970-01-01')
           + INTERVAL '{window}' AS window_end
  FROM alerts
  WHERE severity = 'HIGH' AND "timestamp" IS NOT NULL
  GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    """SQL with the same result. Hashed vectors, hash buckets and what follows from them
    cannot be expressed and have none; tests check them against brute force."""
    alerts, counts, short = f"WITH {_ALERTS}", f"WITH {_counts_sql()}", f"WITH {_counts_sql('10 seconds')}"
    early = f"\"timestamp\" < TIMESTAMP '{LAST_DAY}'"
    day = "window_start >= TIMESTAMP '2024-01-02' AND window_start < TIMESTAMP '2024-01-03'"
    total = "CAST(sum(high_severity_count) AS BIGINT)"
    average = "round(avg(high_severity_count), 6)"
    enriched = f"""{counts}, stats AS (
      SELECT system, {total} AS total_high_severity, {average} AS avg_per_window
      FROM counts GROUP BY system)
    SELECT c.*, s.total_high_severity, s.avg_per_window
    FROM counts c LEFT JOIN stats s ON c.system = s.system"""
    points = """SELECT CASE WHEN high_severity_count < 10 THEN 'normal' ELSE 'spike' END AS series,
           system, window_start, window_end, high_severity_count FROM counts"""
    closed = f"""{counts} SELECT * FROM counts WHERE window_end <=
      (SELECT max("timestamp") - INTERVAL '1 minute' FROM alerts WHERE severity = 'HIGH')"""
    pairs = """WITH pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id AS id,
             list_sum(list_transform(
               list_zip(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])),
               lambda s: (s[1] - s[2]) * (s[1] - s[2]))) AS l2
      FROM embeddings q CROSS JOIN embeddings c WHERE q.vec_id % 50 = 0), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY l2, id) AS place FROM pairs)"""
    neighbours = f"""{pairs} SELECT query_id, id, round(l2, 6) AS l2, CAST(place AS INTEGER) AS rank
      FROM ranked WHERE place <= 5"""
    measures = """[length(text), length(text) - length(replace(text, ' ', '')),
      length(text) - length(replace(text, ',', ''))]"""
    return {
        **_training_data()[1],
        "severity_filter": f"{alerts} SELECT * FROM alerts WHERE severity = 'HIGH'",
        "window_counts": f"{counts} SELECT * FROM counts",
        "window_counts_short": f"{short} SELECT * FROM counts",
        "decode_json": f"{alerts} SELECT * FROM alerts",
        "decode_counts": f"{counts} SELECT * FROM counts",
        "event_times": """SELECT event_id, ts AS long_required,
             CAST(NULL AS TIMESTAMP) AS short_required, ts AS long_optional,
             date_trunc('second', ts) AS short_optional, CAST(NULL AS TIMESTAMP) AS junk
             FROM events""",
        "day_windows": f"{counts} SELECT * FROM counts WHERE {day}",
        "day_windows_text": f"""{counts} SELECT system,
             CAST(high_severity_count AS INTEGER) AS high_severity_count,
             strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z') AS window_start,
             strftime(window_end, '%Y-%m-%dT%H:%M:%S.000Z') AS window_end
             FROM counts WHERE {day}""",
        "total_per_system": f"""{counts} SELECT system, {total} AS total_high_severity
             FROM counts GROUP BY system""",
        "avg_per_system": f"""{counts} SELECT system, {average} AS avg_per_window
             FROM counts GROUP BY system""",
        "system_stats": f"""{counts} SELECT system, {total} AS total_high_severity,
             {average} AS avg_per_window FROM counts GROUP BY system""",
        "peak_window": f"""{counts} SELECT * FROM counts
             ORDER BY high_severity_count DESC, window_start, system LIMIT 1""",
        "spikes": f"{counts} SELECT DISTINCT * FROM counts WHERE high_severity_count >= 3",
        "spike_check": f"""{counts} SELECT count(*) > 0 AS has_spikes FROM counts
             WHERE high_severity_count >= 3""",
        "enriched_metrics": enriched,
        "metrics_csv": enriched.replace(
            "c.*", "c.* REPLACE (CAST(c.high_severity_count AS INTEGER) AS high_severity_count)"
        ),
        "replayed_totals": f"""{counts} SELECT system, 2 * {total} AS total_high_severity
             FROM counts GROUP BY system""",
        "replayed_spikes": f"{counts} SELECT * FROM counts WHERE high_severity_count >= 3",
        "system_summary": f"""{counts} SELECT system, {total} AS total_high_severity,
             {average} AS avg_per_window, count(*) FILTER (high_severity_count >= 3) AS spikes
             FROM counts WHERE system IS NOT NULL GROUP BY system""",
        "kpis": f"""{counts} SELECT coalesce({total}, 0) AS total_incidents,
             {average} AS avg_per_window, count(*) FILTER (high_severity_count >= 3) AS spikes
             FROM counts""",
        "system_list": f"""{counts} SELECT system, min(window_start) AS first_seen
             FROM counts GROUP BY system""",
        "series_points": f"{counts} {points}",
        "series_of_system": f"{counts} {points} WHERE system = 'host-7'",
        "normal_windows": f"{short} SELECT * FROM counts WHERE high_severity_count < 3",
        "union_runs": f"""{counts} SELECT * FROM counts UNION ALL BY NAME
             SELECT * EXCLUDE (window_end) FROM counts""",
        "backfilled_runs": f"""{counts} SELECT system, window_start,
             CAST(0 AS INTEGER) AS high_severity_count,
             TIMESTAMP '1970-01-01' AS window_end FROM counts""",
        "stream_window_counts": closed,
        "stream_json_counts": closed,
        "stream_late": closed,
        "stream_restart": closed,
        "replayed_runs": f"""WITH closed AS ({closed})
             SELECT system, 2 * {total} AS total_high_severity FROM closed GROUP BY system""",
        "stream_to_day": f"""WITH closed AS ({closed})
             SELECT system, {total} AS total_high_severity, {average} AS avg_per_window
             FROM closed WHERE {day} GROUP BY system""",
        "stream_all_windows": f"""{counts} SELECT *, window_end >
             (SELECT max("timestamp") - INTERVAL '1 minute' FROM alerts WHERE severity = 'HIGH') AS open
             FROM counts""",
        "stream_time_of_all": f"""{counts.replace("severity = 'HIGH' AND", f"severity = 'HIGH' AND {early} AND")}
             SELECT * FROM counts WHERE window_end <=
             (SELECT max("timestamp") - INTERVAL '1 minute' FROM alerts)""",
        "stream_triggered": closed,
        "stream_dropped": f"""{counts} SELECT CAST(count(*) AS BIGINT) AS dropped
             FROM counts WHERE {day}""",
        "quarantine": f"""{alerts} SELECT CASE WHEN substr(incident_id, 2)::BIGINT % 13 = 5
               THEN 'broken {{' || incident_id
               ELSE '{{"incident_id":"' || incident_id || '","severity":"HIGH"}}' END AS payload,
             CASE WHEN substr(incident_id, 2)::BIGINT % 13 = 5 THEN 'not JSON'
               ELSE 'no event time' END AS problem
             FROM alerts WHERE substr(incident_id, 2)::BIGINT % 13 IN (5, 6)""",
        "quarantine_counts": f"""{counts.replace('"timestamp" IS NOT NULL', "substr(incident_id, 2)::BIGINT % 13 NOT IN (5, 6)")}
             SELECT * FROM counts""",
        "metrics_rerun": f"""{counts} SELECT * REPLACE (CASE WHEN {day}
             THEN 10 * high_severity_count ELSE high_severity_count END AS high_severity_count)
             FROM counts""",
        "empty_run": f"{counts} SELECT * FROM counts",
        "series_order": f"""{counts}, points AS ({points})
             SELECT *, row_number() OVER (ORDER BY window_start, window_end, system) AS place
             FROM points""",
        "knn_pivots": neighbours,
        "knn_recall": f"""{pairs} SELECT count(*) AS neighbours, round(sum(l2), 6) AS l2,
             true AS recalled, true AS below_a_fifth FROM ranked WHERE place <= 5""",
        "weighted_text": r"""WITH words AS (
             SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\s\x0b]+')) AS word FROM documents),
             counted AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
             known AS (SELECT word, count(*) AS m FROM counted GROUP BY word),
             weights AS (SELECT doc_id, sum(n * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE)
               / (m + 1.0::DOUBLE))) AS weight FROM counted JOIN known USING (word) GROUP BY doc_id)
             SELECT doc_id, round(coalesce(weight, 0), 4) AS weight, 256::INTEGER AS dimension
             FROM documents LEFT JOIN weights USING (doc_id)""",
        "vector_upkeep": """SELECT vec_id, CAST(label + CASE WHEN vec_id % 50 = 0 THEN 100 ELSE 0 END
             AS INTEGER) AS label, CAST(len(embedding) AS INTEGER) AS dimension FROM embeddings""",
        "unknown_times": f"""{counts.replace('"timestamp" IS NOT NULL', "CAST(substr(incident_id, 2) AS BIGINT) % 7 != 0")}
             SELECT * FROM counts""",
        "incident_text": f"""{alerts} SELECT incident_id,
             system || ' ' || component || ' ' || alert_type || ' ' || message AS text
             FROM alerts""",
        "history_csv": """SELECT 'D' || doc_id AS incident_id, source AS system, lang AS component,
             'REPORT' AS alert_type, 'say "' || text || '" twice' AS description,
             'restart' || chr(10) || lang AS resolution,
             CAST(n_chars AS INTEGER) AS mean_time_to_fix FROM documents""",
        "knn_repeated_ids": f"""{pairs.replace("c.vec_id AS id", "c.vec_id // 2 AS id")}
             SELECT route, query_id, id, round(l2, 6) AS l2, CAST(place AS INTEGER) AS rank
             FROM ranked, (VALUES ('corpus sent'), ('queries sent'), ('cells')) AS routes (route)
             WHERE place <= 5""",
        "knn_lsh": """SELECT vec_id AS query_id, min(vec_id) OVER (PARTITION BY embedding) AS id,
             CAST(0 AS DOUBLE) AS l2, CAST(1 AS INTEGER) AS rank FROM embeddings""",
        "embed_text": """SELECT doc_id, CAST(trim(text) != '' AS DOUBLE) AS length,
             true AS sparse, true AS one_vector FROM documents""",
        "similar_incidents": f"""WITH asked AS (
             SELECT doc_id, source || ' ' || lang || ' REPORT ' || text AS text FROM documents),
             known AS (SELECT item_id, 'archive library REPORT ' || text AS text FROM benchmark),
             q AS (SELECT doc_id, {measures} AS a FROM asked),
             c AS (SELECT item_id, {measures} AS b FROM known), pairs AS (
             SELECT doc_id, item_id AS similar_id, CAST((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2
               + (a[3] - b[3]) ** 2 AS DOUBLE) AS l2 FROM q CROSS JOIN c), ranked AS (
             SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l2, similar_id) AS place
             FROM pairs)
             SELECT doc_id, similar_id, l2, CAST(place AS INTEGER) AS rank FROM ranked
             WHERE place <= 3""",
        "knn_exact": neighbours,
        "knn_sent": neighbours,
        "knn_cells": neighbours,
        "embed_model": """SELECT doc_id, length(text) AS characters,
             len(string_split(text, chr(10))) AS lines FROM documents""",
        "vector_table": """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dimension
             FROM embeddings""",
        "indexed_count": "SELECT count(*) AS indexed FROM embeddings",
    }
