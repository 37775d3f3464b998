"""Past incidents that resemble an alert."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.functions.conversions import incident_text
from klaxon.operators.embedding import embed
from klaxon.operators.joins import left_join_measured
from klaxon.operators.similarity import knn_exact
from klaxon.session import store
from klaxon.sinks.tables import write_vectors


def index_history(
    history: DataFrame, path: str, embedder: Callable[[DataFrame], DataFrame] = embed
) -> int:
    """Write the vector corpus of past incidents and return the number of incidents."""
    texts = history.withColumn("text", incident_text("description"))
    return write_vectors(embedder(texts), path)


def similar_incidents(
    alerts: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    embedder: Callable[[DataFrame], DataFrame] = embed,
    corpus_id: str = "incident_id",
    search: Callable[..., DataFrame] = knn_exact,
) -> DataFrame:
    """Every alert with its ``k`` nearest past incidents: ``similar_id``, ``l2``, ``rank``.

    Alerts repeat few texts, so vectors and neighbours are computed once per distinct
    text. A digest stands for the text from there on, so that whole texts shuffle once.
    An alert without a complete text keeps one row without neighbour.

    Where both the distinct texts and the corpus are too many to send, the search fails
    rather than compare all pairs: pass ``knn_pivots`` as ``search`` for the exact neighbours of two
    large sides, or ``knn_probed`` for nine tenths of them at less work.
    """
    digest = F.sha2("text", 256).alias("_digest")
    texts = alerts.select(incident_text("message").alias("text"))
    distinct = texts.filter(F.col("text").isNotNull()).distinct()
    # Stored, as the neighbour search measures its input before it reads it.
    vectors = store(embedder(distinct).select(digest, "embedding"), "vectors")
    past = corpus.select(F.col(corpus_id).alias("similar_id"), "embedding")
    found = search(vectors, past, k, query_id="_digest", corpus_id="similar_id")
    keyed = alerts.withColumn("_digest", F.sha2(incident_text("message"), 256))
    return left_join_measured(keyed, found, ["_digest"]).drop("_digest")
