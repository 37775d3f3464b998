"""Documents to packed sequences: toxic and repeated documents and those that hold benchmark
passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir); its result is written and read back before the next.
All but the last return the columns of ``documents`` and keep what they do not reject.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from klaxon.llm import decontamination, minhash, packing, toxicity
from klaxon.session import bound_batches, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut."""
    bound_batches(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its shingles of five words."""
    bound_batches(spark)
    return minhash.without_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half the words of every benchmark item."""
    bound_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("best-fit packing", pack),
]

# Models, hashes and tokenizers are not within reach of SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
