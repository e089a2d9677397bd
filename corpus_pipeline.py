"""A training corpus from raw documents: filter, dedup, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's rows under the cluster's shared folder and reads them
back as the next stage's documents.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.llm import decontaminate, mixing, neardup, quality, tokenfiles


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at ``quality.THRESHOLD`` or more.

    Empty texts score below it and go.
    """
    C.ready(spark)
    model = quality.fit_tables(spark, sf_dir)
    scored = quality.score(docs, model, out_col="__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (five
    words, similarity 0.8); documents without words all stay."""
    C.ready(spark, C.BATCH_BYTES)
    return neardup.one_of_each(docs, width=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    C.ready(spark)
    return decontaminate.without_hits(docs, C.read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each time a document is taken, whole,
    shard by shard in random order."""
    C.ready(spark)
    # The slots' window has brought each shard's rows together.
    mix = mixing.mix(docs).sortWithinPartitions("mix_shard", "mix_slot")
    return mix.select(*[F.col(f"`{c}`") for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document of the mix."""
    C.ready(spark, C.BATCH_BYTES)
    path = tokenfiles.write_shards(docs, tokenfiles.default_tokenizer(), forget=True)
    return tokenfiles.read_shards(spark, path)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
    ("token_files", encoded),
]

# Compression, minhash and tokenizers have no SQL form: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = C.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
