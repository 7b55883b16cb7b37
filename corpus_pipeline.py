"""From raw documents to packed training sequences: five stages, each an operator of ``filelake.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake.llm import line_dedup, mixing, packing, queries, scratch, simhash, toxicity

# A source is repeated at most this often, as the small ones are raised towards equal shares.
MAX_REPETITION = 2.0
TARGET_ENTROPY = 0.98


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model is trained from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    return docs.filter(toxicity.score_of(F.col("text"), spark, model) < 0.5)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; ``n_chars`` follows the text."""
    cut = line_dedup.line_dedup(docs)
    return cut.withColumn("n_chars", F.when(F.col("removed_lines").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast("long")
    )).select(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link: four-word shingles, at most 4 differing bits."""
    return simhash.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources again, up to the limit of repetition."""
    mixed = mixing.mix(docs, target_entropy=TARGET_ENTROPY, max_repetition=MAX_REPETITION)
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: one row per piece of a document."""
    return packing.pack_documents(docs, queries.TOKENIZER)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("simhash_dedup", remove_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Neither the classifier nor tokenizers and packing can be said in SQL: tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is removed once the next one is written."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, written = scratch.put(stage(spark, docs, sf_dir), f"stage-{name}")
        scratch.drop(spark, path)
        path = written
    return STAGES[-1][1](spark, docs, sf_dir)
