"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``docs``; the last one returns their tokens. ``run`` writes every
stage's result as Parquet in the shared folder and reads it again, so a lost
executor costs no more than the stage at hand.

A stage first has the executors give back what the one before has left in their
memory; else every stage adds its share to heaps that only grow.

Rows with a null id or text pass every stage: nothing can be said against them.
Columns beyond those of ``documents`` pass through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, decontaminate, linedup, partenum, toxicity
from riskframe.llm.frames import released, small_if_counted
from riskframe.session import durable, scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOXIC = 0.7


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` less the rows of some ids; the texts are not shuffled unless the ids are very many."""
    gone = durable(ids.select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(small_if_counted(gone), F.col("doc_id") == F.col("__gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below the threshold."""
    released(spark)
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    # A score is a function of the text, so texts are dropped by their digest and not carried along.
    plain = docs.select("text", F.sha2("text", 256).alias("__said"))
    judged = toxicity.score(plain, index, ["__said"])
    gone = durable(judged.where(F.col("score") >= TOXIC).select(F.col("__said").alias("__gone")).distinct())
    return docs.join(small_if_counted(gone), F.sha2("text", 256) == F.col("__gone"), "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs of 50 words or more."""
    released(spark)
    plain = docs.withColumnsRenamed({c: f"__{c}" for c in docs.columns if c not in ("doc_id", "text")})
    clean = linedup.dedup_lines(plain).drop("n_lines", "n_deleted")
    clean = clean.withColumnsRenamed({f"__{c}": c for c in docs.columns if c not in ("doc_id", "text")})
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by a Jaccard similarity of 0.8 over five-word shingles."""
    released(spark)
    # Rows that repeat an id are judged by their own texts.
    told = docs.select("doc_id", "text", F.sha2("text", 256).alias("__said"))
    groups = partenum.near_duplicates(told, size=5, percent=80, keep=("__said",))
    gone = durable(
        groups.where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias("__gone"), F.col("__said").alias("__as")).distinct()
    )
    same = (F.col("doc_id") == F.col("__gone")) & (F.sha2("text", 256) == F.col("__as"))
    return docs.join(small_if_counted(gone), same, "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item to 0.8 or more of its five-word shingles."""
    released(spark)
    return without(docs, decontaminate.contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens, ids_sha256, decoded_sha256): tokens, and digests of them and of what they decode to."""
    released(spark)
    return bpe.round_trip(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, ids_column="token_ids").drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: The stages learn, search and encode; SQL cannot express them. tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
