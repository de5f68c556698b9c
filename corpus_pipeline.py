"""The corpus pipeline: from documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and all but the last return the columns of documents. ``n_chars`` follows
the text where a stage changes it. Stages read docs more than once, so each
stage's result is written as a table before the next one starts; ``run`` does
so in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontamination, line_dedup, packing, quality, simhash
from skein.llm.workspace import Workspace, unused


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more; a null text is scored as an empty one, repeated rows each."""
    network = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused("score", docs)
    return quality.score_quality(docs, network, docs.columns, out=score).where(F.col(score) >= 0.5).drop(score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one line of each group of near-duplicate lines; every document stays, a null text as an empty one."""
    found = line_dedup.dedup_lines(docs, Workspace(spark, "lines")).select(docs.columns)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash, that of the least doc_id, null ids last; null texts count as empty."""
    return simhash.one_of_each(docs, Workspace(spark, "simhash"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages cut out; every document stays, null and empty texts as they are."""
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 1024."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: The stages are a trained model, MinHash, SimHash and a packing heuristic; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work.table(docs, f"stage{i}")
            work.keep_only(f"stage{i}")
    return docs
