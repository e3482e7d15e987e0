"""The training-data pipeline: documents in, sampled token sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import linededup, mixing, sentencepieces, setsketch, toxicity
from hirelake.llm.stored import stored, work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows among them, does not reject."""
    plan = toxicity.ToxicPlan()
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), plan)
    scored = toxicity.score(docs, model, plan)
    return scored.where(F.col(scored.columns[-1]) < plan.threshold).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; one of which nothing is left goes."""
    out = linededup.without_repeats(docs)
    left = (F.col("n_runs") == 0) | F.col("text").rlike(mixing.WORD)
    size = F.when(F.col("n_runs") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.where(left).withColumn("n_chars", size).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    gone = setsketch.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, as copies or parts of the documents."""
    return mixing.mixed_documents(docs).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, pieces, n_pieces, lossless) of every text."""
    return sentencepieces.encode(docs, sentencepieces.load())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Learned scores, hashes and sampling have no SQL; tests/llm/test_pipeline.py checks each stage instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage{k}")
    return docs
