"""The registered queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import fptree, kneserney, linededup, mixing, pii, pqdedup, qualityrules, resampling, sentencepieces, srsearch, toxicity, wrappers
from hirelake.llm.setsketch import near_duplicates


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.taken_words(documents(spark, sf_dir))
    places = [F.size("shards").cast("long").alias("n_shards"), F.get("shards", F.lit(0))["shard"].alias("first_shard")]
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *places)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(documents(spark, sf_dir), sentencepieces.load())


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pqdedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(documents(spark, sf_dir)).select("doc_id", "text", "n_runs", "removed_words", "removed_spans")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srsearch.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.verdicts(documents(spark, sf_dir))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pii": op2_pii,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_quality": op5_quality,
    "op6_html_main_text": op6_html_main_text,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op11_ranked_search": fptree.SQL,
    "op12_quality_rules": qualityrules.SQL,
    "op13_importance_resampling": resampling.SQL,
}
