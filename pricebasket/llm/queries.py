"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricebasket.llm import conversations, decontaminate, html_main, language_id, lm_scoring, near_dup, oracles, packing, quality, ranked_search, sharding, suffix_dedup, token_counts, token_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op12_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op13_ranked_search": oracles.RANKED_SEARCH,
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(documents(spark, sf_dir))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), length=100)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.good_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), size=2, percent=80)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), shards=16)


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), capacity=4096, end=2)


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(documents(spark, sf_dir), limit=4096)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)
