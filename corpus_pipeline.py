"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

Rows travel from stage to stage as Parquet; all stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket.llm import batches, decontaminate, near_dup, packing, quality, suffix_dedup
from pricebasket.session import stage

#: Columns that operators read; all others are carried under names that clash with nothing.
READ = ("doc_id", "text", "lang")


def _carried(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    names = {name: name if name in READ else f"_carried_{i}" for i, name in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{old}`").alias(new) for old, new in names.items())), names


def _back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(new).alias(old) for old, new in names.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, names = _carried(docs)
    judged = quality.with_verdict(rows, quality.good_sample(rows.select("doc_id", "text", "lang"), labels))
    return _back(judged.filter("kept"), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words agree in 80 of 100."""
    rows, names = _carried(docs)
    return _back(near_dup.one_of_each(rows, size=5, percent=80), names)


def suffix_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that came earlier.

    A character of which a part was removed goes whole. Where no word is left, the document goes.
    ``n_chars``, if there, is that of the new text.
    """
    rows, names = _carried(docs)
    cut = suffix_dedup.with_kept_text(rows.withColumn("_null", F.col("text").isNull()), length=100)
    cut = batches.with_columns(
        cut, ["kept_text", "_null"],
        lambda texts, null: {"text": [None if no else text.decode("utf-8", "ignore") for text, no in zip(texts, null)]},
        "text string", ("kept_text", "_null"))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn(names["n_chars"], F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col(names["n_chars"])))
    return _back(cut.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")), names)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    rows, names = _carried(docs)
    found = decontaminate.with_items(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _back(found.filter("not contaminated"), names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4096."""
    return packing.pack(docs, capacity=4096, end=2)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("suffix duplicates", suffix_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: SQL cannot express the model, the sketches and the tokenizer: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
