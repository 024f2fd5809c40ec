"""The pipeline, stage by stage against brute force on each stage's own input."""

from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
import pytest
import test_decontaminate
import test_near_dup
import test_quality
import test_suffix_dedup
from pricebasket.llm import packing, quality, suffix_dedup
from pricebasket.session import stage
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def steps(spark, docs, sf_dir):
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        found.append(stage(function(spark, found[-1], sf_dir), "step"))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(steps, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "suffix duplicates", "benchmark decontamination", "packing"]
    for step in steps[1:-1]:
        assert step.columns == docs.columns and step.dtypes == docs.dtypes


def test_quality_stage(spark, steps, sf_dir):
    before, after = texts(steps[0]), texts(steps[1])
    good = quality.good_sample(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in quality.judge(steps[0], good).collect() if r["kept"]}
    assert set(after) == kept and all(after[key] == before[key] for key in after)
    for key, text in before.items():
        n, _, _, _, repeated = test_quality.brute(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert key not in after


def shingles(text, size=5):
    words = list(test_near_dup.sets_words(text))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def test_near_duplicate_stage(steps):
    rows = sorted(texts(steps[1]).items())
    found = [(key, shingles(text)) for key, text in rows]
    group = {key: key for key, _ in rows}
    for i, (key, a) in enumerate(found):
        for other, b in found[:i]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = sorted((group[key], group[other]))[::-1]
                group = {k: new if v == old else v for k, v in group.items()}
    assert set(texts(steps[2])) == set(group.values())


def test_suffix_stage(steps):
    before, after = texts(steps[2]), {r["doc_id"]: r for r in steps[3].collect()}
    expected = test_suffix_dedup.kept(sorted(before.items()), 100)
    for key, raw in expected.items():
        text = raw.decode("utf-8", "ignore")
        if text == before[key]:
            assert after[key]["text"] == text
        elif text.strip(" \t\n\v\f\r"):
            assert after[key]["text"] == text and after[key]["n_chars"] == len(text)
        else:
            assert key not in after


def test_decontamination_stage(spark, steps, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    assert after == {key: text for key, text in before.items() if not test_decontaminate.brute(text, items)}


def test_packing_stage(steps):
    def digest(df):
        return Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in df.collect())

    assert digest(steps[5]) == digest(packing.pack(steps[4]))


def test_run_is_the_stages(spark, sf_dir, steps):
    got = contract.queries()["pipeline"](spark, sf_dir)
    assert got.columns == steps[5].columns
    assert got.groupBy().agg(F.count("*"), F.sum("ids_crc32"), F.sum("length")).first() == steps[5].groupBy().agg(
        F.count("*"), F.sum("ids_crc32"), F.sum("length")).first()
    assert "pipeline" not in contract.oracle_sql()


def test_odd_rows_pass_all_stages(spark, odd, docs, sf_dir):
    both = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang")).withColumn("kept", F.lit(1)).withColumn("shard", F.lit("s"))
    step = both
    for _, function in corpus_pipeline.STAGES[:-1]:
        step = stage(function(spark, step, sf_dir), "step")
        assert step.columns == both.columns
    assert step.count() > 0
    empty = docs.limit(0)
    for _, function in corpus_pipeline.STAGES:
        empty = stage(function(spark, empty, sf_dir), "step")
    assert empty.count() == 0


def test_one_of_each_row(spark, odd):
    rows = corpus_pipeline.near_duplicates(spark, odd, "").select("doc_id", "text").collect()
    assert Counter(r["text"] for r in rows) == Counter({r["text"]: 1 for r in odd.collect()})
    assert {r["doc_id"] for r in rows if r["text"] == "same text twice"} == {11}


def test_every_operator_is_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10
    assert suffix_dedup.GRAM < 100


CLASHES = ["_h", "_at", "_key", "_none", "_null", "_doc", "_raw", "_spans", "n", "score", "_text_hash", "_lang", "node", "h", "kept", "shard"]


@pytest.mark.parametrize("number", range(4))
def test_columns_of_any_name_come_through_unchanged(spark, sf_dir, number):
    """Extra columns under the names that operators use inside keep their values through each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    extra = docs.withColumns({name: F.concat(F.lit(name), "doc_id") for name in CLASHES})
    name, function = corpus_pipeline.STAGES[number]
    got = function(spark, extra, sf_dir)
    assert got.columns == extra.columns, name
    rows = got.select("doc_id", *CLASHES).collect()
    assert rows and all(row[clash] == f"{clash}{row['doc_id']}" for row in rows for clash in CLASHES)
