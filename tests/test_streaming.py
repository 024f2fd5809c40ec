"""Streams run to completion on file sources; their tables equal the batch results."""

import json
import os

from pricebasket import schemas
from pricebasket.operators import consolidate, posts
from pricebasket.session import new_dir, stage, work_area
from pricebasket.streaming import jobs
from pyspark.sql import functions as F


def drop(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(row) for row in rows))


def source(spark, path, schema, per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(str(path))


KEYED = "id STRING, at INT, v STRING"


def test_first_write_wins_across_batches_and_restarts(spark, tmp_path):
    inbox, target, log = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "log")
    drop(inbox, "1.json", [{"id": "a", "at": 2, "v": "late"}, {"id": "a", "at": 1, "v": "first"}, {"id": "b", "at": 3, "v": "b"}])

    def run():
        jobs.insert_stream(source(spark, inbox, KEYED), target, log, ["id"], ["at"]).awaitTermination()

    run()
    drop(inbox, "2.json", [{"id": "a", "at": 0, "v": "too late"}, {"id": "c", "at": 9, "v": "c"}])
    run()
    run()
    got = spark.read.schema(KEYED).parquet(target).select("id", "at", "v").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "first"), ("b", 3, "b"), ("c", 9, "c")]


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], KEYED)
    for _ in range(2):
        jobs.insert_if_absent(batch, str(tmp_path / "t"), ["id"], ["at"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_null_keys_are_inserted_once(spark, tmp_path):
    batch = spark.createDataFrame([(None, 2, "x"), (None, 1, "first"), ("b", 1, "y")], KEYED)
    for _ in range(3):
        jobs.insert_if_absent(batch, str(tmp_path / "t"), ["id"], ["at"])
    got = spark.read.parquet(str(tmp_path / "t")).select("id", "at", "v").collect()
    assert sorted(map(str, map(tuple, got))) == ["('b', 1, 'y')", "(None, 1, 'first')"]


def rows_read(df):
    """Rows that the plan's file scans gave, after running it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_batch_reads_only_files_that_hold_its_keys(spark, tmp_path):
    """The rows read for a batch of few keys stay the same while the table grows four times."""
    target = str(tmp_path / "t")

    def batch(low, high):
        return spark.range(low, high).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").cast("int").alias("at"), F.lit("v").alias("v"))

    def read_for(keys):
        stored = spark.read.parquet(target)
        hashes = [r[0] for r in keys.select(F.xxhash64("id")).collect()]
        return rows_read(jobs.present_keys(spark, target, stored.schema, ["id"], hashes))

    seen = []
    for part in range(8):
        jobs.insert_if_absent(batch(part * 5000, (part + 1) * 5000), target, ["id"], ["at"])
        if part in (1, 7):
            # New keys are in no file; keys of the first batch are in its file alone.
            seen.append((read_for(batch(900_000, 900_300)), read_for(batch(10, 310))))
    assert seen == [(0, 5000), (0, 5000)]
    # As many keys as are looked up one by one.
    assert read_for(batch(900_000, 900_000 + jobs.LOOKED_UP)) <= 5000
    # Old and new keys at once: only the new ones are added.
    jobs.insert_if_absent(batch(39_900, 40_100), target, ["id"], ["at"])
    table = spark.read.parquet(target)
    assert table.count() == 40_100 == table.select("id").distinct().count()


def test_large_batches_and_small_ones_give_one_table(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 700).cast("string").alias("id"), F.col("id").cast("int").alias("at"), F.lit("v").alias("v"))
    for looked_up, file_rows in ((4000, 500_000), (10, 100)):
        monkeypatch.setattr(jobs, "LOOKED_UP", looked_up)
        monkeypatch.setattr(jobs, "FILE_ROWS", file_rows)
        target = str(tmp_path / f"t{looked_up}")
        for part in (rows.filter("at < 500"), rows.filter("at >= 300"), rows):
            jobs.insert_if_absent(part, target, ["id"], ["at"])
        got = spark.read.parquet(target).select("id", "at").collect()
        assert sorted((int(r["id"]), r["at"]) for r in got) == [(i, i) for i in range(700)]


def test_tables_of_one_file_or_many(spark, tmp_path):
    """A stream reads a folder of files and a lone file alike."""
    rows = spark.range(20)
    rows.repartition(4).write.parquet(str(tmp_path / "many.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    lone = next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "lone.parquet")
    for i, path in enumerate((tmp_path / "many.parquet", lone)):
        jobs.append_table(jobs.table_source(spark, str(path)), str(tmp_path / f"t{i}"), str(tmp_path / f"log{i}")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"t{i}")).count() == 20


def test_state_drops_repeats(spark, tmp_path):
    inbox = tmp_path / "in"
    rows = [{"id": "a", "ts": "2024-01-01T00:00:00"}, {"id": "a", "ts": "2024-01-01T00:01:00"}, {"id": "b", "ts": "2024-01-01T00:02:00"}]
    drop(inbox, "1.json", rows)
    stream = jobs.first_per_key(source(spark, inbox, "id STRING, ts TIMESTAMP_NTZ"), ["id"], "ts", "1 hour")
    jobs.append_table(stream, str(tmp_path / "t"), str(tmp_path / "log")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["a", "b"]


def test_fan_out_keeps_topics_whole(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "1.json", [{"value": "x"}, {"value": "y"}])
    stream = jobs.fan_out(source(spark, inbox, "value STRING"), ["archive", "data"])
    jobs.append_table(stream, str(tmp_path / "t"), str(tmp_path / "log"), ["topic"], fmt="json").awaitTermination()
    got = sorted((r["topic"], r["value"]) for r in spark.read.json(str(tmp_path / "t")).collect())
    assert got == [("archive", "x"), ("archive", "y"), ("data", "x"), ("data", "y")]


def test_malformed_messages_become_null_rows(spark):
    messages = spark.createDataFrame([('{"id":"1","name":"n","chains":{"victory":{"002":"5"}},"stores_count":1}',), ("oops",), (None,)], "value STRING")
    got = jobs.parse_messages(messages, schemas.PRODUCT_MESSAGE).collect()
    assert [r["id"] for r in got] == ["1", None, None]
    assert got[0]["chains"] == {"victory": {"002": "5"}}


def test_product_stream_equals_batch(spark, tmp_path):
    nested = spark.createDataFrame(
        [("1", "milk", {"victory": {"002": "5.00"}}, "2023-01-01", 1, 1), ("2", "tea", {"shufersal": {"001": "3.00"}}, "2023-01-01", 1, 1)],
        schemas.PRODUCT_MESSAGE,
    )
    batch = consolidate.flatten_prices(nested)
    inbox = tmp_path / "in"
    drop(inbox, "1.json", [{"value": line} for line in nested.toJSON().collect()])
    stream = consolidate.flatten_prices(jobs.parse_messages(source(spark, inbox, "value STRING"), schemas.PRODUCT_MESSAGE))
    jobs.append_table(stream, str(tmp_path / "t"), str(tmp_path / "log")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect())) == sorted(map(tuple, batch.collect()))


def test_enriched_stream_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    rows = [{"tweet_id": str(i), "text": t} for i, t in enumerate(["best day", "worst  day", "", "plain"])]
    drop(inbox, "1.json", rows)
    schema = "tweet_id STRING, text STRING"
    jobs.append_table(posts.enrich_posts(source(spark, inbox, schema)), str(tmp_path / "t"), str(tmp_path / "log")).awaitTermination()
    keep = ["tweet_id", "wordCount", "sentiment"]
    batch = posts.enrich_posts(spark.createDataFrame([(r["tweet_id"], r["text"]) for r in rows], schema)).select(*keep)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).select(*keep).collect())) == sorted(map(tuple, batch.collect()))


def test_work_folders_lie_in_the_named_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert new_dir(spark, "x").startswith(named + "/x-")
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_a_work_area_leaves_nothing(spark):
    with work_area(spark):
        kept = stage(spark.range(3), "numbers")
        path = kept.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
    outside = new_dir(spark, "kept")
    spark.range(1).write.parquet(outside)
    assert spark.read.parquet(outside).count() == 1
