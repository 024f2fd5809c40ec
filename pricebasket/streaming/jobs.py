"""Streaming jobs. Column logic is that of the batch operators; only sources and sinks differ."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pricebasket.operators.consolidate import dedup_first
from pricebasket.session import stage, work_area


def kafka_source(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", fail_on_data_loss: bool = True
) -> DataFrame:
    """Messages of a topic as ``value`` text. Needs the Kafka connector on the class path.

    Offsets that are gone end the job unless ``fail_on_data_loss`` is off.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"))
    )


def table_source(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream; new files are new rows."""
    # A plain path must be a folder for a stream; a pattern, which this makes of it, may match a lone file too.
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)


def parse_messages(messages: DataFrame, schema: str) -> DataFrame:
    """JSON texts in ``value`` as columns; a malformed text gives a row of nulls."""
    return messages.select(F.from_json("value", schema).alias("message")).select("message.*")


def append_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append the stream to Parquet (or JSON) files, exactly once, until the source is used up.

    ``available_now=False`` keeps it running.
    """
    writer = stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def append_batches(stream: DataFrame, made: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Append what ``made`` makes of each batch, for operators that no stream plan can hold, until the source is used up.

    Each batch has a folder of its own, which the same batch after a failure replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with work_area(batch.sparkSession):
            made(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fan_out(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Each message once per topic, in a ``topic`` column as a Kafka sink expects it.

    The source is read once and one checkpoint covers all topics, so no topic can run ahead.
    """
    return messages.withColumn("topic", F.explode(F.array(*[F.lit(topic) for topic in topics])))


#: Distinct keys of a batch that files are searched for one by one; a larger batch reads the key columns of all files.
LOOKED_UP = 4_000
#: Rows that a file of the table may hold.
FILE_ROWS = 500_000


def present_keys(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], hashes: Sequence[int] | None) -> DataFrame:
    """The table's keys that may be those of ``hashes`` (all, if None).

    Each file has a Bloom filter of its keys' hashes, which is tried against the list before any row
    is read: rows come only from files that hold one of the keys (or, one time in a million, seem to).
    """
    stored = spark.read.schema(schema).parquet(path)
    if hashes is not None:
        stored = stored.filter(f"key_hash IN ({', '.join(map(str, hashes)) or 'NULL'})")
    return stored.select(*(F.col(key).alias(f"present_{key}") for key in keys))


def insert_if_absent(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append rows whose key the table lacks; the first row of a key wins. Null is a key like any other.

    A batch of up to ``LOOKED_UP`` distinct keys reads only the files that hold some of them (see ``present_keys``), so
    what it reads does not grow with the table. New rows are sorted by the hash of their key and carry it
    in ``key_hash``. A batch that runs again after a failure finds its own rows there and adds nothing twice.
    """
    spark = batch.sparkSession
    with work_area(spark):
        first = stage(dedup_first(batch, keys, order).withColumn("key_hash", F.xxhash64(*keys)), "first-rows")
        # The table exists from the first batch on, typed, so that the join below always has one.
        spark.createDataFrame([], first.schema).coalesce(1).write.mode("ignore").parquet(path)
        rows = first.count()
        hashes = None if rows > LOOKED_UP else [row["key_hash"] for row in first.select("key_hash").collect()]
        same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"present_{key}")) for key in keys))
        fresh = first.join(present_keys(spark, path, first.schema, keys, hashes), same, "left_anti")
        if fresh.isEmpty():
            return
        files = -(-rows // FILE_ROWS)
        dealt = fresh.repartition(1) if files == 1 else fresh.repartitionByRange(files, "key_hash")
        bloom = {"enabled": "true", "fpp": "0.000001", "expected.ndv": str(min(rows, 2 * FILE_ROWS))}
        (
            dealt.sortWithinPartitions("key_hash").write.mode("append")
            .options(**{f"parquet.bloom.filter.{name}#key_hash": value for name, value in bloom.items()})
            .option("parquet.bloom.filter.max.bytes", str(8 << 20))
            .parquet(path)
        )


def insert_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Run ``insert_if_absent`` on every batch until the source is used up."""

    def write(batch: DataFrame, _: int) -> None:
        insert_if_absent(batch, path, keys, order)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_per_key(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival per key, with state instead of a table read.

    A batch costs in proportion to its own rows, not to the table; keys older than ``delay``
    behind the watermark leave the state, so a repeat later than that would pass again. Rows that
    arrive behind the watermark are dropped, a key's first one too: choose a ``delay`` beyond the
    latest arrival, or ``insert_stream``, which drops none.
    """
    return (
        stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark(list(keys))
    )

