"""Streams that keep state: the step of each chat, and running counts of requested products."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricebasket.operators import chat, popularity

STEP = "at LONG, kind STRING, state STRING, step STRING, next_state STRING, place STRING"
#: Batches after which the counts written so far are folded into one.
FOLD = 50


def _walk(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One chat's messages of a micro-batch, in order, from the state that the last one left."""
    digit, place = state.get if state.exists else ("0", None)
    rows = pd.concat(list(batches)).sort_values("at", kind="stable")
    made = []
    for at, kind, text in zip(rows["at"], rows["kind"], rows["text"]):
        follows = chat.MAPS[kind][int(digit)]
        steps = chat.STEPS[chat.STATES[int(digit)]]
        taken = steps.get(kind, steps[""])
        if taken == "ask_list":
            place = text if isinstance(text, str) else ""
        made.append((key[0], at, kind, chat.STATES[int(digit)], taken, chat.STATES[int(follows)], place))
        digit = follows
    state.update((digit, place))
    yield pd.DataFrame(made, columns=["chat_id", "at", "kind", "state", "step", "next_state", "place"])


def chat_steps_stream(messages: DataFrame) -> DataFrame:
    """The rows of ``chat.chat_steps`` (but the day) for a stream of messages: chat_id, at (a number), text.

    A chat's state (the step expected and the place) outlives batches and restarts; messages of one
    batch are walked through by ``at``, those of a later batch count as later. Only a batch's own messages of a chat are held.
    """
    known = messages.select("chat_id", "at", "text", chat.message_kind(F.col("text")).alias("kind"))
    kind = known.schema["chat_id"].dataType.simpleString()
    return known.groupBy("chat_id").applyInPandasWithState(
        _walk, f"chat_id {kind}, {STEP}", "state STRING, place STRING", "append", GroupStateTimeout.NoTimeout)


# ---- running counts -----------------------------------------------------------------------


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/fold={batch_id // FOLD}/batch={batch_id}"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


COUNT = "name STRING, count LONG"


def _counts(spark: SparkSession, path: str, fold: int) -> DataFrame:
    if not _exists(spark, f"{path}/fold={fold}"):
        return spark.createDataFrame([], COUNT)
    # Counts only grow, so of several a name's largest is its last.
    return spark.read.schema(COUNT).parquet(f"{path}/fold={fold}").groupBy("name").agg(F.max("count").alias("count"))


def upsert_counts(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write the counts that a batch changed. The same batch again replaces its own folder and adds nothing.

    The first batch of each ``FOLD`` carries all names' counts on, so a reader opens at most that many batches.
    """
    spark, changed = batch.sparkSession, batch.select("name", "count")
    if batch_id and batch_id % FOLD == 0:
        changed = _counts(spark, path, batch_id // FOLD - 1).unionByName(changed).groupBy("name").agg(F.max("count").alias("count"))
    changed.write.mode("overwrite").parquet(_folder(path, batch_id))


def count_requests(requests: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the number of request lines per product up to date at ``path`` until the source is used up.

    Counts are state of the stream; a batch writes those of its own products only.
    """
    counted = popularity.request_lines(requests).groupBy("name").agg(F.count(F.lit(1)).alias("count"))
    return (
        counted.writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: upsert_counts(batch, batch_id, path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    """Every product's number of request lines as of the last whole batch."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folds = sorted((int(entry.getPath().getName()[len("fold="):]) for entry in system.listStatus(place)), reverse=True) if system.exists(place) else []
    for fold in folds:
        # A fold counts from its first batch on, when that is whole.
        if fold == 0 or _exists(spark, f"{_folder(path, fold * FOLD)}/_SUCCESS"):
            return _counts(spark, path, fold)
    return spark.createDataFrame([], COUNT)
