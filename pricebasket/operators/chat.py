"""What each chat message is an answer to: the next-step routing, for whole tables of messages at once.

A chat is a walk through five states. A message's kind maps each state to the next, so a message is a
map of states, written as five digits, and messages one after the other are their maps composed:
``translate(first, '01234', second)``. The state before every message is a running composition, found with
``lag`` windows of doubling reach over one sorted order: first within each block of a chat (its days),
then over the blocks, so that a chat with a large share of all messages is not one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket import constants
from pricebasket.functions import text as texts
from pricebasket.session import stage

#: States: nothing expected, a choice, a place, a shopping list, whether to go on.
STATES = ("idle", "choose", "place", "list", "again")
#: For each kind of message, the state that follows each state.
MAPS = {"again": "12340", "start": "12300", "top_products": "00300", "list": "02330", "other": "02300"}
SAME = "01234"
#: What a message in each state leads to; where the kind matters, by kind.
STEPS = {
    "idle": {"again": "welcome", "start": "welcome", "": "ignored"},
    "choose": {"top_products": "top_products", "": "ask_place"},
    "place": {"": "ask_list"},
    "list": {"again": "ask_again", "list": "answer", "": "bad_input"},
    "again": {"": "ignored"},
}


def message_kind(text: Column, start_words: tuple[str, ...] = constants.START_WORDS) -> Column:
    """again (the word that also ends a list), start, top_products, list (every part names a product and a quantity) or other."""
    sound = F.forall(texts.cart_lines(text), lambda line: (line["product_name"] != "") & line["quantity"].isNotNull())
    return (
        F.when(text == start_words[-1], "again")
        .when(text.isin(list(start_words)), "start")
        .when(F.lower(text) == "top5", "top_products")
        .when(sound, "list")
        .otherwise("other")
    )


def _by_kind(values: dict[str, str], kind: Column) -> Column:
    found = F.lit(values[""]) if "" in values else F.lit(None).cast("string")
    for name, value in values.items():
        if name:
            found = F.when(kind == name, F.lit(value)).otherwise(found)
    return found


def step(state: Column, kind: Column) -> Column:
    """What follows from a message of ``kind`` in ``state``, a digit."""
    found = F.lit(None).cast("string")
    for i, name in enumerate(STATES):
        found = F.when(state == str(i), _by_kind(STEPS[name], kind)).otherwise(found)
    return found


def named(state: Column) -> Column:
    return F.get(F.array(*map(F.lit, STATES)), state.cast("int"))


def _running(rows: DataFrame, line, column: str, longest: int) -> DataFrame:
    """``column`` composed from the start of each line up to each row, in as many windows as ``longest`` has bits."""
    reach = 1
    while reach < longest:
        before = F.lag(column, reach, SAME).over(line)
        rows = rows.withColumn("_before", before).withColumn(column, F.call_function("translate", F.col("_before"), F.lit(SAME), F.col(column))).drop("_before")
        reach *= 2
    return rows


def _longest(rows: DataFrame, *keys: str) -> int:
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.max("rows")).first()[0] or 0


def chat_steps(messages: DataFrame) -> DataFrame:
    """Each message with the ``state`` it meets, the ``step`` it leads to, the ``next_state`` and the chat's ``place``.

    ``messages``: chat_id, day, at (orders the messages of a chat, days included; no two alike) and text. ``place`` is the text
    last given as one in the chat so far, null before the first. A null text is of no special kind.
    """
    known = messages.select("chat_id", "day", "at", "text", message_kind(F.col("text")).alias("kind"))
    line = Window.partitionBy("chat_id", "day").orderBy("at")
    mapped = known.withColumn("map", _by_kind({**MAPS, "": MAPS["other"]}, F.col("kind")))
    run = _running(mapped, line, "map", _longest(messages, "chat_id", "day"))
    within = stage(run.withColumn("before", F.lag("map", 1, SAME).over(line)), "chat-blocks")

    blocks = within.groupBy("chat_id", "day").agg(F.max_by("map", "at").alias("map"))
    days = Window.partitionBy("chat_id").orderBy("day")
    opened = _running(blocks, days, "map", _longest(blocks, "chat_id"))
    opened = opened.select("chat_id", "day", F.substring(F.lag("map", 1, SAME).over(days), 1, 1).alias("opens"))
    state = F.expr("substring(before, int(opens) + 1, 1)")
    stepped = _with_block(within, opened).withColumn("state", state)
    follows = F.call_function("translate", F.col("state"), F.lit(SAME), _by_kind({**MAPS, "": MAPS["other"]}, F.col("kind")))
    stepped = stepped.withColumn("step", step(F.col("state"), F.col("kind"))).withColumn("next_state", named(follows))

    # The place: the last one of the block so far, or of the blocks before.
    given = F.when(F.col("step") == "ask_list", F.coalesce("text", F.lit("")))
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = stage(stepped.withColumn("given", given).withColumn("here", F.last("given", ignorenulls=True).over(so_far)), "chat-places")
    last = placed.groupBy("chat_id", "day").agg(F.max_by("here", "at").alias("here"))
    earlier = F.last("here", ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1))
    carried = last.select("chat_id", "day", earlier.alias("carried"))
    return _with_block(placed.drop("opens"), carried).select(
        "chat_id", "day", "at", "kind", named(F.col("state")).alias("state"), "step", "next_state", F.coalesce("here", "carried").alias("place"))


def _with_block(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    known = blocks.withColumnsRenamed({"chat_id": "_chat", "day": "_day"})
    return rows.join(known, F.col("chat_id").eqNullSafe(F.col("_chat")) & F.col("day").eqNullSafe(F.col("_day"))).drop("_chat", "_day")
