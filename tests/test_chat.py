"""Steps of chats: the batch form and the stream against a plain walk; running counts against the batch count."""

import datetime
import json
import random

from pricebasket.operators import chat, popularity
from pricebasket.streaming import jobs, stateful

TEXTS = ["/start", "start", "היי", "top5", "TOP5", "milk 2", "milk 2, tea 1.5", "milk", "milk 2,", "", None, "Main street 5 x"]
MESSAGE = "chat_id STRING, day DATE, at LONG, text STRING"
DAY = datetime.date(2024, 1, 1)


def plain_walk(messages):
    """chat_id, at, state, step, next_state, place by the rules of the dialogue, one message at a time."""
    found = []
    for chat_id in {m[0] for m in messages}:
        state, place = "idle", None
        for _, _, at, text in sorted((m for m in messages if m[0] == chat_id), key=lambda m: m[2]):
            before = state
            if state == "idle":
                step, state = ("welcome", "choose") if text in ("/start", "start", "היי") else ("ignored", "idle")
            elif state == "choose":
                step, state = ("top_products", "idle") if text and text.lower() == "top5" else ("ask_place", "place")
            elif state == "place":
                step, state, place = "ask_list", "list", text or ""
            elif state == "again":
                step, state = "ignored", "idle"
            elif text == "היי":
                step, state = "ask_again", "again"
            else:
                sound = text in ("milk 2", "milk 2, tea 1.5", "Main street 5")
                step, state = ("answer", "list") if sound else ("bad_input", "idle")
            found.append((chat_id, at, before, step, state, place))
    return sorted(found, key=str)


def random_messages(seed, chats=30, most=40):
    draw = random.Random(seed)
    found = []
    for c in range(chats):
        at = 0
        for _ in range(draw.randrange(1, most)):
            at += draw.randrange(1, 30)
            found.append((f"chat {c}", DAY + datetime.timedelta(days=at // 100), at, draw.choice(TEXTS)))
    return found


def rows(df):
    return sorted((tuple(r) for r in df.select("chat_id", "at", "state", "step", "next_state", "place").collect()), key=str)


def test_windows_equal_a_walk(spark):
    messages = random_messages(1)
    assert rows(chat.chat_steps(spark.createDataFrame(messages, MESSAGE).repartition(5))) == plain_walk(messages)
    assert chat.chat_steps(spark.createDataFrame([], MESSAGE)).collect() == []


def test_a_hot_chat_is_dealt_by_day(spark):
    """One chat with most messages: its days are scanned apart, and only one row a day goes on."""
    draw = random.Random(2)
    messages = [("hot", DAY + datetime.timedelta(days=i // 50), i, draw.choice(TEXTS)) for i in range(3000)] + random_messages(3, 5)
    got = chat.chat_steps(spark.createDataFrame(messages, MESSAGE))
    assert rows(got) == plain_walk(messages)


def test_maps_say_what_steps_do():
    for kind, follows in chat.MAPS.items():
        assert len(follows) == len(chat.STATES)
        for i, state in enumerate(chat.STATES):
            taken = chat.STEPS[state].get(kind, chat.STEPS[state][""])
            after = {"welcome": "choose", "ask_place": "place", "ask_list": "list", "answer": "list", "ask_again": "again"}.get(taken, "idle")
            assert chat.STATES[int(follows[i])] == after


def drop(path, name, entries):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(entry) for entry in entries))


def test_the_stream_equals_the_batch_across_restarts(spark, tmp_path):
    messages = random_messages(4, chats=12)
    inbox, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    for part in range(3):
        # Several files a run, one per batch, and a restart after each run.
        for half in range(2):
            low = part * 400 + half * 200
            drop(inbox, f"{part}{half}.json", [
                {"chat_id": c, "at": at, "text": text} for c, _, at, text in messages if low <= at < low + 200])
            source = spark.readStream.schema("chat_id STRING, at LONG, text STRING").option("maxFilesPerTrigger", 1).json(str(inbox))
            jobs.append_table(stateful.chat_steps_stream(source), out, log).awaitTermination()
    read = [m for m in messages if m[2] < 1200]
    assert len(read) > 100
    got = spark.read.parquet(out)
    assert rows(got) == plain_walk(read) == rows(chat.chat_steps(spark.createDataFrame(read, MESSAGE)))


REQUEST = "product_list STRING"


def request(*names):
    return {"product_list": json.dumps([{"name": name, "product_quantity": "1"} for name in names])}


def test_running_counts_equal_the_batch_after_each_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "FOLD", 2)
    draw, inbox = random.Random(6), tmp_path / "in"
    path, log = str(tmp_path / "counts"), str(tmp_path / "log")
    assert stateful.running_counts(spark, path).collect() == []
    for part in range(5):
        drop(inbox, f"{part}.json", [request(*draw.choices("abcdefgh", k=draw.randrange(4))) for _ in range(30)] + [{"product_list": "oops"}])
        stateful.count_requests(spark.readStream.schema(REQUEST).json(str(inbox)), path, log).awaitTermination()
        batch = spark.read.schema(REQUEST).json(str(inbox))
        assert popularity.top_counts(stateful.running_counts(spark, path)).collect() == popularity.top_products(batch).collect()
    counts = sorted(map(tuple, stateful.running_counts(spark, path).collect()))
    # The last batch again, as after a failure: it replaces itself.
    last = spark.createDataFrame(counts, "name STRING, count LONG")
    for _ in range(2):
        stateful.upsert_counts(last, 4, path)
    assert sorted(map(tuple, stateful.running_counts(spark, path).collect())) == counts
    # A fold whose first batch is not whole is not read.
    (tmp_path / "counts" / "fold=3" / "batch=6").mkdir(parents=True)
    assert sorted(map(tuple, stateful.running_counts(spark, path).collect())) == counts
