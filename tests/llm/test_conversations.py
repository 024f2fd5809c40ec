"""Repairs against plain dynamic programming over whole audits, and against rules read off the task."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebasket.llm import conversations
from pricebasket.llm.queries import QUERIES

BLANK = " \t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """(cost, audit, repaired rows) by trying every edit at every row and state; whole audits are compared."""
    best = {"": (0, "", [])}  # by role initials so far: only the last one and whether any matter
    patterns = {"": "su", "s": "u", "u": "a", "a": "u"}

    def better(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, done) in list(table.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if letter in patterns[state]:
                        better(table, letter, (cost + 5, audit + "I", done + [(role, "")]))
        return table

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, done) in with_inserts(dict(best)).items():
            better(after, state, (cost + 2, audit + "D", done))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in patterns[state]:
                    better(after, role[:1], (cost + more, audit + "K", done + [(role, text)]))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if letter in patterns[state]:
                        better(after, letter, (cost + 1 + more, audit + "R", done + [(name, text)]))
        best = after
    with_inserts(best)
    return min(best[state] for state in ("", "a") if state in best)


def damage(conv, turn, role, text):
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    role, text = " " if role is None else role, " " if text is None else text
    case = zlib.crc32(key.encode()) % 20
    if case == 0:
        return []
    text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
    return [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def expected(table):
    found = {}
    for conv, rows in itertools.groupby(sorted(table, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        after = [row for r in rows for row in damage(*r)]
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faulty = set(), []
        for _, role, text in after:
            bare = text.rstrip(BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [turn for turn, _, _ in after if turn is not None]
        faults = [fault for _, _, fault in faulty]
        cost, audit, done = plain_repair(faulty)
        initials = [role[:1] for _, role, _ in after]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in done).encode()).hexdigest())
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in done))
    return found


def as_dict(df):
    rows = [tuple(row) for row in df.collect()]
    assert len({row[0] for row in rows}) == len(rows)
    return {row[0]: row[1:] for row in rows}


def test_audits_against_plain_search():
    draw = random.Random(3)
    faults = {"": 0, "blank": 1, "duplicate": 1, "truncated": 2}
    for _ in range(4000):
        rows = [(draw.choice(["system", "user", "assistant", "tool"]), "x", draw.choice(["", "", "blank", "truncated", "duplicate"]))
                for _ in range(draw.randrange(14))]
        kinds = bytes(3 * "suat".index(role[0]) + faults[fault] for role, _, fault in rows)
        cost, audit, _ = plain_repair(rows)
        assert conversations.audit(kinds)[:2] == (cost, audit), rows


def test_long_conversations_are_halved():
    draw = random.Random(4)
    faults = {"": 0, "blank": 1, "truncated": 2}
    for size in (25, 60, 333):
        for _ in range(20):
            rows = [(draw.choice(["system", "user", "assistant", "tool"]), "x", draw.choice(["", "", "", "blank", "truncated"])) for _ in range(size)]
            kinds = bytes(3 * "suat".index(role[0]) + faults[fault] for role, _, fault in rows)
            assert conversations.audit(kinds)[:2] == plain_repair(rows)[:2]


def test_query_over_the_whole_table(spark, sf_dir):
    table = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, sf_dir)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert as_dict(got) == expected(table)


def rows_of_all_kinds():
    draw = random.Random(8)
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(draw.randrange(1, 12)):
            rows.append((conv, draw.choice([None, 0, 1, 2, 3, 4, 9]), draw.choice([None, "", "user", "assistant", "system", "tool", "übel", " "]),
                         draw.choice([None, "", " \n", "Yes.", "Yes. ", "no", "Wahr!\n", " ", "é?", "a" * 3000])))
    return rows


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = rows_of_all_kinds()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit("clash") for name in ("copies", "part", "plan", "audit", "text_key", "first", "last", "case", "_conv")})
    assert as_dict(conversations.repair(conversations.damaged(df))) == expected(rows)
    assert conversations.repair(conversations.damaged(df.limit(0))).collect() == []


def test_a_conversation_over_many_tasks(spark):
    """One conversation with most rows, one of its rows repeated very often."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i % 700}.") for i in range(3000)]
    rows += [(1, 5000, "user", "again and again.")] * 2000 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert as_dict(conversations.repair(conversations.damaged(df))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "cut"), (1, 2, "assistant", "Good."), (2, 0, "assistant", "Well."), (3, 0, "user", "")]
    given = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit(1).cast("long"))
    got = sorted(tuple(row) for row in conversations.repaired(given).collect())
    assert got == [(1, 0, 0, "user", "Hello."), (1, 1, 2, "assistant", "Good.")]
    assert isinstance(conversations.repaired(given).schema["conv_id"].dataType, T.LongType)
