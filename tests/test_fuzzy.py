"""Pairs within a few edits against all pairs, and addresses resolved by their nearest spelling."""

import random

import pytest
from pricebasket.operators import fuzzy, stores

ADDRESS = "id INT, address STRING, city STRING"
KNOWN = "full_address STRING, latitude DOUBLE, longitude DOUBLE"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t STRING")


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_all_pairs(spark, most):
    draw = random.Random(most)
    words = ["".join(draw.choices("abcé", k=draw.randrange(0, 13))) for _ in range(150)]
    other = []
    for word in words:
        changed = list(word)
        for _ in range(draw.randrange(4)):
            place = draw.randrange(len(changed) + 1)
            draw.choice([lambda: changed.insert(place, "x"), lambda: changed[place:place + 1] and changed.pop(place), lambda: changed.__setitem__(slice(place, place + 1), "b")])()
        other.append("".join(changed))
    asked, known = [*words, None, "", "a" * 3000], [*other, None, "a" * 2999 + "b"]
    got = sorted(tuple(r) for r in fuzzy.similar_pairs(texts(spark, asked), texts(spark, known), most).collect())
    want = {(a, b, edits(a, b)) for a in set(words + [""]) for b in set(other) if abs(len(a) - len(b)) <= most and edits(a, b) <= most}
    want |= {("a" * 3000, "a" * 2999 + "b", 1)} if most else set()
    assert got == sorted(want)


def test_a_gram_in_every_text_joins_nothing(spark):
    """All addresses end alike: their common grams come last and decide no pair."""
    known = [f"street{i:04d} square, jerusalem" for i in range(0, 1500, 3)]
    asked = [f"street{i:04d} squre, jerusalem" for i in range(0, 1500, 3)]
    plan_rows = fuzzy.similar_pairs(texts(spark, asked), texts(spark, known), 1)
    assert plan_rows.count() == 500
    text = plan_rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_addresses(spark):
    rows = spark.createDataFrame([
        (1, "Main  st 1", "Haifa"), (2, "Man st 1", "haifa"), (3, "Main st 2", "Haifa"), (4, "Mainn stt 1", "Haifa"), (5, "other", "Lod"),
        (6, None, None), (7, "Man st 1", "haifa"), (8, "Mayn st 1", "haifa")], ADDRESS)
    known = spark.createDataFrame([("main st 1, haifa", 1.0, 2.0), ("main st 1, haifa", 0.5, 9.0), ("mayn st 1, haifo", 3.0, 4.0)], KNOWN)
    got = {r["id"]: (r["matched_address"], r["edits"], r["latitude"]) for r in stores.geocode_fuzzy(rows, known).collect()}
    assert got == {
        1: ("main st 1, haifa", 0, 0.5), 2: ("main st 1, haifa", 1, 0.5), 3: (None, None, None), 4: ("main st 1, haifa", 2, 0.5),
        5: (None, None, None), 6: (None, None, None), 7: ("main st 1, haifa", 1, 0.5), 8: ("main st 1, haifa", 1, 0.5)}
