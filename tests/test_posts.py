"""Columns over post texts, requests and chat messages."""

import datetime
import json

import pytest
from pricebasket import constants
from pricebasket.functions import space_time, text
from pricebasket.operators import popularity, posts
from pyspark.sql import functions as F


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v STRING").select(column).first()[0]


@pytest.mark.parametrize("value, want", [("a b", 2), ("a  b", 3), ("", 1), (None, None)])
def test_word_count(spark, value, want):
    assert one(spark, value, text.word_count(F.col("v"))) == want


@pytest.mark.parametrize(
    "value, want", [("The BEST, truly the best!", 1.0), ("best worst", 0.0), ("nothing here", 0.0), ("good bad good", (0.7 + 0.7 - 0.7) / 3), (None, None)]
)
def test_polarity(spark, value, want):
    got = one(spark, value, text.polarity(F.col("v"), constants.LEXICON))
    assert got == (None if want is None else pytest.approx(want))


@pytest.mark.parametrize("value, want", [("so best.", True), ("bestow", False), ("BEST", True)])
def test_keywords_match_whole_words(spark, value, want):
    assert one(spark, value, text.mentions(F.col("v"), ["best"])) is want


@pytest.mark.parametrize("value, want", [("/start", "start"), ("היי", "start"), ("ToP5", "top_products"), ("top 5", "cart")])
def test_intent(spark, value, want):
    assert one(spark, value, text.message_intent(F.col("v"), constants.START_WORDS)) == want


def test_local_date_crosses_midnight(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 22:30:00' AS t")
    assert df.select(space_time.local_date(F.col("t"), constants.LOCAL_ZONE)).first()[0] == datetime.date(2024, 7, 2)


def test_posts_flatten(spark):
    raw = {
        "created_at": "now", "id": 7, "text": "hi", "lang": "en", "unused": 1,
        "user": {"id": 9, "name": "n", "created_at": "then", "location": None, "followers_count": 5, "other": 1},
    }
    row = posts.flatten_posts(spark.createDataFrame([(json.dumps(raw),)], "value STRING")).first().asDict()
    assert (row["tweet_id"], row["user_id"], row["text"], row["tweet_created_at"], row["user_acount_created_at"]) == ("7", "9", "hi", "now", "then")
    assert (row["followers_count"], row["location"]) == (5, None)


def test_enriched_columns(spark):
    df = spark.createDataFrame([("1", "best  day")], "tweet_id STRING, text STRING")
    at = F.lit("2024-01-01 10:20:30").cast("timestamp")
    row = posts.enrich_posts(df, at).first()
    assert (row["hour"], row["minute"], row["wordCount"], row["sentiment"]) == (10, 20, 3, 1.0)


def test_top_products_count_lines_and_skip_bad_lists(spark):
    lists = [
        '[{"name":"milk","product_quantity":"9"},{"name":"tea","product_quantity":1}]',
        '[{"name":"milk","product_quantity":"1"}]', '[{"name":"corn","product_quantity":"1"}]', "[]", "oops", None,
    ]
    requests = spark.createDataFrame([(x,) for x in lists], "product_list STRING")
    assert [(r["name"], r["count"]) for r in popularity.top_products(requests, 2).collect()] == [("milk", 2), ("corn", 1)]
