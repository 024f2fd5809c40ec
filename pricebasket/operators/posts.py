"""Post messages: flatten, filter, enrich. Projections only, equal in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket import constants, schemas
from pricebasket.functions import text

USER_COLUMNS = [
    "name", "location", "url", "protected", "verified", "followers_count", "friends_count",
    "listed_count", "favourites_count", "statuses_count", "withheld_in_countries",
]


def flatten_posts(raw: DataFrame) -> DataFrame:
    """JSON posts in ``value`` to flat rows: the user's kept fields beside the post's own."""
    post = raw.select(F.from_json("value", schemas.RAW_POST).alias("post"))
    return post.select(
        *[F.col(f"post.user.{name}").alias(name) for name in USER_COLUMNS],
        F.col("post.user.created_at").alias("user_acount_created_at"),
        F.col("post.user.id").alias("user_id"),
        F.col("post.text").alias("text"),
        F.col("post.created_at").alias("tweet_created_at"),
        F.col("post.id").alias("tweet_id"),
    )


def filter_posts(posts: DataFrame, keywords: list[str], languages: list[str]) -> DataFrame:
    return posts.filter(F.col("lang").isin(languages) & text.mentions(F.col("text"), keywords))


def enrich_posts(posts: DataFrame, at: Column | None = None, lexicon: dict[str, float] | None = None) -> DataFrame:
    """Add current_ts, hour, minute, wordCount and sentiment."""
    instant = F.current_timestamp() if at is None else at
    return (
        posts.withColumn("current_ts", instant)
        .withColumn("hour", F.hour("current_ts"))
        .withColumn("minute", F.minute("current_ts"))
        .withColumn("wordCount", text.word_count(F.col("text")))
        .withColumn("sentiment", text.polarity(F.col("text"), lexicon or constants.LEXICON))
    )
