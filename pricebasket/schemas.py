"""Schemas of the tables and messages the jobs exchange, as DDL texts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)
# A list's quantity: below 100 million, in millionths; other numbers are no valid quantity.
QUANTITY = T.DecimalType(14, 6)
ANY_NUMBER = T.DecimalType(38, 18)
TOTAL = T.DecimalType(38, 2)


STORES = (
    "store_id STRING, chain STRING, chain_id STRING, chain_name STRING, store_name STRING, "
    "address STRING, city STRING, pulling_date DATE, latitude DOUBLE, longitude DOUBLE"
)
# The published form of a catalogue row: prices nested by chain, then store.
PRODUCT_MESSAGE = (
    "id STRING, name STRING, chains MAP<STRING, MAP<STRING, STRING>>, "
    "pulling_date STRING, chains_count INT, stores_count INT"
)
STORE_MESSAGE = (
    "StoreName STRING, Address STRING, City STRING, store_id STRING, ChainId STRING, "
    "ChainName STRING, pulling_date STRING, Latitude DOUBLE, Longitude DOUBLE"
)
REQUEST_LINES = "ARRAY<STRUCT<name: STRING, product_quantity: STRING>>"
REQUEST_MESSAGE = (
    "product_list STRING, user_id STRING, chat_id STRING, user_first_name STRING, "
    "user_last_name STRING, user_user_name STRING, min_aff STRING, min_price STRING"
)
STORED_REQUEST = REQUEST_MESSAGE + ", current_ts STRING"
# A post as its producer sends it, and the flat record the stream jobs read.
RAW_POST = (
    "created_at STRING, id STRING, text STRING, "
    "user STRUCT<id: STRING, name: STRING, created_at: STRING, location: STRING, url: STRING, "
    "protected: BOOLEAN, verified: BOOLEAN, followers_count: INT, friends_count: INT, "
    "listed_count: INT, favourites_count: INT, statuses_count: INT, "
    "withheld_in_countries: ARRAY<STRING>>"
)
POST = (
    "tweet_created_at STRING, location STRING, url STRING, tweet_id STRING, text STRING, "
    "user_acount_created_at STRING, user_id STRING, name STRING, followers_count INT, "
    "friends_count INT, listed_count INT"
)
ENRICHED_POST = POST + ", current_ts TIMESTAMP, hour INT, minute INT, wordCount INT, sentiment DOUBLE"


def create_table_if_absent(spark: SparkSession, name: str, schema: str, path: str | None = None) -> bool:
    """Create an empty typed Parquet table unless one of that name exists; True if created."""
    if spark.catalog.tableExists(name):
        return False
    spark.catalog.createTable(name, path=path, source="parquet", schema=T.StructType.fromDDL(schema))
    return True
