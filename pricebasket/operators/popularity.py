"""Most requested products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket import constants, schemas


def request_lines(requests: DataFrame) -> DataFrame:
    """The lines of stored requests, ``product_list`` being a JSON array of name and quantity.

    A malformed or empty list gives no line.
    """
    return requests.select(
        F.explode(F.from_json("product_list", schemas.REQUEST_LINES)).alias("line")
    ).select("line.name", "line.product_quantity")


def top_products(requests: DataFrame, k: int = constants.TOP_PRODUCTS) -> DataFrame:
    """The k products on most request lines; lines count, not quantities. Ties by name."""
    return top_counts(request_lines(requests).groupBy("name").agg(F.count(F.lit(1)).alias("count")), k)


def top_counts(counts: DataFrame, k: int = constants.TOP_PRODUCTS) -> DataFrame:
    """The k products of the largest ``count``. Ties by name."""
    return counts.orderBy(F.desc("count"), "name").limit(k)
