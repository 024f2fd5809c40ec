"""A key that holds a third of all rows is split by the joins that meet it raw."""

from pricebasket.operators import stores
from pyspark.sql import functions as F


def test_hot_store_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        n = F.col("id")
        obs = spark.range(0, 120_000, 1, 8).select(
            F.lit("victory").alias("chain"),
            F.when(n % 3 == 0, "0").otherwise((n % 300).cast("string")).alias("store_id"),
            F.concat(F.lit("item "), n).alias("item_name"),
        )
        shops = spark.range(300).select(
            F.lit("victory").alias("chain"), F.col("id").cast("string").alias("store_id"), F.lit("x").alias("city")
        )
        joined = stores.join_stores(obs, shops).groupBy("city").agg(F.count("item_name").alias("n"), F.max("item_name"))
        assert joined.collect()[0]["n"] == 120_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
