"""What is dealt out and written stays narrow: numbers for texts, one ``seq`` a partial, no step dealt twice."""

from pricebasket.operators import history
from pricebasket.plans.queries import QUERIES
from pricebasket.session import is_small, stage
from pricebasket.sources import catalog_store, tables
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan(df).split("\n") if "Exchange hashpartitioning" in line]


def test_extending_intervals_deals_stored_ones_once(spark):
    kinds = "name STRING, chain STRING, store_id STRING, price DECIMAL(12,2)"
    stored = spark.createDataFrame([], kinds + ", valid_from DATE, last_seen DATE, valid_to DATE, days LONG")
    assert len(exchanges(history.extend_intervals(stored, spark.createDataFrame([], kinds + ", pulling_date DATE")))) == 1


def test_days_asked_for_are_dealt_by_line_once(spark):
    keys = "name LONG, chain INT, store_id LONG"
    daily = spark.createDataFrame([(1, 0, 2, 3)], keys + ", price INT").withColumn("pulling_date", F.lit("2024-01-01").cast("date"))
    asked = daily.select("name", "chain", "store_id", F.col("pulling_date").alias("day"))
    answers = history.price_as_of(asked, history.price_intervals(daily))
    # Starts, asked days, and the join that brings the answers back.
    assert len(exchanges(answers)) <= 4
    assert [tuple(r)[4] for r in answers.collect()] == [3]


def test_price_as_of_deals_lines_once_and_joins_requests_once(spark, sf_dir):
    """Numbered lines keep their place from the folded days to the answers; the plan reads stored requests, not order lines twice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbers = tables.numbers(spark, sf_dir)
        daily = history.daily_prices(tables.numbered_obs(spark, sf_dir, numbers))
        asked = stage(tables.price_requests(spark, sf_dir, numbers), "asked")
        answers = history.price_as_of(asked, history.price_intervals(daily, stale_after=365))
        # The days with prices, and the days asked for; none of them again once they lie together.
        assert len([line for line in exchanges(answers) if "hashpartitioning(name#" in line]) == 2
        text = plan(QUERIES["price_as_of"](spark, sf_dir))
        assert "l_partkey" in text and "o_orderkey" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_shuffles_numbers_not_names(spark, sf_dir):
    numbers = tables.numbers(spark, sf_dir)
    obs = tables.numbered_obs(spark, sf_dir, numbers)
    assert dict(obs.dtypes)["item_name"] == dict(obs.dtypes)["store_id"] == "bigint"
    assert "xxhash64" not in plan(history.daily_prices(obs))
    texts = tables.price_obs(spark, sf_dir)
    named = numbers.named(history.daily_prices(obs))
    want = history.daily_prices(texts).select(*named.columns)
    assert named.exceptAll(want).isEmpty() and want.exceptAll(named).isEmpty()


def test_partials_hold_one_seq_and_first_sightings_merge(spark, tmp_path):
    kinds = "chain STRING, chain_rank INT, store_id STRING, item_code STRING, item_name STRING, price DECIMAL(12,2), seq STRUCT<at: INT>"

    def obs(*rows):
        return spark.createDataFrame([("victory", rank, store, code, name, price, (at,)) for rank, store, code, name, price, at in rows], kinds)

    from decimal import Decimal
    one, two = Decimal(1), Decimal(2)
    catalog_store.add_observations(spark, str(tmp_path / "c"), "narrow_catalogue", obs((0, "1", "B", "milk", one, 5), (0, "1", "N", None, one, 9)), buckets=4)
    late = catalog_store.add_observations(spark, str(tmp_path / "c"), "narrow_catalogue", obs((0, "1", "A", "milk", two, 3), (0, "2", "Z", None, two, 10)))
    spark.sql("DROP TABLE narrow_catalogue")
    assert late.kinds["partials"].names == ["name", "chain", "store_id", "price", "last_seq"]
    got = {(r["id"], r["name"], r["store_id"]): int(r["price"]) for r in late.catalog().collect()}
    # An earlier sighting that comes later gives the id; the last price stays.
    assert got == {("A", "milk", "1"): 1, ("N", None, "1"): 1, ("N", None, "2"): 2}


def test_is_small_goes_by_rows_and_bytes(spark):
    rows = stage(spark.range(100), "hundred")
    assert is_small(rows) and not is_small(rows, max_rows=99) and not is_small(rows, max_bytes=10)


def test_catalogue_query_reads_what_it_wrote(spark, sf_dir):
    assert QUERIES["catalog_increment"](spark, sf_dir).count() > 0
