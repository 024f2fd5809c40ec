"""Plans and hot keys: what must hold for the jobs to stay fast on large inputs."""

from decimal import Decimal

import pytest
from pricebasket import constants
from pricebasket.operators import basket, consolidate, history, popularity, search, stores
from pricebasket.plans.queries import QUERIES
from pricebasket.sources import tables
from pyspark.sql import functions as F

FAST = sorted(set(QUERIES) - {"xml_price_scan", "xml_store_scan", "daily_json_scan"})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FAST)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert operator not in text, operator


def test_scans_read_only_used_columns(spark, sf_dir):
    text = plan(popularity.top_products(tables.request_records(tables.table(spark, sf_dir, "lineitem"), spark, sf_dir)))
    lineitem = next(line for line in text.split("\n") if "FileScan" in line and "l_partkey" in line)
    assert "l_extendedprice" not in lineitem and "l_shipdate" not in lineitem
    assert "EqualTo(lang,en)" in plan(QUERIES["post_filter"](spark, sf_dir))


def test_top_k_and_per_group_limits(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_products"](spark, sf_dir))
    assert "WindowGroupLimit" in plan(QUERIES["nearest_stores"](spark, sf_dir))


def test_coverage_does_not_shuffle_after_the_fan_out(spark):
    offers = spark.createDataFrame([("p", 7, Decimal(3))], "name STRING, slot LONG, price DECIMAL(12,2)")
    carts = basket.cart_products(spark.createDataFrame([(1, "p", Decimal(1))], "cart_id INT, name STRING, quantity DECIMAL(14,6)"))
    covering = basket.common_words(carts, basket.product_words(offers))
    assert [tuple(row) for row in covering.collect()] == [(1, 0, 1 << 7)]
    shuffles = [line for line in plan(covering).split("\n") if "hashpartitioning" in line]
    assert any("hashpartitioning(cart_id" in line for line in shuffles)
    assert not any("word" in line for line in shuffles)


def test_baskets_are_priced_without_dealing_rows_by_store(spark, sf_dir):
    text = plan(QUERIES["basket_cost"](spark, sf_dir))
    assert not any("hashpartitioning" in line and "slot" in line for line in text.split("\n"))


N = 30_000


@pytest.fixture(scope="module")
def hot_obs(spark):
    """Observations of which a third is one product in one store, and a third shares one code."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(N).select(
        F.when(hot, "victory").otherwise(F.element_at(F.array(*[F.lit(c) for c in constants.CHAINS]), (n % 3 + 1).cast("int"))).alias("chain"),
        F.when(hot, 0).otherwise(n % 3).cast("int").alias("chain_rank"),
        F.when(hot, "002").otherwise((n % 40).cast("string")).alias("store_id"),
        F.when(n % 3 == 1, "C").otherwise((n % 1000).cast("string")).alias("item_code"),
        F.when(hot, "hot").otherwise(F.concat_ws("-", F.lit("p"), n % 3, n % 700)).alias("item_name"),
        (n % 97 + 1).cast("decimal(12,2)").alias("price"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 5).cast("int")).alias("pulling_date"),
        n.alias("seq"),
    )


def test_hot_product_shrinks_before_the_shuffle(hot_obs):
    """The step that meets raw rows combines on the map side, and its result is small per product."""
    reduced = consolidate.last_prices(hot_obs)
    assert "partial_max_by" in plan(reduced)
    assert reduced.filter("name = 'hot'").count() == 1


def test_hot_code_keeps_one_winner_per_chain(hot_obs):
    consolidated = consolidate.consolidate(hot_obs)
    assert consolidated.products.filter("id = 'C'").count() == 700
    merged = consolidate.merge_by_id(consolidated.products)
    assert "Window" not in plan(merged)
    code = merged.filter("id = 'C'").agg(F.count_distinct("name"), F.count(F.lit(1)), F.max("chains_count")).first()
    assert tuple(code) == (1, 1, 1)
    assert "partial_max_by" in plan(merged)


def test_hot_history_has_one_row_per_day(hot_obs):
    daily = history.daily_prices(hot_obs)
    assert daily.filter("name = 'hot'").count() == 5
    change = history.price_change(daily).filter("name = 'hot'").orderBy("pulling_date").collect()
    assert change[0]["previous_price"] is None
    assert all(b["previous_price"] == a["price"] for a, b in zip(change, change[1:]))


def test_hot_cart_and_hot_product_are_whole(spark):
    """One cart with a third of all lines and one product on a third of them."""
    lines = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("cart_id"),
        F.when(F.col("id") % 3 == 1, "p0").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("name"),
        F.lit(1).cast("decimal(12,3)").alias("quantity"),
    )
    prices = spark.range(50 * 90).select(
        F.lit("1").alias("id"),
        F.concat(F.lit("p"), F.col("id") % 50).alias("name"), F.lit("victory").alias("chain"),
        F.floor(F.col("id") / 50).cast("string").alias("store_id"),
        F.lit(2).cast("decimal(12,2)").alias("price"), F.lit(1).alias("chains_count"), F.lit(90).alias("stores_count"),
    )
    carts = basket.cart_products(lines)
    assert carts.filter("cart_id = 0").count() <= 50
    totals = basket.basket_cost(carts, prices)
    assert totals.count() == 90 * lines.select("cart_id").distinct().count()
    assert {r["total"] for r in totals.filter("cart_id = 0").collect()} == {Decimal(2 * N // 3).quantize(Decimal("0.01"))}


def test_a_word_in_every_name_is_not_multiplied_out(spark):
    """Requests and products all share a word; the products scored stay few."""
    products = spark.range(3000).select(
        F.concat_ws(" ", F.lit("milk"), F.concat(F.lit("brand"), F.col("id"))).alias("name"),
        F.lit(2).alias("chains_count"), (F.col("id") % 40 + 1).cast("int").alias("stores_count"),
    )
    requests = products.select(F.col("name").alias("request"))
    index, n = search.postings(products)
    asked = search.request_terms(requests, search.term_table(index, n))
    strongest = asked.select(F.get("terms", F.lit(0))["term"].alias("term"))
    assert strongest.filter("term = 'milk'").count() == 0
    candidates = strongest.join(index, "term").count()
    assert candidates == 3000
    found = search.product_search(requests, products)
    assert found.filter("request = name").count() == 3000
    # Round 2 has nothing left to score: "milk" alone cannot reach any request's best.
    assert found.count() == 3000


def test_stores_of_unbounded_size_are_not_hinted(spark, sf_dir):
    shops = tables.stores(spark, sf_dir)
    obs = tables.price_obs(spark, sf_dir).drop("seq")
    logical = stores.join_stores(obs, shops)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical
