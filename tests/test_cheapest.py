"""Lowest totals from files of offers: the least of all totals, and nothing stored by cart and store."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pricebasket.operators import basket, carriers, cheapest, nearby
from pyspark.sql import functions as F
from test_sets import world


def least(totals):
    return sorted(map(tuple, totals.groupBy("cart_id").agg(F.min("total")).collect()))


@pytest.mark.parametrize(("seed", "shard", "chunk", "aim"), [(1, 2_000_000, 1 << 20, 8), (2, 60, 9, 1), (3, 200, 20, 0.01)])
def test_lowest_totals_are_the_least_of_all(spark, monkeypatch, seed, shard, chunk, aim):
    """Null, zero and negative quantities, names that few stores sell, many shards, small chunks, first looks that find nothing."""
    for name, value in (("SHARD_OFFERS", shard), ("CHUNK_WORDS", chunk), ("AIM", aim)):
        monkeypatch.setattr(cheapest, name, value)
    carts, prices, *_ = world(spark, seed, n_stores=600, n_carts=150)
    rare = prices.filter("store_id < '0010'").withColumn("name", F.concat(F.lit("rare "), "name"))
    both = carts.unionByName(carts.filter("cart_id < 60 and name = 'p1'").withColumn("name", F.lit("rare p2")))
    prices = prices.unionByName(rare).cache()
    _, words = basket.offered(prices)
    got = cheapest.lowest_totals(both, words)
    assert got.schema.simpleString() == "struct<cart_id:int,min_price_all:decimal(38,2)>"
    assert sorted(map(tuple, got.collect())) == least(basket.basket_cost(both, prices)) != []
    assert cheapest.lowest_totals(both, words.limit(0)).collect() == []


def test_totals_beyond_long_integers_and_halves_of_cents(spark):
    offers = [("1", name, "victory", f"{i}", Decimal(price), 1, 1) for name, prices in (
        ("a", ("9999999999.99", "9999999999.98")), ("b", ("9999999999.98", "9999999999.99")), ("c", ("0.05", "0.05"))) for i, price in enumerate(prices)]
    prices = spark.createDataFrame(offers, "id STRING, name STRING, chain STRING, store_id STRING, price DECIMAL(12,2), chains_count INT, stores_count INT")
    lines = [(1, "a", "99999999999999.000001"), (1, "b", "3"), (2, "c", "0.5"), (3, "c", "-0.5"), (4, "c", "0.3"), (4, "a", "0"),
             (5, "a", "99999999.999999"), (5, "b", "99999999.999998"), (6, "b", "-99999999999999.5"), (6, "c", "0.1")]
    carts = spark.createDataFrame([(c, n, Decimal(q)) for c, n, q in lines], "cart_id LONG, name STRING, quantity DECIMAL(24,6)")
    got = {r[0]: r[1] for r in cheapest.lowest_totals(carts, basket.offered(prices)[1]).collect()}
    price = {(o[1], o[3]): o[4] for o in offers}
    for cart, total in got.items():
        sums = [sum((price[n, s] * Decimal(q) for c, n, q in lines if c == cart), Decimal(0)) for s in "01"]
        assert total == min(x.quantize(Decimal("0.01"), "ROUND_HALF_UP") for x in sums)
    assert len(got) == 6


def test_few_totals_are_made(spark, monkeypatch):
    """2,000 stores carry every cart of three: a look at the cheapest finds the least total among few."""
    draw = random.Random(4)
    offers = [(f"p{n}", s, draw.randint(100, 99_999)) for n in range(12) for s in range(2000)]
    rows = spark.createDataFrame(offers, "name STRING, store LONG, cents LONG").select(
        F.lit("1").alias("id"), "name", F.lit("victory").alias("chain"), F.col("store").cast("string").alias("store_id"),
        (F.col("cents") / 100).cast("decimal(12,2)").alias("price"), F.lit(1).alias("chains_count"), F.lit(1).alias("stores_count")).cache()
    lines = [(c, f"p{n}", Decimal(draw.randint(1, 9))) for c in range(100) for n in draw.sample(range(12), 3)]
    carts = spark.createDataFrame(lines, "cart_id LONG, name STRING, quantity DECIMAL(14,6)")
    _, words = basket.offered(rows)
    table = words.select("name", F.explode("prices")).collect()
    assert len(table) == 24_000
    names = words.select("name").distinct().withColumn("name_no", F.monotonically_increasing_id())
    folder, _, found, width = cheapest.write_offers(words, names)
    number = {r["name"]: r["name_no"] for r in names.collect()}
    offers_ = cheapest._Offers(folder, tuple(found), width)
    at = offers_.names(np.array([number[n] for _, n, _ in lines]))
    units = np.array([int(q) for *_, q in lines])
    seen = []
    whole = cheapest._Carts.least
    monkeypatch.setattr(cheapest._Carts, "least", lambda self, carts, cart, slot: seen.append(cart.size) or whole(self, carts, cart, slot))
    held = cheapest._Carts(offers_, at, units, np.arange(0, 300, 3), np.full(100, 3))
    best = held.by_levels(np.arange(100))
    assert sum(seen) < 100 * 2000 / 10
    price = {(n, s): p for n, s, p in offers}
    assert best.tolist() == [min(sum(int(q) * price[n, s] for _, n, q in lines[3 * c : 3 * c + 3]) for s in range(2000)) for c in range(100)]


def test_nothing_stored_for_best_store_grows_with_carts_times_stores(spark, monkeypatch):
    """Of 60 carts of sets of their own, tables by cart, or by set of products, hold a few rows for each and not one for every store."""
    carts, prices, users, stores = world(spark, 6, n_stores=500, n_carts=60)
    carts, stored = carts.cache(), {}

    def counting(stage):
        def counted(df, label):
            out = stage(df, label)
            if {"cart_id", "set_id"} & set(out.columns):
                stored[label] = max(stored.get(label, 0), out.count())
            return out
        return counted

    for module in (basket, nearby, carriers, cheapest):
        monkeypatch.setattr(module, "stage", counting(module.stage))
    assert nearby.cheapest_covering(carts, users, stores, basket.offered(prices)).count() > 50
    assert stored and max(stored.values()) < 60 * 30
