"""Order-dependent rules of the catalogue on hand-written observations."""

import random
from decimal import Decimal

from pricebasket import constants
from pricebasket.operators import consolidate
from pyspark.sql import functions as F

OBS = "chain STRING, chain_rank INT, store_id STRING, item_code STRING, item_name STRING, price DECIMAL(12,2), seq INT"


def observations(spark, rows):
    """rows: (chain, store_id, code, name, price) in order of arrival."""
    from decimal import Decimal

    data = [
        (chain, constants.CHAINS.index(chain), store, code, name, None if price is None else Decimal(price), seq)
        for seq, (chain, store, code, name, price) in enumerate(rows)
    ]
    random.Random(7).shuffle(data)
    return spark.createDataFrame(data, OBS)


def long_rows(df):
    return sorted(
        (r["id"], r["name"], r["chain"], r["store_id"], str(r["price"]), r["chains_count"], r["stores_count"])
        for r in df.collect()
    )


def test_last_price_wins_and_first_chain_names_the_id(spark):
    obs = observations(spark, [
        ("ramilevi", "043", "R1", "milk", "5.00"),
        ("victory", "002", "V1", "milk", "6.00"),
        ("victory", "002", "V2", "milk", "6.50"),
        ("shufersal", "001", "S1", "milk", "7.00"),
    ])
    assert long_rows(consolidate.consolidate(obs).long()) == [
        ("V1", "milk", "ramilevi", "043", "5.00", 3, 3),
        ("V1", "milk", "shufersal", "001", "7.00", 3, 3),
        ("V1", "milk", "victory", "002", "6.50", 3, 3),
    ]


def test_row_order_does_not_matter(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(constants.CHAINS), f"{rng.randrange(4):03d}", f"c{rng.randrange(5)}", f"n{rng.randrange(9)}", f"{rng.randrange(99)}.00")
        for _ in range(300)
    ]
    obs = observations(spark, rows)
    again = obs.orderBy("price").repartition(7)
    assert long_rows(consolidate.catalog(obs)) == long_rows(consolidate.catalog(again))


def test_single_chain_products_merge_by_id(spark):
    obs = observations(spark, [
        ("victory", "002", "A", "tea b", "1.00"),
        ("victory", "008", "A", "tea b", "2.00"),
        ("victory", "014", "A", "tea a", "3.00"),
        ("shufersal", "001", "A", "tea c", "4.00"),
    ])
    # Later "tea a" replaces all of victory's prices of "tea b"; the name is the smallest.
    assert long_rows(consolidate.catalog(obs)) == [
        ("A", "tea a", "shufersal", "001", "4.00", 2, 2),
        ("A", "tea a", "victory", "014", "3.00", 2, 2),
    ]


def test_products_without_id_drop_out_and_are_counted(spark):
    obs = observations(spark, [
        ("victory", "002", None, "loose", "1.00"),
        ("victory", "002", "B", "bread", "2.00"),
    ])
    consolidated = consolidate.consolidate(obs)
    assert [r[0] for r in long_rows(consolidate.catalog(obs))] == ["B"]
    assert consolidate.dropped_without_id(consolidated.products).first()["dropped_products"] == 1


def test_blank_names_form_one_group(spark):
    obs = observations(spark, [
        ("victory", "002", "X", None, "1.00"),
        ("shufersal", "001", "Y", None, "2.00"),
    ])
    assert {(r["id"], r["chains_count"]) for r in consolidate.consolidate(obs).long().collect()} == {("X", 2)}


def test_nested_form_and_back(spark):
    obs = observations(spark, [
        ("victory", "002", "0012", "milk", "5.90"),
        ("shufersal", "001", "S", "milk", "6.10"),
        ("shufersal", "035", "S", "milk", "6.00"),
    ])
    prices = consolidate.catalog(obs)
    nested = consolidate.nest_prices(prices)
    row = nested.first()
    assert row["chains"] == {"victory": {"002": "5.90"}, "shufersal": {"001": "6.10", "035": "6.00"}}
    assert row["id"] == "0012"
    assert long_rows(consolidate.flatten_prices(nested)) == long_rows(prices)


def test_empty_chains_leave_a_published_row(spark):
    nested = spark.createDataFrame(
        [("1", "milk", 1, 1, {"victory": {"002": "5"}, "shufersal": {}})],
        "id STRING, name STRING, chains_count INT, stores_count INT, chains MAP<STRING, MAP<STRING, STRING>>",
    )
    assert consolidate.drop_empty_chains(nested).first()["chains"] == {"victory": {"002": "5"}}
    counted = consolidate.count_chains(nested.withColumns({"chains_count": F.lit(9), "stores_count": F.lit(9)})).first()
    assert (counted["chains_count"], counted["stores_count"]) == (1, 1)


def test_dedup_keeps_the_first(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, "z")], "k STRING, o INT, v STRING")
    assert sorted(map(tuple, consolidate.dedup_first(rows, ["k"], ["o"]).collect())) == [("a", 1, "x"), ("b", 3, "z")]


def test_any_number_of_chains_is_counted(spark):
    rows = [(f"c{i}", i, "001", "7", "salt", Decimal("1.00"), i) for i in range(70)]
    product = consolidate.consolidate(spark.createDataFrame(rows, OBS)).products.first()
    assert (product["chains_count"], product["stores_count"]) == (70, 70)
