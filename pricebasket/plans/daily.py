"""Whole jobs: the daily price build and the basket answers."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket import constants
from pricebasket.operators import basket, consolidate, nearby, stores
from pricebasket.session import stage, work_area
from pricebasket.sources import catalog_store, files


@dataclass(frozen=True)
class DailyInputs:
    """Where a day's files lie: per chain a folder of price files and one of store files."""

    price_paths: dict[str, str]
    store_paths: dict[str, str]
    gazetteer: DataFrame
    allowed: dict[str, list[str]] | None = None


def daily_observations(spark: SparkSession, inputs: DailyInputs, run_date: str) -> DataFrame:
    """The day's observations, from the newest price file of each allowed store.

    A chain without any file ends the job.
    """
    parts = []
    for chain in constants.CHAINS:
        allowed = inputs.allowed.get(chain) if inputs.allowed else None
        paths = files.price_file_paths(spark, inputs.price_paths[chain], allowed)
        if not paths:
            raise ValueError(f"no price file of {chain} in {inputs.price_paths[chain]}")
        parts.append(files.read_price_files(spark, paths, chain, run_date))
    return reduce(DataFrame.unionByName, parts)


def daily_products(spark: SparkSession, inputs: DailyInputs, run_date: str) -> DataFrame:
    """The day's catalogue in long form."""
    return consolidate.catalog(daily_observations(spark, inputs, run_date))


def daily_stores(spark: SparkSession, inputs: DailyInputs, run_date: str) -> DataFrame:
    """The day's stores of all chains with coordinates."""
    rows = {
        chain: files.read_store_files(spark, files.newest_store_files(spark, inputs.store_paths[chain]), chain)
        for chain in constants.CHAINS
    }
    union = stores.apply_allowlist(stores.stores_union(rows), inputs.allowed)
    return stores.geocode(union, inputs.gazetteer).withColumn("pulling_date", F.lit(run_date).cast("date"))


def run_day(spark: SparkSession, inputs: DailyInputs, run_date: str, out: str) -> dict[str, DataFrame]:
    """Products, then stores: JSON and Parquet snapshots of the day and fresh current tables."""
    day = F.lit(run_date).cast("date")
    version = f"{run_date}-{uuid.uuid4().hex}"
    with work_area(spark):
        prices = stage(daily_products(spark, inputs, run_date), "daily-products").withColumn("pulling_date", day)
        nested = consolidate.nest_prices(prices, ["pulling_date"])
        files.write_snapshot(nested, f"{out}/products/json", "json")
        files.write_snapshot(prices, f"{out}/products/parquet")
        shops = stage(daily_stores(spark, inputs, run_date), "daily-stores")
        files.write_snapshot(shops, f"{out}/stores/json", "json")
        files.write_snapshot(shops, f"{out}/stores/parquet")
        return {
            "products": files.publish_current(prices, "products", f"{out}/current/products/{version}"),
            "stores": files.publish_current(shops, "stores", f"{out}/current/stores/{version}"),
        }


def update_day(spark: SparkSession, inputs: DailyInputs, run_date: str, root: str, table: str) -> catalog_store.Snapshot:
    """Take the day into the catalogue of all days so far, and its stores, in one version that ``table`` names from then on.

    Unlike ``run_day``, which rebuilds the current tables from the day's files alone, products that the
    day does not list stay, and only what the day touches is read and written.
    """
    with work_area(spark):
        shops = stage(daily_stores(spark, inputs, run_date), "daily-stores")
        obs = stage(daily_observations(spark, inputs, run_date), "daily-observations")
        return catalog_store.add_observations(spark, root, table, obs, shops)


class CartAnswers:
    """Answers to all messages; each is made when first asked for, from what the others have made."""

    def __init__(self, messages: DataFrame, prices: DataFrame, shops: DataFrame):
        self._messages, self._prices, self._shops = messages, prices, shops

    @cached_property
    def items(self) -> DataFrame:
        products = stage(consolidate.catalog_products(self._prices), "products")
        return stage(basket.match_products(basket.parse_carts(self._messages), products), "cart-items")

    @cached_property
    def _carts(self) -> DataFrame:
        return stage(basket.cart_products(basket.complete_items(self.items)), "carts")

    @cached_property
    def _offer(self) -> tuple[DataFrame, DataFrame]:
        return basket.offered(self._prices)

    @cached_property
    def status(self) -> DataFrame:
        return basket.cart_status(self.items, basket.served_carts(self._carts, self._offer[1]))

    @cached_property
    def best(self) -> DataFrame:
        users = self._messages.select("cart_id", "user_lat", "user_lon")
        return nearby.cheapest_covering(self._carts, users, self._shops, self._offer)

    @cached_property
    def summary(self) -> DataFrame:
        served = basket.served_carts(self._carts, self._offer[1])
        return basket.cart_summary(basket.complete_items(self.items).join(served, "cart_id", "left_semi"))


def answer_messages(messages: DataFrame, prices: DataFrame, shops: DataFrame) -> CartAnswers:
    """Answer every shopping-list message at once.

    ``messages``: cart_id, message, user_lat, user_lon. ``prices`` and ``shops`` are the current
    tables, already stored.
    """
    return CartAnswers(messages, prices, shops)


def request_messages(answers: CartAnswers, messages: DataFrame) -> DataFrame:
    """The request record sent for each answered cart: what was asked, where it is cheapest, for how much.

    ``messages`` supplies the sender's columns beside cart_id. Lines come from one message,
    whose length bounds the list.
    """
    lines = answers.items.groupBy("cart_id").agg(
        F.sort_array(
            F.collect_list(F.struct("pos", "name", F.col("quantity_text").alias("product_quantity")))
        ).alias("lines")
    )
    product_list = F.to_json(
        F.transform("lines", lambda line: F.struct(line["name"].alias("name"), line["product_quantity"].alias("product_quantity")))
    )
    sender = ["user_id", "chat_id", "user_first_name", "user_last_name", "user_user_name"]
    return (
        answers.best.join(lines, "cart_id")
        .join(messages.select("cart_id", *sender), "cart_id")
        .select(
            product_list.alias("product_list"),
            *[F.col(name).cast("string") for name in sender],
            stores.display_name(F.col("chain"), F.col("store_name")).alias("min_aff"),
            F.col("min_price_all").cast("string").alias("min_price"),
        )
    )
