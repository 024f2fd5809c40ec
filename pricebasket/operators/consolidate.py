"""From price observations to one product catalogue.

Observations carry ``chain, chain_rank, store_id, item_code, item_name, price, seq``;
``seq`` orders arrivals within a chain and ``chain_rank`` the chains, so results do not
depend on row order. ``by`` names snapshot columns: one catalogue per value of them.

Raw rows are shuffled once, after a map-side combine on the full key, so a product or store
that holds a large share of all rows costs one partial row per task. All rules about products
then work on one row per product, and a single join brings prices back: no step gathers the
prices of one product, or the products of one code, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket import schemas
from pricebasket.session import broadcast_if_small, stage


def last_prices(obs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The last price seen per product, chain and store, and when the triple was first seen."""
    keys = [*by, F.col("item_name").alias("name"), "chain", "store_id"]
    # These aggregates sort. Led by a hash, rows compare by one number; names and dates alone
    # share long prefixes and would be compared whole. Numbered names need no such column.
    texts = obs.schema["item_name"].dataType.simpleString() == "string"
    lead = [F.xxhash64(*by, "item_name", "chain", "store_id").alias("lead")] if texts else []
    return obs.groupBy(*lead, *keys).agg(
        F.max_by("price", "seq").alias("price"),
        F.min(F.struct("chain_rank", "seq", "item_code")).alias("first_seen"),
    ).drop("lead")


@dataclass(frozen=True)
class Consolidated:
    """``prices``: one row per product, chain and store. ``products``: one row per exact name."""

    prices: DataFrame
    products: DataFrame
    by: tuple[str, ...]

    def long(self, products: DataFrame | None = None) -> DataFrame:
        """Prices of ``products`` (all by default) with the products' columns.

        ``products`` may rename: prices are those of ``source``, listed under ``name``.
        """
        if products is None:
            products = self.products.withColumn("source", F.col("name"))
        dim = products.select(
            *[F.col(column).alias(f"product_{column}") for column in self.by],
            "source", "id", F.col("name").alias("listed"), "chains_count", "stores_count",
        )
        # A blank name is a product too, so nulls must meet.
        same: Column = F.col("name").eqNullSafe(F.col("source"))
        for column in self.by:
            same = same & (F.col(column) == F.col(f"product_{column}"))
        return self.prices.join(broadcast_if_small(dim), same).select(
            *self.by, "id", F.col("listed").alias("name"), "chain", "store_id", "price", "chains_count", "stores_count"
        )


def consolidate(obs: DataFrame, by: Sequence[str] = ()) -> Consolidated:
    """One product per exact name; its id is the code it was first seen with."""
    prices = stage(last_prices(obs, by), "last-prices")
    return Consolidated(prices, stage(products_of(prices, by), "products"), tuple(by))


def products_of(prices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per exact name of ``last_prices``: when it was first seen, its id, and how many chains and stores price it."""
    # Per product and chain first, so that any number of chains is counted without a set of them.
    per_chain = prices.groupBy(*by, "name", "chain").agg(
        F.min("first_seen").alias("first_seen"), F.count(F.lit(1)).alias("stores")
    )
    products = per_chain.groupBy(*by, "name").agg(
        F.min("first_seen").alias("first_seen"),
        F.count(F.lit(1)).cast("int").alias("chains_count"),
        F.sum("stores").cast("int").alias("stores_count"),
    )
    return products.withColumn("id", F.col("first_seen.item_code"))


def multi_chain_products(products: DataFrame) -> DataFrame:
    """Only products that several chains price."""
    return products.filter(F.col("chains_count") > 1).withColumn("source", F.col("name"))


def merge_by_id(products: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Merge single-chain products that share an id: one row per product whose prices stay.

    The merged name is the smallest one. Per chain the prices are those of the product
    first seen last, ``source``; they replace earlier products' prices as a whole. Products
    without an id drop out (``dropped_without_id`` counts them).
    """
    per_chain = (
        products.filter((F.col("chains_count") == 1) & F.col("id").isNotNull())
        .groupBy(*by, "id", F.col("first_seen.chain_rank").alias("chain_rank"))
        .agg(
            F.max_by(F.struct(F.col("name").alias("source"), "stores_count"), "first_seen").alias("kept"),
            F.min("name").alias("name"),
        )
    )
    return (
        per_chain.groupBy(*by, "id")
        .agg(
            F.min("name").alias("name"),
            F.count(F.lit(1)).cast("int").alias("chains_count"),
            F.sum("kept.stores_count").cast("int").alias("stores_count"),
            # At most one entry per chain.
            F.collect_list("kept").alias("kept"),
        )
        .withColumn("kept", F.explode("kept"))
        .select(*by, "kept.source", "id", "name", "chains_count", "stores_count")
    )


def dropped_without_id(products: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many single-chain products ``merge_by_id`` leaves out for want of an id."""
    lost = products.filter((F.col("chains_count") == 1) & F.col("id").isNull())
    return lost.groupBy(*by).agg(F.count(F.lit(1)).alias("dropped_products"))


def kept_products(consolidated: Consolidated) -> DataFrame:
    """The catalogue's products: multi-chain ones as they are, single-chain ones merged by id."""
    merged = merge_by_id(consolidated.products, consolidated.by)
    return multi_chain_products(consolidated.products).select(*merged.columns).unionByName(merged)


def catalog(obs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The whole catalogue in long form: a row per product, chain and store."""
    consolidated = consolidate(obs, by)
    return consolidated.long(stage(kept_products(consolidated), "kept-products"))


def catalog_products(prices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per product of a long-form catalogue."""
    return prices.groupBy(*by, "name").agg(
        F.min("id").alias("id"),
        F.max("chains_count").alias("chains_count"),
        F.max("stores_count").alias("stores_count"),
    )


def nest_prices(prices: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The published form: one row per product with ``chains: {chain: {store: price}}``.

    Prices are text there. A product's map is as large as the number of stores that price it.
    """
    product = [*by, "id", "name", "chains_count", "stores_count"]
    chains = F.transform(
        F.sort_array(F.collect_list(F.struct("chain", "stores"))),
        lambda entry: F.struct(entry["chain"].alias("key"), F.map_from_entries(entry["stores"]).alias("value")),
    )
    return (
        prices.groupBy(*product, "chain")
        .agg(F.sort_array(F.collect_list(F.struct("store_id", F.col("price").cast("string")))).alias("stores"))
        .groupBy(*product)
        .agg(F.map_from_entries(chains).alias("chains"))
    )


def drop_empty_chains(products: DataFrame) -> DataFrame:
    """Remove chains without a price from a published row, as messages from outside may carry them."""
    return products.withColumn("chains", F.map_filter("chains", lambda _, stores: F.size(stores) > 0))


def count_chains(products: DataFrame) -> DataFrame:
    """Set chains_count and stores_count of published rows from their maps; empty chains do not count."""
    sizes = F.transform(F.map_values("chains"), lambda stores: F.size(stores))
    return products.withColumn("chains_count", F.size(F.filter(sizes, lambda size: size > 0))).withColumn(
        "stores_count", F.aggregate(sizes, F.lit(0), lambda total, size: total + size)
    )


def flatten_prices(products: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Published rows back to one row per product, chain and store."""
    rest = [*by, "id", "name", "chains_count", "stores_count"]
    return (
        products.select(*rest, F.explode("chains").alias("chain", "stores"))
        .select(*rest, "chain", F.explode("stores").alias("store_id", "price"))
        .withColumn("price", F.col("price").try_cast(schemas.PRICE))
    )


def dedup_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given total order.

    An aggregate rather than a window: each task keeps one row per key, so a key with many
    copies never gathers in one task.
    """
    others = [name for name in rows.columns if name not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("first")
    return rows.groupBy(*keys).agg(first).select(*keys, "first.*").select(*rows.columns)
