"""The given star-schema tables read as price observations, stores, carts, requests and posts.

Order lines stand for price observations: a supplier is a store, its region modulo 3 the
chain, a part the product. Every row of every table takes part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket import constants, schemas
from pricebasket.functions import text
from pricebasket.session import broadcast_if_small, stage

# What a long shopping list asks for besides its own part, each of the part's brand.
LONG_LIST = ("small ring", "red widget", "blue bolt", "old gear", "new plate")

# No number, too large, too fine, small but right, right.
ODD_QUANTITIES = ("x", "999999999", "0.0000004", "0.0004", "1.2345")

SEQ = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chain(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in constants.CHAINS]), rank)


def latitude(key: Column) -> Column:
    return (F.lit(29500) + (key * 37) % 3500) / F.lit(1000.0)


def longitude(key: Column) -> Column:
    return (F.lit(34300) + (key * 91) % 1500) / F.lit(1000.0)


def item_name() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand")


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain_rank = F.col("n_regionkey") % len(constants.CHAINS)
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "s_suppkey", "s_name", "n_name",
            chain_rank.alias("chain_rank"),
            _chain(chain_rank).alias("chain"),
            text.zero_padded(F.col("s_suppkey")).alias("store_id"),
        )
    )


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with the source's own columns beside the canonical ones."""
    part = table(spark, sf_dir, "part").select("p_partkey", item_name().alias("item_name"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(store_dim(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("item_code", (F.col("p_partkey") % 97).cast("string"))
    )


def price_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chain, chain_rank, store_id, item_code, item_name, price, pulling_date, snapshot, seq."""
    pulling_date = F.to_date("l_shipdate")
    return raw_observations(spark, sf_dir).select(
        "chain", "chain_rank", "store_id", "item_code", "item_name",
        F.col("l_extendedprice").cast(schemas.PRICE).alias("price"),
        pulling_date.alias("pulling_date"),
        F.trunc(pulling_date, "month").alias("snapshot"),
        F.struct(*SEQ).alias("seq"),
    )


@dataclass(frozen=True)
class Numbers:
    """Names and stores by number, so that long shuffles carry two numbers and not three texts."""

    names: DataFrame
    stores: DataFrame

    def named(self, rows: DataFrame) -> DataFrame:
        """``rows`` of numbered keys with the texts in their place."""
        keys = {"name": "name_no", "store_id": "store_no"}
        return (
            rows.drop("chain").withColumnsRenamed(keys)
            .join(broadcast_if_small(self.names), "name_no")
            .join(broadcast_if_small(self.stores), "store_no")
            .withColumnRenamed("item_name", "name")
            .select(*rows.columns)
        )


def numbers(spark: SparkSession, sf_dir: str) -> Numbers:
    """Every name of a part and every (chain, store_id), numbered once and stored."""
    number = F.monotonically_increasing_id()
    names = table(spark, sf_dir, "part").select(item_name().alias("item_name")).distinct()
    stores = store_dim(spark, sf_dir).select("chain", "store_id").distinct()
    return Numbers(
        stage(names.withColumn("name_no", number), "numbered-names"), stage(stores.withColumn("store_no", number), "numbered-stores"))


def _numbered_lines(lineitem: DataFrame, spark: SparkSession, sf_dir: str, by: Numbers) -> DataFrame:
    """Order lines with item_name, chain and store_id as numbers; the chain is part of the store's."""
    part = table(spark, sf_dir, "part").select("p_partkey", item_name().alias("item_name")).join(broadcast_if_small(by.names), "item_name")
    shops, known = store_dim(spark, sf_dir), by.stores.withColumnsRenamed({"chain": "known_chain", "store_id": "known_id"})
    same = F.col("chain").eqNullSafe(F.col("known_chain")) & F.col("store_id").eqNullSafe(F.col("known_id"))
    shops = shops.join(broadcast_if_small(known), same).select("s_suppkey", "store_no")
    # Parts are joined before the stores are known, and stores by broadcast where they are few.
    return (
        lineitem.join(part.select("p_partkey", F.col("name_no").alias("item_name")), F.col("l_partkey") == F.col("p_partkey"))
        .join(shops, F.col("l_suppkey") == F.col("s_suppkey"))
        # 0, but no constant: a plan puts constants in the place of columns, and rows dealt by one do not count as dealt by the other.
        .withColumns({"chain": F.pmod("store_no", F.lit(1)).cast("int"), "store_id": F.col("store_no")})
    )


def numbered_obs(spark: SparkSession, sf_dir: str, by: Numbers) -> DataFrame:
    """``price_obs`` with numbers for item_name, chain and store_id. A store is one supplier, whose key then orders nothing in ``seq``."""
    return _numbered_lines(table(spark, sf_dir, "lineitem"), spark, sf_dir, by).select(
        "chain", F.lit(0).alias("chain_rank"), "store_id", (F.col("p_partkey") % 97).cast("string").alias("item_code"), "item_name",
        F.col("l_extendedprice").cast(schemas.PRICE).alias("price"), F.to_date("l_shipdate").alias("pulling_date"),
        F.struct(*(column for column in SEQ if column != "l_suppkey")).alias("seq"))


def chain_stores(spark: SparkSession, sf_dir: str, chain: str) -> DataFrame:
    """One chain's stores as its own file would list them."""
    return (
        store_dim(spark, sf_dir)
        .filter(F.col("chain") == chain)
        .select(
            F.col("s_suppkey").alias("StoreId"),
            F.col("s_name").alias("StoreName"),
            F.col("store_id").alias("Address"),
            F.col("n_name").alias("City"),
        )
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store table with coordinates, which every sixth store lacks."""
    located = F.col("s_suppkey") % 6 != 5
    return store_dim(spark, sf_dir).select(
        "chain", "store_id", F.col("s_name").alias("store_name"),
        F.when(located, latitude(F.col("s_suppkey"))).alias("latitude"),
        F.when(located, longitude(F.col("s_suppkey"))).alias("longitude"),
    )


def with_blank_prices(prices: DataFrame) -> DataFrame:
    """A catalogue in which prices that end in 3 cents are blank, as files have them now and then."""
    blank = (F.col("price") * 100).cast("long") % 10 == 3
    return prices.withColumn("price", F.when(~blank, F.col("price")))


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an address as people type it: odd case and blanks."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit("   "), 1 + F.col("c_custkey") % 2).alias("address"),
            F.col("n_name").alias("city"),
        )
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known addresses with coordinates: in each city one house number per street."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    known = F.concat("c_mktsegment", F.lit(" "), 1 + F.col("n_nationkey") % 2, F.lit(", "), "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.lower(known).alias("full_address"))
        .agg(
            latitude(F.min("n_nationkey")).alias("latitude"),
            longitude(F.min("n_nationkey")).alias("longitude"),
        )
    )


def misspelt_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose typed address may lack its second letter, have one doubled or another exchanged."""
    typed = F.trim("address")
    kind = F.col("customer_id") % 4
    wrong = (
        F.when(kind == 1, F.concat(F.substring(typed, 1, 1), F.substring(typed, 3, 100)))
        .when(kind == 2, F.concat(F.substring(typed, 1, 3), F.substring(typed, 3, 100)))
        .when(kind == 3, F.concat(F.substring(typed, 1, 2), F.lit("xy"), F.substring(typed, 4, 100)))
        .otherwise(typed)
    )
    return customer_addresses(spark, sf_dir).withColumn("address", wrong)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every order as a cart line that names its product exactly."""
    part = table(spark, sf_dir, "part").select("p_partkey", item_name().alias("product_name"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("cart_id"),
            "product_name",
            F.col("l_quantity").cast(schemas.QUANTITY).alias("quantity"),
        )
    )


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the owner of each order is."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("cart_id"),
        latitude(F.col("o_custkey")).alias("user_lat"),
        longitude(F.col("o_custkey")).alias("user_lon"),
    )


def price_requests(spark: SparkSession, sf_dir: str, by: Numbers) -> DataFrame:
    """What each order line's product cost in its store on the day of the order, as a question in numbered keys."""
    ordered = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("day"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(ordered, "l_orderkey")
    return _numbered_lines(lines, spark, sf_dir, by).select(
        "l_orderkey", "l_linenumber", F.col("item_name").alias("name"), "chain", "store_id", "day")


def cart_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One free-text shopping list per part; the part's type decides its shape.

    STANDARD, PROMO and LARGE are well formed, SMALL ends in a comma, ECONOMY has one of
    ODD_QUANTITIES, MEDIUM asks for something no catalogue has.
    """
    full = F.concat_ws(" ", "p_name", "p_brand", "p_size")
    kind = F.col("p_type")
    others = [F.concat_ws(" ", F.lit(name), "p_brand", F.lit("2")) for name in LONG_LIST]
    message = (
        F.when(kind == "STANDARD", F.concat_ws(", ", full, F.concat(F.col("p_name"), F.lit(" 2"))))
        .when(kind == "PROMO", F.concat(F.lit("  "), F.upper("p_name"), F.lit("   1.5,"), full))
        .when(kind == "LARGE", F.concat_ws(",", full, *others, full))
        .when(kind == "SMALL", F.concat(full, F.lit(",")))
        .when(
            kind == "ECONOMY",
            F.concat_ws(", ", full, F.concat(F.col("p_brand"), F.lit(" "), F.get(F.array(*map(F.lit, ODD_QUANTITIES)), F.col("p_partkey").cast("int") % len(ODD_QUANTITIES)))),
        )
        .otherwise(F.concat_ws(", ", full, F.lit("unheard pack 1")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("cart_id"),
        message.alias("message"),
        latitude(F.col("p_partkey")).alias("user_lat"),
        longitude(F.col("p_partkey")).alias("user_lon"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Events, a table or a stream, as chat messages of their users: start words, choices, places, lists and slips."""
    n = F.col("event_id") % 7
    text = (
        F.when(n == 0, constants.START_WORDS[0]).when(n == 1, constants.START_WORDS[2]).when(n == 2, "Top5")
        .when(n.isin(3, 4), F.concat(F.lit("milk "), F.floor("value").cast("string"), F.lit(", "), F.col("event_type"), F.lit(" 2")))
        .when(n == 5, F.concat_ws(" ", "event_type", F.lit("street")))
    )
    return events.select(
        F.concat(F.lit("e"), F.col("user_id").cast("string")).alias("chat_id"), F.to_date("ts").alias("day"), F.col("event_id").alias("at"), text.alias("text"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events and all conversations as chat messages; a conversation is one day's."""
    talk = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("chat_id"), F.lit("2024-01-01").cast("date").alias("day"),
        F.col("turn").cast("long").alias("at"), "text")
    return event_messages(table(spark, sf_dir, "events")).unionByName(talk)


def request_records(lineitem: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored request per order line: the product asked for and a plainer second line.

    ``lineitem`` may be the table or a stream of it.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", item_name().alias("item_name"))

    def line(name: Column, quantity: Column) -> Column:
        return F.struct(name.alias("name"), quantity.cast("string").alias("product_quantity"))

    lines = F.array(
        line(F.col("item_name"), F.col("l_quantity").cast("int")),
        line(F.col("p_name"), F.col("l_linenumber")),
    )
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.to_json(lines).alias("product_list"),
            F.col("l_orderkey").cast("string").alias("user_id"),
            F.col("l_suppkey").cast("string").alias("chat_id"),
            F.concat(F.lit("first "), F.col("l_returnflag")).alias("user_first_name"),
            F.concat(F.lit("last "), F.col("l_linestatus")).alias("user_last_name"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("user_user_name"),
            text.zero_padded(F.col("l_suppkey")).alias("min_aff"),
            F.col("l_extendedprice").cast(schemas.PRICE).cast("string").alias("min_price"),
        )
    )


def raw_posts(documents: DataFrame) -> DataFrame:
    """Documents, a table or a stream, as nested post messages, one JSON text per row."""
    user = F.struct(
        (F.col("doc_id") % 1000).cast("string").alias("id"),
        F.concat(F.lit("user "), F.col("doc_id") % 1000).alias("name"),
        F.lit("2020-01-01T00:00:00").alias("created_at"),
        F.col("source").alias("location"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("url"),
        F.lit(False).alias("protected"),
        F.lit(True).alias("verified"),
        (F.col("n_chars") % 1000).cast("int").alias("followers_count"),
        (F.col("n_chars") % 100).cast("int").alias("friends_count"),
        (F.col("n_chars") % 10).cast("int").alias("listed_count"),
        F.lit(1).alias("favourites_count"),
        F.lit(2).alias("statuses_count"),
    )
    post = F.struct(
        F.lit("2024-01-01T00:00:00").alias("created_at"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("text"),
        F.col("lang"),
        user.alias("user"),
    )
    return documents.select(F.to_json(post).alias("value"))
