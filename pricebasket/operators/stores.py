"""Stores: union of the chains' lists, allow-list, newest files, lookup and coordinates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket import constants
from pricebasket.functions import text
from pricebasket.operators.fuzzy import similar_pairs

# Per chain, the column of the source that holds each canonical store column.
STORE_COLUMNS = {
    "victory": {"store_id": "StoreID", "store_name": "StoreName", "address": "Address", "city": "City"},
    "shufersal": {"store_id": "STOREID", "store_name": "STORENAME", "address": "ADDRESS", "city": "CITY"},
    "ramilevi": {"store_id": "StoreId", "store_name": "StoreName", "address": "Address", "city": "City"},
}


def canonical_stores(rows: DataFrame, chain: str) -> DataFrame:
    """One chain's store rows under the common column names."""
    source = STORE_COLUMNS[chain]
    return rows.select(
        text.zero_padded(F.trim(F.col(source["store_id"]).cast("string"))).alias("store_id"),
        F.lit(chain).alias("chain"),
        F.lit(constants.CHAIN_IDS[chain]).alias("chain_id"),
        F.lit(constants.CHAIN_NAMES[chain]).alias("chain_name"),
        *[text.blank_to_null(F.col(source[name])).alias(name) for name in ("store_name", "address", "city")],
    )


def stores_union(per_chain: dict[str, DataFrame]) -> DataFrame:
    """All chains' stores, one row per store: of several the first by its columns, in their order."""
    parts = [canonical_stores(rows, chain) for chain, rows in per_chain.items()]
    every = reduce(DataFrame.unionByName, parts)
    rest = [name for name in every.columns if name not in ("chain", "store_id")]
    return every.groupBy("chain", "store_id").agg(F.min(F.struct(*rest)).alias("one")).select(
        "store_id", "chain", *(F.col(f"one.{name}") for name in rest))


def allowlist_table(spark: SparkSession, allowed: dict[str, list[str]]) -> DataFrame:
    rows = [(chain, store_id) for chain, ids in allowed.items() for store_id in ids]
    return spark.createDataFrame(rows, "chain STRING, store_id STRING")


def apply_allowlist(rows: DataFrame, allowed: dict[str, list[str]] | None) -> DataFrame:
    """Rows of allowed stores. ``None`` allows every store, and so does a chain mapped to None.

    The list is a hand-written constant, so it is broadcast: the rows are not shuffled.
    """
    if allowed is None:
        return rows
    open_chains = [chain for chain, ids in allowed.items() if ids is None]
    listed = {chain: ids for chain, ids in allowed.items() if ids is not None}
    kept = rows.join(F.broadcast(allowlist_table(rows.sparkSession, listed)), ["chain", "store_id"], "left_semi")
    if not open_chains:
        return kept
    return kept.unionByName(rows.filter(F.col("chain").isin(open_chains)))


def join_stores(obs: DataFrame, stores: DataFrame) -> DataFrame:
    """Observations of known stores, with the store's columns. Spark broadcasts the store
    table when its size is below the session's threshold and merges sorted sides otherwise."""
    columns = [name for name in stores.columns if name not in obs.columns or name in ("chain", "store_id")]
    return obs.join(stores.select(*columns), ["chain", "store_id"])


def parse_file_name(name: Column) -> Column:
    """(file_type, chain_id, store_id, stamp) of ``PriceFull<chain>-<store>-<stamp>``."""
    pattern = r"([A-Za-z]+)(\d+)-(\d+)-(\d+)"
    fields = ("file_type", "chain_id", "store_id", "stamp")
    return F.struct(*[F.regexp_extract(name, pattern, i + 1).alias(field) for i, field in enumerate(fields)])


def latest_file(files: DataFrame) -> DataFrame:
    """The newest file per type, chain and store, by the stamp in its name."""
    return (
        files.select("file_name", parse_file_name(F.col("file_name")).alias("parsed"))
        .select("file_name", "parsed.*")
        .groupBy("file_type", "chain_id", "store_id")
        .agg(F.max_by("file_name", "stamp").alias("file_name"), F.max("stamp").alias("stamp"))
    )


def store_messages(stores: DataFrame, pulling_date: str) -> DataFrame:
    """Stores under the fields of the published message (`schemas.STORE_MESSAGE`)."""
    has = set(stores.columns)
    address = F.col("address") if "address" in has else F.lit(None).cast("string")
    return stores.select(
        F.col("store_name").alias("StoreName"), address.alias("Address"), F.col("city").alias("City"), "store_id",
        text.by_chain(constants.CHAIN_IDS, F.col("chain")).alias("ChainId"),
        text.by_chain(constants.CHAIN_NAMES, F.col("chain")).alias("ChainName"),
        F.lit(pulling_date).alias("pulling_date"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
    )


def display_name(chain: Column, store_name: Column) -> Column:
    """The chain's name, a blank and the store's, as people are told it; null for an unknown chain."""
    known = F.coalesce(store_name, F.lit("store name not found"))  # fixed text
    return F.concat(text.by_chain(constants.CHAIN_NAMES, chain), F.lit(" "), known)


def store_lookup(candidates: DataFrame, stores: DataFrame) -> DataFrame:
    """Resolve ``store@chain`` keys to display name and coordinates; misses keep nulls."""
    keys = candidates.withColumn("store_id", F.split_part("store_key", F.lit("@"), F.lit(1))).withColumn(
        "chain", F.split_part("store_key", F.lit("@"), F.lit(2))
    )
    found = stores.select("chain", "store_id", "store_name", "latitude", "longitude")
    return keys.join(found, ["chain", "store_id"], "left").withColumn(
        "display_name", display_name(F.col("chain"), F.col("store_name"))
    )


def normal_address(address: Column, city: Column) -> Column:
    """``address, city`` lower-cased with single blanks: the key of the gazetteer."""
    return F.lower(F.trim(F.regexp_replace(F.concat_ws(", ", F.trim(address), F.trim(city)), r"\s+", " ")))


def geocode(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add coordinates by normalised address; an address the gazetteer lacks keeps nulls.

    ``gazetteer`` has ``full_address``, ``latitude`` and ``longitude``; of several rows for an address
    the one with the smallest coordinates counts, so no row is multiplied.
    """
    known = gazetteer.groupBy("full_address").agg(F.min(F.struct("latitude", "longitude")).alias("place")).select(
        "full_address", "place.*")
    keyed = rows.withColumn("full_address", normal_address(F.col("address"), F.col("city")))
    return keyed.join(known, "full_address", "left").withColumn(
        "resolved", F.col("latitude").isNotNull()
    )


def unresolved_addresses(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Each address the gazetteer lacks and how many rows have it."""
    keyed = rows.select(normal_address(F.col("address"), F.col("city")).alias("full_address"))
    counted = keyed.groupBy("full_address").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(gazetteer.select("full_address"), "full_address", "left_anti")


def geocode_fuzzy(rows: DataFrame, gazetteer: DataFrame, max_edits: int = 2) -> DataFrame:
    """`geocode`, and for addresses the gazetteer lacks the place of the nearest spelling it has.

    A spelling may differ in up to ``max_edits`` characters but not in its numbers, as another house number is
    another house; of several the one with fewest edits, then the least, counts. ``matched_address`` and ``edits``
    say what was taken. Distinct addresses are compared, so a hot address costs one comparison.
    """
    known = gazetteer.groupBy("full_address").agg(F.min(F.struct("latitude", "longitude")).alias("place")).select("full_address", "place.*")
    keyed = rows.withColumn("full_address", normal_address(F.col("address"), F.col("city")))
    asked = keyed.select("full_address").distinct().join(known.select("full_address"), "full_address", "left_anti")

    def numbers(column: str) -> Column:
        return F.regexp_extract_all(column, F.lit(r"(\d+)"))

    pairs = similar_pairs(asked, known.select("full_address"), max_edits).filter(numbers("asked") == numbers("known"))
    nearest = pairs.groupBy("asked").agg(F.min(F.struct("edits", "known")).alias("best")).select("asked", "best.*")
    places = known.select(F.col("full_address").alias("matched_address"), "latitude", "longitude")
    found = nearest.join(places, F.col("known") == F.col("matched_address")).select(
        F.col("asked").alias("full_address"), "matched_address", "edits", "latitude", "longitude")
    exact = known.select("full_address", F.col("full_address").alias("matched_address"), F.lit(0).alias("edits"), "latitude", "longitude")
    return keyed.join(exact.unionByName(found), "full_address", "left").withColumn("resolved", F.col("latitude").isNotNull())
