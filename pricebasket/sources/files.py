"""Readers and writers of price files, store files, snapshots and listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket import constants, schemas
from pricebasket.functions import text
from pricebasket.operators.stores import parse_file_name
from pricebasket.session import few_listing_tasks

# Root and repeated element of each chain's price file.
PRICE_TAGS = {
    "victory": ("Prices", "Product"),
    "shufersal": ("root", "Item"),
    "ramilevi": ("Root", "Item"),
}
# Repeated element and text encoding of each chain's store file.
STORE_TAGS = {
    "victory": ("Branch", "UTF-8"),
    "shufersal": ("STORE", "UTF-8"),
    "ramilevi": ("Store", "UTF-16"),
}
STORE_FIELDS = {
    "victory": "StoreID STRING, StoreName STRING, Address STRING, City STRING",
    "shufersal": "STOREID STRING, STORENAME STRING, ADDRESS STRING, CITY STRING",
    "ramilevi": "StoreId STRING, StoreName STRING, Address STRING, City STRING",
}
ITEM_FIELDS = "ItemCode STRING, ItemName STRING, ItemPrice STRING, PriceUpdateDate STRING"

# Hadoop's settings for a writer of very many small files; they mean nothing to other stores than a local disk.
PLAIN_LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def price_file_paths(spark: SparkSession, folder: str, allowed: list[str] | None = None) -> list[str]:
    """Paths to read for a day: the newest full price file of each store, of allowed stores if given.

    Only the listing is looked at. The result holds one path per store; `1` and `001` are one
    store, and of files with one stamp the last by path is taken.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select("path", F.regexp_extract("path", r"PriceFull\d+-\d+-\d+", 0).alias("file_name"))
        .filter(F.col("file_name") != "")
        .withColumn("parsed", parse_file_name(F.col("file_name")))
    )
    if allowed is not None:
        listing = listing.filter(text.zero_padded(F.col("parsed.store_id")).isin(allowed))
    store = text.zero_padded(F.col("parsed.store_id"))
    newest = listing.groupBy("parsed.chain_id", store).agg(F.max_by("path", F.struct("parsed.stamp", "path")).alias("path"))
    return sorted(row["path"] for row in newest.collect())


def read_price_files(spark: SparkSession, path: str | list[str], chain: str, pulling_date: str) -> DataFrame:
    """Price observations from one chain's XML price files (``.gz`` is unpacked).

    Every repeated item element is a row, so a file is streamed and never held whole, and a
    file with one item needs no care. Only the four used elements are parsed. Chain and store
    come from the file's name, ``PriceFull<chain>-<store>-<stamp>``; a file of another name ends
    the job, as its rows would belong to no store. ``seq`` is the place of the item: file, then
    order within it.
    """
    with few_listing_tasks(spark):
        found = spark.read.format("xml").schema(ITEM_FIELDS).option("rowTag", PRICE_TAGS[chain][1]).option("recursiveFileLookup", "true").load(path)
    items = found.select("*", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("place"))
    name = parse_file_name(F.regexp_extract("file_path", r"PriceFull\d+-\d+-\d+", 0))
    unknown = F.raise_error(F.concat(F.lit("no price file's name: "), F.col("file_path")))
    return items.withColumn("file", name).withColumn(
        "file", F.when(F.col("file.store_id") != "", F.col("file")).otherwise(unknown.cast(items.select(name.alias("n")).schema["n"].dataType))
    ).select(
        F.lit(chain).alias("chain"),
        F.lit(constants.CHAINS.index(chain)).alias("chain_rank"),
        F.col("file.chain_id").alias("chain_id"),
        text.zero_padded(F.col("file.store_id")).alias("store_id"),
        text.blank_to_null(F.col("ItemCode")).alias("item_code"),
        text.blank_to_null(F.col("ItemName")).alias("item_name"),
        text.blank_to_null(F.col("ItemPrice")).try_cast(schemas.PRICE).alias("price"),
        text.date_part(F.col("PriceUpdateDate")).alias("price_update_date"),
        F.lit(pulling_date).cast("date").alias("pulling_date"),
        F.struct(F.col("file.stamp").alias("stamp"), "file_path", "place").alias("seq"),
    )


def missing_stores(obs: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (chain, store_id) without any observation: a file that was empty or never came."""
    return expected.select("chain", "store_id").join(
        obs.select("chain", "store_id").distinct(), ["chain", "store_id"], "left_anti"
    )


def newest_store_files(spark: SparkSession, folder: str) -> list[str]:
    """The newest ``Stores<chain>-<number>-<stamp>`` file of each chain in a folder; the folder if it has none such."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select("path", parse_file_name(F.regexp_extract("path", r"Stores[A-Za-z]*\d+-\d+-\d+", 0)).alias("parsed"))
        .filter(F.col("parsed.stamp") != "")
    )
    newest = listing.groupBy("parsed.chain_id").agg(F.max_by("path", F.struct("parsed.stamp", "path")).alias("path"))
    return sorted(row["path"] for row in newest.collect()) or [folder]


def read_store_files(spark: SparkSession, path: str | list[str], chain: str) -> DataFrame:
    """One chain's store rows under the file's own column names."""
    row_tag, encoding = STORE_TAGS[chain]
    return (
        spark.read.format("xml")
        .schema(STORE_FIELDS[chain])
        .option("rowTag", row_tag)
        .option("encoding", encoding)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def write_xml(rows: DataFrame, path: str, root_tag: str, row_tag: str, encoding: str = "UTF-8", partition: str | None = None) -> None:
    """Write rows as XML elements; with ``partition``, one folder per value of that column.

    Rows of one folder are brought together first so that few files result; the rebalance
    splits a folder that holds very many rows. On a local disk files are written without side
    files of checksums (gzip holds one of its own): with them Hadoop starts four processes for each file.
    """
    if partition:
        rows = rows.hint("rebalance", partition)
    writer = (
        rows.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).option("encoding", encoding)
        .option("declaration", f"version='1.0' encoding='{encoding}'")
    )
    if partition:
        writer = writer.options(**PLAIN_LOCAL_FILES).option("compression", "gzip").partitionBy(partition)
    writer.save(path)


def read_daily_json(spark: SparkSession, path: str, one_array_per_file: bool = False) -> DataFrame:
    """Published catalogue rows from JSON snapshots.

    JSON lines are read in splits; ``one_array_per_file`` takes files that are one JSON array,
    each of which is one task's work.
    """
    return spark.read.schema(schemas.PRODUCT_MESSAGE).option("multiLine", str(one_array_per_file).lower()).json(path)


def read_requests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored shopping requests, by a fixed schema rather than one inferred from the rows."""
    return spark.read.schema(schemas.STORED_REQUEST).format(fmt).load(path)


def write_snapshot(rows: DataFrame, path: str, fmt: str = "parquet", day: str = "pulling_date") -> None:
    """Write a folder per day; days present in ``rows`` are replaced, all others kept."""
    (
        rows.hint("rebalance", day)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .save(path)
    )


def publish_current(rows: DataFrame, name: str, path: str) -> DataFrame:
    """Full refresh of a current table: write a fresh version at ``path``, then point ``name`` at it.

    ``name`` is a table of the catalogue, which all sessions see; its location moves in one step.
    Readers see the old version until the new one is complete, never an empty table. Only where columns or
    their types change is the old table taken away just before the new one is made.
    """
    spark = rows.sparkSession
    rows.write.parquet(path)
    kinds = [(field.name, field.dataType) for field in rows.schema]
    if spark.catalog.tableExists(name) and [(field.name, field.dataType) for field in spark.table(name).schema] != kinds:
        spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema)
    return spark.table(name)


def json_messages(rows: DataFrame) -> DataFrame:
    """One JSON message per row in ``value``, the column a Kafka sink sends."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def send_messages(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    """Write ``value`` rows to Kafka, to ``topic`` or to each row's ``topic`` column. Needs the connector."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    writer.save()


# Character references that targets hold; the ampersand last, so that no text is decoded twice.
REFERENCES = {"&quot;": '"', "&#39;": "'", "&apos;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def links(html: Column) -> Column:
    """Targets of a page's anchors, in order, whatever the case, order and quotes of their attributes."""
    quoted = r"""[^>"']++|"[^"]*+"|'[^']*+'"""
    anchors = F.regexp_extract_all(html, F.lit(rf"(?is)<a(?=\s)((?:{quoted})*+)>"), F.lit(1))
    target = r"""(?is)^(?:[^"'\s]++|\s++(?!href\s*=)|"[^"]*+"|'[^']*+')*+\s*href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def decoded(attributes: Column) -> Column:
        value = F.concat(*(F.regexp_extract(attributes, target, group) for group in (1, 2, 3)))
        for reference, character in REFERENCES.items():
            value = F.replace(value, F.lit(reference), F.lit(character))
        return value

    return F.transform(F.filter(anchors, lambda attributes: attributes.rlike(target)), decoded)


def listing_links(pages: DataFrame, wanted: str = "PriceFull") -> DataFrame:
    """One row per anchor of each page: its target and whether it is a wanted file's link."""
    return pages.select("page_id", F.posexplode(links(F.col("html"))).alias("pos", "href")).withColumn(
        "wanted", F.col("href").contains(wanted)
    )


def last_page(html: Column) -> Column:
    """Number of the last listing page: the tail of the ``>>`` anchor's target; null without one."""
    number = F.regexp_extract(html, r"""(?i)<a\s[^>]*href\s*=\s*["']?[^"'>]*=(\d+)["']?[^>]*>\s*(?:>>|&gt;&gt;)""", 1)
    return number.try_cast("int")
