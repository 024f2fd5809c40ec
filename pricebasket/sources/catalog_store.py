"""A catalogue that takes in days one by one and reads only what a day touches.

What the catalogue needs of all raw rows is kept as partials that merge: per product, chain and store the
last price with its ``seq``, and per product the first sighting. Tables lie in folders by a hash of their key:

* ``partials``, ``products`` (a row per exact name, with its first sighting) and ``multi`` (catalogue rows of products
  that several chains price) by name;
* ``singles`` (prices of products that one chain has) and ``merged`` (their catalogue rows, merged by id) by id.

A day's partials are merged into the folders of its names. Where a product of one chain came, changed or got
a second chain, the folders of its old and new id are merged again. All other folders stay as they are and
are not read. A version is a list of folders in a table of the session's catalogue, whose location is
switched in one step when all of it is written: products and stores change together, and a job
that dies before leaves the old version. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebasket.operators import consolidate
from pricebasket.session import broadcast_if_small, is_small, stage
from pricebasket.sources.files import publish_current

LONG = ("id", "name", "chain", "store_id", "price", "chains_count", "stores_count")
MANIFEST = "part STRING, bucket INT, path STRING, kind STRING"


@dataclass(frozen=True)
class Snapshot:
    """One version: for each table the folder of each bucket, and its schema."""

    spark: SparkSession
    folders: dict[tuple[str, int], str]
    kinds: dict[str, T.StructType]

    def read(self, part: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table's rows, of ``buckets`` only if given."""
        wanted = None if buckets is None else set(buckets)
        paths = [path for (name, bucket), path in sorted(self.folders.items()) if name == part and (wanted is None or bucket in wanted)]
        kind = self.kinds[part]
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def catalog(self) -> DataFrame:
        """The whole catalogue in long form."""
        return self.read("multi").unionByName(self.read("merged"))

    def stores(self) -> DataFrame:
        return self.read("stores")


def current(spark: SparkSession, table: str) -> Snapshot | None:
    """The version that ``table`` names now; one read of a row per folder, so products and stores are of one version."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.table(table).collect()
    return Snapshot(
        spark, {(row["part"], row["bucket"]): row["path"] for row in rows if row["path"]},
        {row["part"]: T.StructType.fromDDL(row["kind"]) for row in rows})


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _numbers(rows: DataFrame) -> list[int]:
    """The buckets that ``rows`` touch; at most as many numbers as there are buckets."""
    return sorted(row[0] for row in rows.select("bucket").distinct().collect())


def _partials(obs: DataFrame) -> DataFrame:
    # The last price lies beside its seq, so that a row carries one of them.
    return obs.groupBy(F.col("item_name").alias("name"), "chain", "store_id").agg(F.max(F.struct("seq", "price")).alias("last")).select(
        "name", "chain", "store_id", "last.price", F.col("last.seq").alias("last_seq"))


def _merged_partials(parts: DataFrame) -> DataFrame:
    """Partials of one key as one; ``parts`` lie by bucket already, so they are merged where they are."""
    return parts.groupBy("bucket", "name", "chain", "store_id").agg(F.max(F.struct("last_seq", "price")).alias("last")).select(
        "name", "chain", "store_id", "last.price", "last.last_seq", "bucket")


def _first_seen(obs: DataFrame) -> DataFrame:
    """When each exact name was first seen, and with which code."""
    return obs.groupBy(F.col("item_name").alias("name")).agg(F.min(F.struct("chain_rank", "seq", "item_code")).alias("first_seen"))


def _products(partials: DataFrame, firsts: DataFrame) -> DataFrame:
    """The rows of ``consolidate.products_of``, from partials and the names' first sightings."""
    counts = partials.groupBy("name", "chain").agg(F.count(F.lit(1)).alias("stores")).groupBy("name").agg(
        F.count(F.lit(1)).cast("int").alias("chains_count"), F.sum("stores").cast("int").alias("stores_count"))
    firsts = firsts.withColumnRenamed("name", "first_name")
    return counts.join(firsts, F.col("name").eqNullSafe(F.col("first_name"))).select(
        "name", "first_seen", "chains_count", "stores_count", F.col("first_seen.item_code").alias("id"))


def _of_names(rows: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """``rows`` whose name is (left_semi) or is not (left_anti) among ``names``; null is a name."""
    known = broadcast_if_small(names.select(F.col("name").alias("known_name")))
    return rows.join(known, F.col("name").eqNullSafe(F.col("known_name")), how)


def _singles(partials: DataFrame, products: DataFrame) -> DataFrame:
    """Prices of the products that one chain has and that have an id."""
    single = products.filter((F.col("chains_count") == 1) & F.col("id").isNotNull()).select(
        F.col("name").alias("single_name"), "id", F.col("first_seen").alias("born"), "stores_count")
    return partials.join(broadcast_if_small(single), F.col("name").eqNullSafe(F.col("single_name"))).select(
        "id", "name", "chain", "store_id", "price", F.col("born").alias("first_seen"), "stores_count")


def _multi(partials: DataFrame, products: DataFrame) -> DataFrame:
    several = products.filter("chains_count > 1").select(F.col("name").alias("several_name"), "id", "chains_count", "stores_count")
    return partials.join(broadcast_if_small(several), F.col("name").eqNullSafe(F.col("several_name"))).select(*LONG)


def _merged(singles: DataFrame) -> DataFrame:
    """Catalogue rows of products merged by id, from all prices of the ids' products."""
    products = singles.groupBy("id", "name").agg(
        F.min("first_seen").alias("first_seen"), F.max("stores_count").alias("stores_count"), F.lit(1).alias("chains_count"))
    kept = consolidate.merge_by_id(products).select(
        F.col("id").alias("kept_id"), "source", F.col("name").alias("listed"), "chains_count", F.col("stores_count").alias("stores"))
    same = (F.col("id") == F.col("kept_id")) & F.col("name").eqNullSafe(F.col("source"))
    return singles.drop("stores_count").join(kept, same).select(
        "id", F.col("listed").alias("name"), "chain", "store_id", "price", "chains_count", F.col("stores").alias("stores_count"))


class _Version:
    """The folders of a version in the making."""

    def __init__(self, spark: SparkSession, root: str, before: Snapshot | None):
        self.spark, self.root, self.name = spark, root.rstrip("/"), uuid.uuid4().hex
        self.folders = dict(before.folders) if before else {}
        self.kinds = dict(before.kinds) if before else {}

    def write(self, part: str, rows: DataFrame, touched: Sequence[int], dealt: bool = False) -> DataFrame:
        """Replace the ``touched`` buckets of a table by ``rows``, which have a column ``bucket`` and may be ``dealt`` by it already."""
        kind = T.StructType([field for field in rows.schema if field.name != "bucket"])
        path = f"{self.root}/{part}/{self.name}"
        by_bucket = rows if dealt else rows.repartition(max(1, len(touched)), "bucket")
        by_bucket.write.partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(T.StructType([*kind, T.StructField("bucket", T.IntegerType())])).parquet(path)
        held = set(_numbers(written))
        for bucket in touched:
            self.folders.pop((part, bucket), None)
            if bucket in held:
                self.folders[part, bucket] = f"{path}/bucket={bucket}"
        self.kinds[part] = kind
        return written

    def publish(self, table: str) -> Snapshot:
        kinds = {part: ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kind) for part, kind in self.kinds.items()}
        rows = [(part, bucket, path, kinds[part]) for (part, bucket), path in sorted(self.folders.items())]
        rows += [(part, None, None, kind) for part, kind in sorted(kinds.items())]
        publish_current(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), table, f"{self.root}/versions/{self.name}")
        return Snapshot(self.spark, self.folders, self.kinds)


def add_observations(spark: SparkSession, root: str, table: str, obs: DataFrame, stores: DataFrame | None = None, buckets: int = 64) -> Snapshot:
    """Take a day's (or any) observations into the catalogue that ``table`` names, and its ``stores`` if given.

    The result equals ``consolidate.catalog`` over all observations taken in so far, in whatever order they came;
    observations taken in again change nothing. ``obs`` is read twice: pass a stored table. ``buckets`` is fixed by the first call. No observation
    still gives a version, with new stores if there are any.
    """
    before = current(spark, table)
    made = _Version(spark, root, before)
    if before is None:
        before = Snapshot(spark, {}, {})
    else:
        buckets = before.read("buckets").first()["buckets"]
    if "partials" in before.kinds:
        delta = stage(_partials(obs).withColumn("bucket", _bucket("name", buckets)), "delta")
        touched, names = _numbers(delta), stage(delta.select("name").distinct(), "names")
        kept = before.read("partials", touched).withColumn("bucket", _bucket("name", buckets))
        both = kept.unionByName(delta).repartition(max(1, len(touched)), "bucket")
        partials = made.write("partials", _merged_partials(both), touched, dealt=True)
        seen = before.read("products", touched).select("name", "first_seen").unionByName(_first_seen(obs))
        firsts = seen.groupBy("name").agg(F.min("first_seen").alias("first_seen"))
    else:
        partials = made.write("partials", _partials(obs).withColumn("bucket", _bucket("name", buckets)), range(buckets))
        touched, names = _numbers(partials), stage(partials.select("name").distinct(), "names")
        firsts = _first_seen(obs)
    products = made.write("products", _products(partials, firsts).withColumn("bucket", _bucket("name", buckets)), touched)
    # With few products a broadcast leaves the partials' files as they lie, by bucket.
    made.write("multi", _multi(partials, products).withColumn("bucket", _bucket("name", buckets)), touched, dealt=is_small(products))

    # Products of one chain: out of the folders of the ids that they had, into those of the ids that they have.
    arrived = stage(_of_names(_singles(partials.drop("bucket"), products), names, "left_semi").withColumn("bucket", _bucket("id", buckets)), "arrived")
    left = None
    if "products" in before.kinds:
        old = _of_names(before.read("products", touched), names, "left_semi")
        left = old.filter((F.col("chains_count") == 1) & F.col("id").isNotNull()).select(_bucket("id", buckets))
    moved = _numbers(arrived if left is None else arrived.select("bucket").unionByName(left))
    stay = _of_names(before.read("singles", moved), names, "left_anti") if "singles" in before.kinds else None
    singles = arrived.drop("bucket") if stay is None else stay.unionByName(arrived.drop("bucket"))
    singles = made.write("singles", singles.withColumn("bucket", _bucket("id", buckets)), moved)
    made.write("merged", _merged(singles.drop("bucket")).withColumn("bucket", _bucket("id", buckets)), moved)

    made.write("buckets", spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(0).alias("bucket")), [0])
    if stores is not None:
        made.write("stores", stores.withColumn("bucket", F.lit(0)), [0])
    return made.publish(table)


def forget_old(spark: SparkSession, root: str, table: str) -> int:
    """Delete the folders that the current version does not name, when no reader of an older one is left; how many."""
    snapshot = current(spark, table)
    if snapshot is None:
        return 0
    named = {path.rsplit("/bucket=", 1)[0].rsplit("/", 1)[1] for path in snapshot.folders.values()}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for part in snapshot.kinds:
        place = hadoop(f"{root.rstrip('/')}/{part}")
        for entry in system.listStatus(place) if system.exists(place) else []:
            if entry.getPath().getName() not in named:
                system.delete(entry.getPath(), True)
                gone += 1
    return gone
