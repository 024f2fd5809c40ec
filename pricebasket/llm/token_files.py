"""Token id files with a minimal perfect hash index over document keys.

Layout below one folder:

* ``ids-<shard>.bin``: the raw ids of the shard's documents behind one another, as little-endian
  unsigned integers of 2 bytes (4, if the vocabulary needs them); no header, no separators.
* ``index-<bucket>.bin``: for the keys of one hash bucket a minimal perfect hash and, by its slot,
  the key's fingerprint, shard, offset, length and running start.
* ``manifest.json``: number format, ids per shard, first id number of each shard, buckets.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket.llm import files, tokens
from pricebasket.llm.batches import released
from pricebasket.session import new_dir, stage

SPOTS = "doc_id long, shard int, offset long, n_tokens long"
GAMMA = 1.5


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer (splitmix64) of keys under a seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps n distinct 64-bit keys to 0..n-1: at each level, keys alone at their bit stay there.

    A key's slot is the number of set bits before its own bit, found by counts per 64-bit word,
    so a lookup costs one probe per level and about 1.5 levels on average.
    """

    def __init__(self, bits: np.ndarray, starts: np.ndarray):
        self.bits, self.starts = bits, starts  # words of all levels; first word of each level
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words, starts, level = [], [0], 0
        while keys.size:
            size = -(-int(keys.size * GAMMA + 1) // 64)
            spot = mix(keys, level + 1) % np.uint64(size * 64)
            alone = np.bincount(spot.astype(np.int64), minlength=size * 64) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            starts.append(starts[-1] + size)
            keys, level = keys[~alone[spot.astype(np.int64)]], level + 1
        return cls(np.concatenate(words) if words else np.zeros(0, "<u8"), np.array(starts, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; a key that was not indexed gets any slot, or -1."""
        found = np.full(keys.size, -1, np.int64)
        left = np.arange(keys.size)
        for level in range(self.starts.size - 1):
            first, size = int(self.starts[level]), int(self.starts[level + 1] - self.starts[level])
            spot = (mix(keys[left], level + 1) % np.uint64(size * 64)).astype(np.int64)
            word, bit = first + spot // 64, (spot % 64).astype(np.uint64)
            here = self.bits[word]
            hit = (here >> bit) & np.uint64(1) == 1
            below = here[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[left[hit]] = self.ranks[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class Index:
    """One bucket's index file: slot by perfect hash, checked by fingerprint, then a span of entries."""

    def __init__(self, uri: str):
        self.of = files.map_arrays(uri)
        self.hash = PerfectHash(self.of["bits"], self.of["levels"])

    @staticmethod
    def write(uri: str, keys: np.ndarray, entries: dict[str, np.ndarray]) -> None:
        """``keys`` are sorted and may repeat; ``entries`` has a row for each, in the order of the file."""
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        made = PerfectHash.build(distinct)
        slots = made.slots(distinct)
        by_slot = np.argsort(slots)
        files.write_arrays(uri, {
            "bits": made.bits, "levels": made.starts, "prints": fingerprint(distinct[by_slot]),
            "first": first[by_slot].astype("<u4"), "count": count[by_slot].astype("<u4"), **entries,
        })

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the first of its entries and their number (0: not in the index)."""
        slots = self.hash.slots(keys)
        if not self.of["prints"].size:
            return np.zeros(keys.size, np.int64), np.zeros(keys.size, np.int64)
        held = (slots >= 0) & (self.of["prints"][slots] == fingerprint(keys))
        return self.of["first"][slots].astype(np.int64), np.where(held, self.of["count"][slots], 0).astype(np.int64)


def write(
    docs: DataFrame, folder: str, end: int = 1, tokenizer: str | None = None,
    shards: int | None = None, bucket_keys: int = 100_000,
) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write ids and index below ``folder``.

    Documents lie in ascending doc_id order over the shards (null first; rows that share a doc_id in
    the order of their texts' hashes). A null or empty text is its end id alone. An empty table
    gives a manifest without ids. Other columns are ignored. Texts are shuffled once, by range of
    doc_id, and a task streams its range into one file; of the ids only their places are
    shuffled again. Index buckets hold about ``bucket_keys`` keys whatever the number of
    documents. Files appear by an atomic rename, so a task that runs twice does no harm.
    """
    spark, tokenizer = docs.sparkSession, tokenizer or tokens.default_path()
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = tokens.encoder(tokenizer).dtype

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, at = TaskContext.get().partitionId(), 0
        with files.writer(f"{folder}/ids-{shard}.bin") as out:
            for batch in batches:
                sizes = np.zeros(len(batch), np.int64)
                for row, ids in enumerate(tokens.encoded(tokenizer, batch["text"].tolist(), end)):
                    out.write(ids.tobytes())
                    sizes[row] = ids.size
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64"), "shard": shard,
                    "offset": at + np.cumsum(sizes) - sizes, "n_tokens": sizes,
                })
                at += int(sizes.sum())

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    spots = stage(ranged.mapInPandas(released(encode), SPOTS), "spots")

    # One row per shard comes to the driver.
    held = sorted((r["shard"], r["ids"], r["docs"]) for r in spots.groupBy("shard").agg(
        F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("docs")).collect())
    bases, before = {}, 0
    for shard, ids, _ in held:
        bases[shard] = before
        before += ids
    buckets = max(1, -(-sum(n for *_, n in held) // bucket_keys))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One bucket at a time; rows of a bucket come together, sorted by key and place."""
        bucket, parts = None, []
        for batch in batches:
            for number, part in batch.groupby("bucket", sort=False):
                if parts and number != bucket:
                    yield save(bucket, parts)
                    parts = []
                bucket = number
                parts.append(part)
        if parts:
            yield save(bucket, parts)

    def save(bucket: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(parts)
        shard = part["shard"].to_numpy()
        start = part["offset"].to_numpy() + np.array([bases[each] for each in shard.tolist()], np.int64)
        Index.write(f"{folder}/index-{bucket}.bin", part["key"].to_numpy().view(np.uint64), {
            "shard": shard.astype("<u4"), "offset": part["offset"].to_numpy("<i8"),
            "length": part["n_tokens"].to_numpy("<i8"), "start": start.astype("<i8"),
        })
        return pd.DataFrame({"bucket": [bucket], "n": [len(part)]})

    keyed = _buckets(spots, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket", "key", "shard", "offset")
    indexed = keyed.mapInPandas(index, "bucket long, n long").agg(F.sum("n")).first()[0] or 0
    if indexed != sum(n for *_, n in held):
        raise RuntimeError(f"the index holds {indexed} of {sum(n for *_, n in held)} documents")
    manifest = {"ids": wide.str, "buckets": buckets, "shards": [[s, bases[s], ids] for s, ids, _ in held]}
    with files.writer(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())


def _buckets(keys: DataFrame, buckets: int) -> DataFrame:
    """xxhash64 maps one 64-bit number to one 64-bit number without collisions."""
    return keys.withColumn("key", F.xxhash64("doc_id")).withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)))


def manifest(folder: str) -> dict:
    return json.loads(files.mapped(f"{folder}/manifest.json").tobytes())


def get(folder: str, keys: np.ndarray) -> list[list[np.ndarray]]:
    """The id arrays of documents by 64-bit key (as Spark's xxhash64 of the doc_id); [] where absent."""
    about = manifest(folder)
    found: list[list[np.ndarray]] = [[] for _ in keys]
    for i, key in enumerate(np.asarray(keys, np.int64)):
        index = Index(f"{folder}/index-{int(key) % about['buckets']}.bin")
        first, count = (int(x[0]) for x in index.find(np.array([key]).view(np.uint64)))
        for entry in range(first, first + count):
            payload = files.mapped(f"{folder}/ids-{index.of['shard'][entry]}.bin").view(about["ids"])
            at = int(index.of["offset"][entry])
            found[i].append(payload[at : at + int(index.of["length"][entry])])
    return found


def read(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Look the distinct doc_ids of ``keys`` up and read their ids back from the files.

    Result, a row per document found: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (over little-endian unsigned 32-bit ids). A task opens one index bucket at a time for
    the lookups and one shard at a time for the ids.
    """
    about = manifest(folder)
    kind = np.dtype(about["ids"])

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, index = None, None
        for batch in batches:
            for number, part in batch.groupby("bucket", sort=False):
                if number != bucket:
                    bucket, index = number, Index(f"{folder}/index-{number}.bin")
                first, count = index.find(part["key"].to_numpy().view(np.uint64))
                entry = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                yield pd.DataFrame({
                    "doc_id": np.repeat(part["doc_id"].astype("Int64").array, count),
                    **{name: index.of[name][entry].astype(np.int64) for name in ("shard", "offset", "length", "start")},
                })

    def payloads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, ids = None, None
        for batch in batches:
            sums = []
            for number, at, size in zip(batch["shard"].tolist(), batch["offset"].tolist(), batch["length"].tolist()):
                if number != shard:
                    shard, ids = number, files.mapped(f"{folder}/ids-{number}.bin").view(kind)
                sums.append(zlib.crc32(ids[at : at + size].astype("<u4")))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "start": batch["start"],
                "n_tokens": batch["length"], "ids_crc32": np.array(sums, np.int64),
            })

    if not about["shards"]:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    distinct = _buckets(keys.select(F.col("doc_id").cast("long")).distinct(), about["buckets"])
    spots = distinct.repartition(about["buckets"], "bucket").sortWithinPartitions("bucket").mapInPandas(
        look_up, "doc_id long, shard long, offset long, length long, start long")
    by_shard = spots.repartition(len(about["shards"]), "shard").sortWithinPartitions("shard", "offset")
    return by_shard.mapInPandas(payloads, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write the files in the shared folder and read every document back through the index."""
    folder = new_dir(docs.sparkSession, "token-files")
    write(docs, folder, **options)
    return read(docs.sparkSession, folder, docs)
