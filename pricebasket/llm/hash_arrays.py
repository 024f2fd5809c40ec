"""Sorted arrays of 64-bit hashes with values, memory-mapped by the workers that look keys up."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm import files
from pricebasket.llm.batches import released
from pricebasket.llm.words import finalize

#: Keys in a shard of a set, about.
SET_KEYS = 2_000_000


def save(uri: str, keys: np.ndarray, values: dict[str, np.ndarray]) -> None:
    """``keys`` ascend and are distinct; a directory over their leading bits comes with them."""
    bits = max(1, int(max(keys.size, 2) - 1).bit_length() - 1)
    steps = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    starts = np.concatenate([[0], np.searchsorted(keys, steps), [keys.size]]).astype("<i8")
    files.write_arrays(uri, {"keys": keys.astype("<u8"), "starts": starts, **values})


class HashArray:
    def __init__(self, uri: str):
        self.of = files.map_arrays(uri)
        self.keys, self.starts = self.of["keys"], self.of["starts"]
        self.shift = np.uint64(64 - (self.starts.size - 1).bit_length() + 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, or -1. The directory leaves about two keys to compare."""
        found = np.full(keys.size, -1, np.int64)
        bucket = (keys >> self.shift).astype(np.int64)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], keys[left]
        while left.size:
            here = self.keys[at]
            hit = here == wanted
            found[left[hit]] = at[hit]
            at = at + 1
            go = ~hit & (here < wanted) & (at < end)
            left, at, end, wanted = left[go], at[go], end[go], wanted[go]
        return found


@lru_cache(maxsize=4096)
def opened(uri: str) -> HashArray:
    """A worker maps each file once; pages come and go as they are used."""
    return HashArray(uri)


class Sharded:
    """``shards`` (a power of two) arrays ``<stem>-<i>.bin``, by the leading bits of the hash."""

    def __init__(self, stem: str, shards: int):
        self.stem, self.shards = stem, shards
        self.shift = np.uint64(64 - (shards.bit_length() - 1)) if shards > 1 else None

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.shift).astype(np.int64) if self.shift is not None else np.zeros(keys.size, np.int64)

    def path(self, shard: int) -> str:
        return f"{self.stem}-{shard}.bin"

    def get(self, keys: np.ndarray, **defaults) -> dict[str, np.ndarray]:
        """The values of sorted distinct ``keys``, with each column's default where a key is absent."""
        found = {name: np.full(keys.size, value) for name, value in defaults.items()}
        edges = np.searchsorted(self.shard_of(keys), np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            low, high = int(edges[shard]), int(edges[shard + 1])
            array = opened(self.path(shard))
            at = array.find(keys[low:high])
            held = at >= 0
            for name, column in found.items():
                column[low:high][held] = array.of[name][at[held]]
        return found


class IdMap:
    """64-bit ids with a 64-bit value each, in sorted hash arrays. The hash of an id is one to one, so no id is taken for another."""

    def __init__(self, stem: str, shards: int):
        self.arrays = Sharded(stem, shards)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids are there, and their values."""
        keys, place = np.unique(finalize(ids.astype(np.int64).view(np.uint64)), return_inverse=True)
        found = self.arrays.get(keys, there=0, value=0)
        return found["there"][place] > 0, found["value"][place]

    def has(self, ids: np.ndarray) -> np.ndarray:
        return self.find(ids)[0]


def save_ids(ids: DataFrame, stem: str) -> IdMap:
    """Write the distinct values of the one column of ``ids`` (long, not null); tasks map what the result names."""
    return save_map(ids.toDF("id").filter(F.col("id").isNotNull()).distinct().withColumn("value", F.lit(0)), stem)


def save_map(rows: DataFrame, stem: str) -> IdMap:
    """Write ``rows`` (id, value: long; ids are distinct). Shards have about ``SET_KEYS`` ids each, whatever their number."""
    known = rows.select(F.col("id").cast("long"), F.col("value").cast("long"))
    shards = 1 << max(0, -(-known.count() // SET_KEYS) - 1).bit_length()
    found = IdMap(stem, shards)

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            keys = finalize(batch["id"].to_numpy().view(np.uint64))
            yield pd.DataFrame({"shard": found.arrays.shard_of(keys), "key": keys.view(np.int64), "value": batch["value"]})

    def write(shard: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        keys = np.concatenate([np.zeros(0, np.int64), *(part["key"] for part in parts)]).view(np.uint64)
        values = np.concatenate([np.zeros(0, np.int64), *(part["value"] for part in parts)])
        order = np.argsort(keys)
        save(found.arrays.path(shard), keys[order], {"there": np.ones(keys.size, np.int8), "value": values[order].astype("<i8")})
        return pd.DataFrame({"n": [keys.size]})

    def gathered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, []
        for batch in parts:
            for number, part in batch.groupby("shard", sort=False):
                if held and number != shard:
                    yield write(shard, held)
                    held = []
                shard = number
                held.append(part)
        if held:
            yield write(shard, held)

    dealt = known.mapInPandas(released(hashed), "shard long, key long, value long").repartition(shards, "shard").sortWithinPartitions("shard")
    written = dealt.mapInPandas(released(gathered), "n long").count()
    if written < shards:
        if written:
            raise RuntimeError("a shard of the map got no id")
        for shard in range(shards):
            write(shard, [])
    return found
