"""Packing of documents into fixed windows by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.llm import tokens
from pricebasket.llm.batches import released
from pricebasket.session import stage

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, grp long, local_id long, offset long"


class Packer:
    """Places each size into the fill level that keeps the sum of squared level counts least.

    ``open[h]`` is the number of windows filled to ``h`` (0 < h < capacity), the level array.
    Moving a window from level h to h+s changes the sum of squares by
    2*(open[h+s] - open[h]) + 2; new and full windows are not counted, so a move from level 0
    or to the full level lacks its own term. Ties go to the fullest level.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        # Level 0 and the full level are not tracked: their term of the change is 0.
        self.open = np.zeros(capacity + 1, np.float64)
        self.open[0] = self.open[capacity] = -0.5
        self.windows: dict[int, list[int]] = {}
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window of this item and the fill at which it begins."""
        capacity, count = self.capacity, self.open
        if size == capacity:
            self.made += 1
            return self.made - 1, 0
        last = capacity - size
        change = count[size : capacity + 1] - np.where(count[: last + 1] == 0, -np.inf, count[: last + 1])
        change[0] = count[size] - 0.5  # a new window has no level to leave
        level = last - int(np.argmin(change[::-1]))
        if level == 0:
            window = self.made
            self.made += 1
        else:
            window = self.windows[level].pop()
            count[level] -= 1
        if level + size < capacity:
            self.windows.setdefault(level + size, []).append(window)
            count[level + size] += 1
        return window, level


def cut(docs: DataFrame, capacity: int, end: int, tokenizer: str) -> DataFrame:
    """One row per piece: full windows from a document's start on, then what is left of it."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            every = tokens.encoded(tokenizer, batch["text"].tolist(), end)
            for doc_id, ids in zip(batch["doc_id"].tolist(), every):
                ids = ids.astype("<u4")
                for start in range(0, ids.size, capacity):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, start, part.size, zlib.crc32(part), ids.size))
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(released(pieces), PIECES)


def pack(
    docs: DataFrame, capacity: int = 4096, end: int = 2, tokenizer: str | None = None, group_pieces: int = 16_384
) -> DataFrame:
    """Place all documents of ``docs`` (doc_id, text) into windows of ``capacity`` token ids.

    Result, one row per piece: doc_id, start (ids of the document before it), length,
    ids_crc32 (over little-endian unsigned 32-bit ids), doc_tokens, sequence_id (gapless),
    offset (fill of the window before it).

    Texts are encoded whole, once, where they are read; only rows of some 50 bytes per piece are
    shuffled. Pieces are dealt by a hash into groups of about ``group_pieces``; a task streams its
    groups through one level array each and holds only the open windows of a group, so the
    work spreads over as many tasks as there are groups, and no document or key makes one large.

    A null or empty text is a document of the end id alone; rows with a null or repeated doc_id are
    separate documents; an empty table gives no rows; other columns are ignored. Ties between
    levels go to the fullest.
    """
    tokenizer = tokenizer or tokens.default_path()
    numbered = stage(
        cut(docs, capacity, end, tokenizer).withColumn("piece", F.monotonically_increasing_id()), "pieces"
    )
    groups = max(1, -(-numbered.count() // group_pieces))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, current = Packer(capacity), None
        for batch in batches:
            window, offset = [], []
            for group, size in zip(batch["grp"].tolist(), batch["length"].tolist()):
                if group != current:
                    packer, current = Packer(capacity), group
                at = packer.place(size)
                window.append(at[0])
                offset.append(at[1])
            yield batch.drop(columns="piece").assign(local_id=window, offset=offset).astype({"doc_id": "Int64"})

    dealt = (
        numbered.withColumn("grp", F.pmod(F.xxhash64("piece"), F.lit(groups)))
        .repartition(groups, "grp")
        .sortWithinPartitions("grp", "piece")
    )
    placed = stage(dealt.mapInPandas(released(place), PACKED), "packed")
    return _numbered(placed).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """Number the windows of all groups in one row; the window runs over one row per group."""
    earlier = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        placed.groupBy("grp").agg((F.max("local_id") + 1).alias("made"))
        .select("grp", F.coalesce(F.sum("made").over(earlier), F.lit(0)).alias("base"))
    )
    return placed.join(bases, "grp").withColumn("sequence_id", F.col("base") + F.col("local_id"))
