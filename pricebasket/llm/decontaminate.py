"""Documents that hold an item of a benchmark, with up to a fifth of its words edited.

Windows of an item's number of words are embedded by the random walk of Chakraborty, Goldenberg and Koucky:
step j puts out the word at the pointer and a random bit of (step, word) says whether the pointer moves
on. Equal texts have equal walks, and walks of texts that differ by an edit meet again soon, so a small edit
distance becomes a small Hamming distance. Tables that each sample a few steps of a walk of their
own (bit-sampling) bring similar windows and items to equal keys; alignments confirm.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm import batches, files
from pricebasket.llm.words import Words, pair
from pricebasket.session import new_dir, stage

#: Tables, and the steps that each samples. Measured recall is in the README.
TABLES, SAMPLES = 32, 2
#: Items and characters of items in a block, about.
ITEMS, CHARS = 20_000, 16 << 20


def table_keys(words: np.ndarray, tables: int, samples: int) -> np.ndarray:
    """Keys (tables x rows) of rows with equally many words: what each table's walk puts out at its sampled steps.

    The steps lie in the first two per word: later on, most walks have ended and agree in that alone.
    """
    rows, size = words.shape
    rng = np.random.default_rng(size)
    steps = np.stack([rng.choice(2 * size, samples, replace=False) for _ in range(tables)])
    odd = rng.integers(0, 1 << 63, (2 * size, tables, 1), dtype=np.uint64) | np.uint64(1)
    padded = np.concatenate([words, np.zeros((rows, 1), np.uint64)], axis=1).reshape(-1)
    line = np.arange(rows) * (size + 1)
    pointer = np.zeros((tables, rows), np.int64)
    key = np.repeat(np.arange(tables, dtype=np.uint64)[:, None], rows, axis=1)
    for step in range(int(steps.max()) + 1):
        out = padded[line + pointer]
        for table in np.flatnonzero((steps == step).any(axis=1)).tolist():
            key[table] = pair(key[table], out[table])
        with np.errstate(over="ignore"):
            bit = (out * odd[step]) >> np.uint64(63)
        pointer = np.minimum(pointer + bit.astype(np.int64), size)
    return key


def holds(words: np.ndarray, item: np.ndarray, most: int) -> bool:
    """Whether some run of ``words``, of any length, has an edit distance of ``most`` or less from ``item``."""
    words = words.tolist()
    last = [0] * (len(words) + 1)
    for i, word in enumerate(item.tolist(), 1):
        now = [i]
        for j, other in enumerate(words, 1):
            now.append(last[j - 1] if word == other else 1 + min(last[j - 1], last[j], now[j - 1]))
        if min(now) > most:
            return False
        last = now
    return min(last) <= most


def compiled(items: list[tuple[int, str | None]], percent: int, least: int, tables: int, samples: int) -> dict[str, np.ndarray]:
    """The items of a benchmark as named arrays: words, bounds on edits, table keys by number of words, segments by length.

    An item of n words that may have k edits is cut into k + 1 segments, one of which k edits leave whole.
    Items of fewer than ``least`` words may have none.
    """
    of = Words([(text or "").lower() for _, text in items])
    n = np.diff(of.bounds)
    most = np.where(n < least, 0, n * (100 - percent) // 100)
    found = {"numbers": np.array([number for number, _ in items], np.int64), "words": of.hashes,
             "bounds": of.bounds.astype(np.int64), "most": most.astype(np.int64)}
    segments: dict[int, list[tuple[int, int, int]]] = {}
    for size in (size for size in np.unique(n).tolist() if size):
        rows = np.flatnonzero(n == size)
        keys = table_keys(of.hashes[of.bounds[rows][:, None] + np.arange(size)], tables, samples)
        order = np.argsort(keys, axis=1)
        found[f"keys-{size}"] = np.take_along_axis(keys, order, 1).reshape(-1)
        found[f"rows-{size}"] = rows[order].reshape(-1)
        edits = int(most[rows[0]])
        length = size // (edits + 1)
        for row in rows.tolist():
            whole = grams(of.hashes[of.bounds[row] : of.bounds[row + 1]], length)
            segments.setdefault(length, []).extend((int(whole[k * length]), row, k * length) for k in range(edits + 1))
    for length, every in segments.items():
        every.sort()
        found[f"segments-{length}"] = np.array([h for h, *_ in every], np.uint64)
        found[f"row-{length}"] = np.array([row for _, row, _ in every], np.int64)
        found[f"offset-{length}"] = np.array([offset for *_, offset in every], np.int64)
    return found


class Items:
    """Finds the items whose arrays `compiled` made.

    Only windows around a whole segment are embedded, which passes over nothing that is within the bound. Which items a
    window is compared with, the tables alone say: those that share a key with it. Such an item is confirmed by
    an alignment with the words around the window, so that the passage may be longer or shorter than the item.
    """

    def __init__(self, arrays: dict[str, np.ndarray], tables: int, samples: int):
        self.numbers, self.words, self.bounds, self.most = (arrays[name] for name in ("numbers", "words", "bounds", "most"))
        self.sizes, self.tables, self.samples = np.diff(self.bounds), tables, samples
        self.keys, self.segments = {}, {}
        for name in arrays:
            kind, _, number = name.partition("-")
            if kind == "keys":
                self.keys[int(number)] = arrays[name].reshape(tables, -1), arrays[f"rows-{number}"].reshape(tables, -1)
            elif kind == "segments":
                first = np.zeros(1 << 16, bool)
                first[(arrays[name] >> np.uint64(48)).astype(np.int64)] = True
                self.segments[int(number)] = arrays[name], arrays[f"row-{number}"], arrays[f"offset-{number}"], first

    def found(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the ascending numbers of the items it holds."""
        of = Words([(text or "").lower() for text in texts])
        hits: list[set[int]] = [set() for _ in texts]
        tried: dict[tuple[int, int], list[int]] = {}
        for size, text, start in self._windows(of, np.repeat(np.arange(len(texts)), np.diff(of.bounds))):
            for window, item in self._alike(of, size, text, start):
                self._confirm(of, item, text[window], start[window], hits, tried)
        return [sorted(each) for each in hits]

    def _windows(self, of: Words, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Distinct windows (text, start) of one size around whole segments, some at a time.

        A window may reach over the ends of its text by as many words as the item may have edits.
        """
        for length, (hashes, rows, offsets, first) in self.segments.items():
            if of.hashes.size < length:
                continue
            every = grams(of.hashes, length)
            at = np.flatnonzero(first[(every >> np.uint64(48)).astype(np.int64)])
            at = at[doc[at] == doc[at + length - 1]]
            low, high = np.searchsorted(hashes, every[at], "left"), np.searchsorted(hashes, every[at], "right")
            at, low, number = at[high > low], low[high > low], (high - low)[high > low]
            for some in runs(number):
                place, about = np.repeat(at[some], number[some]), laid_out(low[some], number[some])
                row = rows[about]
                seeds = np.unique(np.stack([self.sizes[row], self.most[row], doc[place], place - offsets[about]]), axis=1)
                for part in runs(2 * seeds[1] + 1):
                    size, most, text, base = seeds[:, part]
                    spread = 2 * most + 1
                    start, text = laid_out(base - most, spread), np.repeat(text, spread)
                    most, size = np.repeat(most, spread), np.repeat(size, spread)
                    held = np.minimum(start + size, of.bounds[text + 1]) - np.maximum(start, of.bounds[text])
                    size, text, start = np.unique(np.stack([size, text, start])[:, held >= size - most], axis=1)
                    for each in np.unique(size).tolist():
                        yield each, text[size == each], start[size == each]

    def _alike(self, of: Words, size: int, text: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """(windows, item): windows that share a key with an item of their size in some table."""
        keys, rows = self.keys[size]
        for begin in range(0, start.size, 5_000):
            own = table_keys(around(of, text[begin : begin + 5_000], start[begin : begin + 5_000], size), self.tables, self.samples)
            for table in range(self.tables):
                low, high = np.searchsorted(keys[table], own[table], "left"), np.searchsorted(keys[table], own[table], "right")
                some = np.flatnonzero(high > low)
                number = (high - low)[some]
                for part in runs(number):
                    window = np.repeat(some[part], number[part])
                    item = rows[table][laid_out(low[some[part]], number[part])]
                    order = np.argsort(item, kind="stable")
                    edges = np.flatnonzero(np.diff(item[order], prepend=-1, append=-1))
                    for a, b in zip(edges[:-1], edges[1:]):
                        yield begin + window[order[a:b]], int(item[order[a]])

    def _confirm(self, of: Words, row: int, text: np.ndarray, start: np.ndarray, hits: list[set[int]], tried: dict) -> None:
        """Align the item with the words around each window, 2 k more on both sides.

        So a window that lies at most k words from one that was tried holds nothing new.
        """
        item, most, number = self.words[self.bounds[row] : self.bounds[row + 1]], int(self.most[row]), int(self.numbers[row])
        new = [k for k, (t, s) in enumerate(zip(text.tolist(), start.tolist()))
               if number not in hits[t] and not any(abs(s - other) <= most for other in tried.get((t, row), ()))]
        if not new:
            return
        text, start = text[new], start[new]
        words = around(of, text, start - 2 * most, item.size + 4 * most)
        own = np.sort(item)
        same = (own[np.minimum(np.searchsorted(own, words), own.size - 1)] == words).sum(axis=1) >= item.size - most
        for k, (t, s) in enumerate(zip(text.tolist(), start.tolist())):
            before = tried.setdefault((t, row), [])
            if number in hits[t] or any(abs(s - other) <= most for other in before):
                continue
            before.append(s)
            if same[k] and holds(words[k][words[k] != 0], item, most):
                hits[t].add(number)


def around(of: Words, text: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """``size`` words from each start on, 0 where they lie outside of the text."""
    at = start[:, None] + np.arange(size)
    inside = (at >= of.bounds[text][:, None]) & (at < of.bounds[text + 1][:, None])
    return np.where(inside, of.hashes[np.where(inside, at, 0)], np.uint64(0))


def laid_out(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """``number`` ascending integers from each first one on."""
    return np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())


def runs(number: np.ndarray, most: int = 200_000) -> Iterator[slice]:
    """Slices whose numbers add up to about ``most``, one at least."""
    group = np.cumsum(number) // most
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    return (slice(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:]))


def grams(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` words from each on that has so many."""
    found = words[: words.size - length + 1]
    for step in range(1, length):
        found = pair(found, words[step : words.size - length + 1 + step])
    return found


@lru_cache(maxsize=64)
def opened(uri: str, tables: int, samples: int) -> Items:
    """A worker maps each block of items once."""
    return Items(files.map_arrays(uri), tables, samples)


def with_items(
    docs: DataFrame, benchmark: DataFrame, percent: int = 80, least: int = 8, tables: int = TABLES, samples: int = SAMPLES,
    items: int = ITEMS, chars: int = CHARS, drop: tuple[str, ...] = (),
) -> DataFrame:
    """All columns of ``docs`` but ``drop``, with item_ids and contaminated (see `decontaminate`)."""
    listed = stage(benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id"), F.col("text").cast("string")).filter(
        "text is not null").distinct(), "items")
    size = listed.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    blocks = max(1, -(-size[0] // items), -(-(size[1] or 0) // chars))
    folder = new_dir(docs.sparkSession, "benchmark")

    def save(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held = None, []
        for batch in parts:
            for number, part in batch.groupby("block", sort=False):
                if held and number != block:
                    yield write(block, held)
                    held = []
                block = number
                held.append(part)
        if held:
            yield write(block, held)

    def write(block: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        own = sorted((item_id, text) for part in parts for item_id, text in zip(part["item_id"].tolist(), part["text"]))
        files.write_arrays(f"{folder}/items-{block}.bin", compiled(own, percent, least, tables, samples))
        return pd.DataFrame({"block": [block]})

    dealt = listed.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks))).repartition(blocks, "block").sortWithinPartitions("block")
    # A number a block is gathered, no item.
    written = sorted(r["block"] for r in dealt.mapInPandas(batches.released(save), "block long").collect())

    def search(texts: list[str | None]) -> dict:
        found: list[set[int]] = [set() for _ in texts]
        for block in written:
            for held, more in zip(found, opened(f"{folder}/items-{block}.bin", tables, samples).found(texts)):
                held.update(more)
        return {"item_ids": [sorted(each) for each in found]}

    return batches.with_columns(docs, ["text"], search, "item_ids array<long>", drop).withColumn("contaminated", F.size("item_ids") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Find the ``benchmark`` items (item_id, text) that every whole text of ``docs`` (doc_id, text) holds.

    A text holds an item of n words if some run of its words, of any length, has a word edit distance of n * (100 -
    ``percent``) / 100, rounded down, or less from it; items of fewer than ``least`` words must stand there word for
    word. Words are split at blanks and lower-cased. What is found is confirmed exactly; an unedited
    item is always found, one with the most edits by the recall of the tables (README). Result, one
    row per input row: doc_id, item_ids (ascending), n_items, contaminated, kept (the opposite).

    Only texts are searched: nothing of them is shuffled. Items are written by tasks, in blocks of bounded number and
    text, as sorted arrays that the searching tasks map. Null items and ones without words are not
    looked for; a null item_id is -1; equal rows of the benchmark are one. A null or empty text holds
    nothing. Rows with a null or repeated doc_id are searched each on its own.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_items(rows, benchmark, drop=("text",), **options).select(
        "doc_id", "item_ids", F.size("item_ids").cast("long").alias("n_items"), "contaminated", (~F.col("contaminated")).alias("kept"))
