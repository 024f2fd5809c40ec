"""The highest-scoring documents of each item of a query set, by buckets of impact vectors of like length.

A document is the vector of its terms' impacts, restricted to terms that some query has; a query is the
set of its terms; the score is their inner product. Tasks go through documents by falling vector length,
some hundred (a bucket) at a time. Where even the longest vector times the query's length stays below the query's
k-th best score so far, the bucket is passed over (Cauchy-Schwarz). Inside a bucket, each term's largest impact
splits a query's terms: light ones, which cannot reach the score alone, and heavy ones, of which a
result must hold one. Sums over heavy terms, with what light terms can add by their largest impacts and by the rest of
the vector's length, leave few pairs; those are scored again in 64-bit integers.

Scores to beat come from a first search over the longest vectors of all. Nothing is left out: bounds only pass over what cannot be a
result. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricebasket.llm import files, hash_arrays
from pricebasket.llm.batches import blocks, released
from pricebasket.llm.words import MARKS, Words
from pricebasket.session import new_dir, stage

#: Terms of queries that are searched for at once.
BLOCK_TERMS = 500_000
#: Documents in a bucket, and partial sums held at once.
BUCKET, SUMS = 512, 1 << 22
#: Longest vectors searched first: about so many, more where lengths are equal.
FIRST = 4096
#: Steps of the histogram of lengths in a power of two.
FINE = 16
#: Relative error that bounds in floating point may have.
SLACK = 1e-9


def _hashes(texts: list[str | None]) -> Words:
    return Words(texts, between=MARKS)


def _query_terms(items: DataFrame) -> DataFrame:
    """Each distinct text of ``items`` with its distinct terms: text_key, terms (hashes)."""
    texts = items.filter(F.col("text").isNotNull()).select(F.sha2("text", 256).alias("text_key"), "text").dropDuplicates(["text_key"])

    def terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for part in blocks(batch, ["text"]):
                of = _hashes(part.column("text").to_pylist())
                found = [np.unique(of.hashes[a:b]).view(np.int64) for a, b in zip(of.bounds[:-1].tolist(), of.bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("text_key"), pa.array(found, pa.list_(pa.int64()))], names=["text_key", "terms"])

    return texts.mapInArrow(released(terms), "text_key string, terms array<long>").filter(F.size("terms") > 0)


class Queries:
    """A block of queries as tasks read them: each one's terms as places in the block's vocabulary."""

    def __init__(self, uri: str):
        self.vocabulary = hash_arrays.opened(uri)
        of = self.vocabulary.of
        self.bounds, self.places = of["bounds"], of["places"]
        self.count = self.bounds.size - 1
        self.owner = np.repeat(np.arange(self.count), np.diff(self.bounds))
        self.length = np.sqrt(np.diff(self.bounds))


@lru_cache(maxsize=2)
def _queries(uri: str) -> Queries:
    return Queries(uri)


@lru_cache(maxsize=4)
def _arrays(uri: str) -> dict[str, np.ndarray]:
    return files.map_arrays(uri)


def _write_queries(spark: SparkSession, listed: list) -> str:
    """Terms of a block of queries, in order of text_key, as a sorted hash array with their places."""
    terms = [np.array(row["terms"], np.int64).view(np.uint64) for row in listed]
    keys, places = np.unique(np.concatenate(terms), return_inverse=True)
    uri = f"{new_dir(spark, 'queries')}/queries.bin"
    bounds = np.concatenate([[0], np.cumsum([each.size for each in terms])])
    hash_arrays.save(uri, keys, {"bounds": bounds.astype("<i8"), "places": places.astype("<i4")})
    return uri


VECTOR = "doc_id long, n long, terms binary, counts binary"


def _vectors(docs: DataFrame, uri: str) -> DataFrame:
    """Each document with a term: its number of terms, and places and counts of those that queries have."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _queries(uri).vocabulary
        for batch in parts:
            for part in blocks(batch, ["text"]):
                words = _hashes(part.column("text").to_pylist())
                at = of.find(words.hashes)
                row = np.repeat(np.arange(part.num_rows), np.diff(words.bounds))
                held = at >= 0
                key, count = np.unique(row[held] * np.int64(of.keys.size) + at[held], return_counts=True)
                place, count = (key % of.keys.size).astype("<i4"), count.astype("<i4")
                edges = np.searchsorted(key, np.arange(part.num_rows + 1) * np.int64(of.keys.size)).tolist()
                n = np.diff(words.bounds)
                some = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     *(pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()) for values in (place, count))],
                    names=["doc_id", "n", "terms", "counts"])
                yield some.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull()).mapInArrow(released(read), VECTOR)


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows' binary arrays behind one another, and each one's size."""
    raw = column.to_pylist()
    flat = np.frombuffer(b"".join(raw), kind)
    return flat, np.fromiter(map(len, raw), np.int64, len(raw)) // flat.itemsize


def _frequencies(vectors: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term stands; a task sums up its own first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in parts:
            np.add.at(total, _joined(batch.column("terms"), "<i4")[0], 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "df"])

    found = np.zeros(terms, np.int64)
    # At most a number for each term of a block of queries.
    for row in vectors.select("terms").mapInArrow(released(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        found[row["term"]] = row["df"]
    return found


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


IMPACTS = "doc_id long, length double, terms binary, impacts binary"


def _impacts(vectors: DataFrame, uri: str) -> DataFrame:
    """Each vector's impacts, as 64-bit integers, and its length. ``uri`` has the weights and totals."""

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _arrays(uri)
        documents, length = (int(of[name][0]) for name in ("documents", "terms"))
        for batch in parts:
            terms, sizes = _joined(batch.column("terms"), "<i4")
            counts = _joined(batch.column("counts"), "<i4")[0].astype(np.int64)
            mean = 100 - 50 + np.array([50 * n * documents // length for n in batch.column("n").to_pylist()], np.int64)
            impact = of["weights"][terms] * (1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(mean, sizes)))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.sqrt(_sums(impact.astype(float) ** 2, ends))), batch.column("terms"),
                 pa.array([impact[a:b].astype("<i8").tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())],
                names=["doc_id", "length", "terms", "impacts"])

    return vectors.mapInArrow(released(weigh), IMPACTS)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values``; of an empty run 0."""
    found = np.zeros(ends.size - 1, values.dtype)
    held = np.flatnonzero(np.diff(ends))
    if held.size:
        found[held] = np.add.reduceat(values, ends[held])
    return found


class Search:
    """The best ``k`` documents so far of each query, and the score that others must reach."""

    def __init__(self, queries: Queries, k: int, least: np.ndarray):
        self.of, self.k = queries, k
        self.least = least.astype(np.int64).copy()
        self.query = self.score = self.id = np.zeros(0, np.int64)
        self.lost = np.zeros(0, bool)  # documents without an id come last

    def bucket(self, ids: np.ndarray, lost: np.ndarray, lengths: np.ndarray, terms: np.ndarray, sizes: np.ndarray, impacts: np.ndarray) -> None:
        """Look through documents in order of falling length; each one's terms ascend."""
        floor = np.maximum(self.least, 1).astype(float) * (1 - SLACK)
        active = np.flatnonzero(self.of.length * lengths[0] >= floor)
        if not active.size or not terms.size:
            return
        by_term = np.argsort(terms, kind="stable")
        held, first = np.unique(terms[by_term], return_index=True)
        doc = np.repeat(np.arange(ids.size), sizes)
        most = np.maximum.reduceat(impacts[by_term], first)
        sizes_of = np.diff(np.append(first, terms.size))
        # The active queries' terms that the bucket holds, light ones first.
        chosen = np.zeros(self.of.count, bool)
        chosen[active] = True
        entry = np.flatnonzero(chosen[self.of.owner])
        at = np.minimum(np.searchsorted(held, self.of.places[entry]), held.size - 1)
        there = held[at] == self.of.places[entry]
        owner, at = self.of.owner[entry][there], at[there]
        order = np.lexsort((most[at], owner))
        owner, at = owner[order], at[order]
        starts = np.searchsorted(owner, np.arange(self.of.count + 1))
        reach = np.concatenate([[0], np.cumsum(most[at])])
        light = reach[1:] - reach[starts[owner]] < floor[owner]
        lights = np.bincount(owner[light], minlength=self.of.count)
        light_most = reach[starts[:-1] + lights] - reach[starts[:-1]]
        owner, at = owner[~light], at[~light]
        # Some queries at a time, as many as keep the sums bounded.
        work = np.cumsum(np.bincount(owner, weights=sizes_of[at], minlength=self.of.count) + ids.size)
        low = 0
        while low < self.of.count:
            high = max(low + 1, int(np.searchsorted(work, (work[low - 1] if low else 0) + SUMS, "right")))
            a, b = np.searchsorted(owner, [low, high])
            if a < b:
                self._some(low, high, owner[a:b], at[a:b], first, sizes_of, by_term, doc, ids, lost, lengths, terms, impacts, sizes,
                           floor, lights, light_most)
            low = high
        self._cut()

    def _some(self, low, high, owner, at, first, sizes_of, by_term, doc, ids, lost, lengths, terms, impacts, sizes, floor, lights, light_most) -> None:
        size = sizes_of[at]
        shift = np.cumsum(size) - size
        posting = by_term[np.repeat(first[at] - shift, size) + np.arange(size.sum())]
        cell = (np.repeat(owner, size) - low) * ids.size + doc[posting]
        value = impacts[posting].astype(float)
        part = np.bincount(cell, value, (high - low) * ids.size)
        pairs = np.flatnonzero(part)
        square = np.bincount(cell, value * value, (high - low) * ids.size)[pairs]
        query, here = pairs // ids.size + low, pairs % ids.size
        rest = np.sqrt(np.maximum(lengths[here] ** 2 * (1 + SLACK) - square, 0) * lights[query])
        good = (part[pairs] + np.minimum(rest, light_most[query])) * (1 + SLACK) >= floor[query]
        query, here = query[good], here[good]
        if query.size:
            self._rescore(query, here, ids, lost, terms, impacts, sizes)

    def _rescore(self, query: np.ndarray, here: np.ndarray, ids: np.ndarray, lost: np.ndarray, terms: np.ndarray, impacts: np.ndarray, sizes: np.ndarray) -> None:
        """The pairs' scores in integers, over all terms of the query."""
        of, width = self.of, np.int64(self.of.vocabulary.keys.size)
        keys = np.append(np.repeat(np.arange(ids.size), sizes) * width + terms, np.int64(1) << 62)
        padded = np.append(impacts, 0)
        score = np.zeros(query.size, np.int64)
        step = max(1, SUMS // int(np.diff(of.bounds).max()))
        for low in range(0, query.size, step):
            some = query[low : low + step]
            size = of.bounds[some + 1] - of.bounds[some]
            ends = np.concatenate([[0], np.cumsum(size)])
            place = of.places[np.repeat(of.bounds[some] - ends[:-1], size) + np.arange(ends[-1])]
            wanted = np.repeat(here[low : low + step], size) * width + place
            at = np.searchsorted(keys, wanted)
            score[low : low + step] = _sums(np.where(keys[at] == wanted, padded[at], 0), ends)
        good = (score > 0) & (score >= self.least[query])
        self.query, self.score = np.append(self.query, query[good]), np.append(self.score, score[good])
        self.id, self.lost = np.append(self.id, ids[here[good]]), np.append(self.lost, lost[here[good]])

    def _cut(self) -> None:
        """Keep each query's best; equal scores by ascending id."""
        order = np.lexsort((self.id, self.lost, -self.score, self.query))
        query = self.query[order]
        starts = np.searchsorted(query, np.arange(self.of.count + 1))
        rank = np.arange(query.size) - starts[query]
        order = order[rank < self.k]
        self.query, self.score, self.id, self.lost = (each[order] for each in (self.query, self.score, self.id, self.lost))
        last = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.least[self.query[last]] = np.maximum(self.least[self.query[last]], self.score[last])


FOUND = "query int, doc_id long, score long"


def _search(impacts: DataFrame, uri: str, k: int, least: str | None) -> DataFrame:
    """Each task's best documents of each query; ``least`` has the scores to reach, if any are known."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _queries(uri)
        of = Search(queries, k, _arrays(least)["least"] if least else np.zeros(queries.count, np.int64))
        for batch in parts:
            for low in range(0, batch.num_rows, BUCKET):
                part = batch.slice(low, BUCKET)
                terms, sizes = _joined(part.column("terms"), "<i4")
                ids = part.column("doc_id")
                of.bucket(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                          part.column("length").to_numpy(zero_copy_only=False), terms, sizes, _joined(part.column("impacts"), "<i8")[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(of.query, pa.int32()), pa.array(of.id, pa.int64(), mask=of.lost), pa.array(of.score, pa.int64())],
            names=["query", "doc_id", "score"])

    return impacts.sortWithinPartitions(F.desc("length")).mapInArrow(released(run), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _lengths_from(impacts: DataFrame, first: int) -> float:
    """A length that about ``first`` of the vectors reach, from a histogram."""
    step = F.floor(F.log2("length") * FINE).cast("int")
    counts = impacts.filter("length > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    # A number for each step of a histogram of logarithms.
    seen = 0
    for row in sorted(counts.collect(), key=lambda row: -row["step"]):
        seen += row["rows"]
        if seen >= first:
            return 2.0 ** (row["step"] / FINE)
    return 0.0


def _searched(docs: DataFrame, listed: list, k: int, first: int) -> DataFrame:
    """The best documents of one block of queries, by place in the block."""
    spark = docs.sparkSession
    uri = _write_queries(spark, listed)
    terms = _queries(uri).vocabulary.keys.size
    vectors = stage(_vectors(docs, uri), "vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    documents = total["documents"]
    if not documents:
        return spark.createDataFrame([], f"{FOUND}, rank int")
    folder = new_dir(spark, "weights")
    df = _frequencies(vectors, terms)
    files.write_arrays(f"{folder}/weights.bin", {
        "documents": np.array([documents], "<i8"), "terms": np.array([total["terms"]], "<i8"),
        "weights": np.array([weight(documents, n) for n in df.tolist()], "<i8")})
    impacts = _impacts(vectors, f"{folder}/weights.bin")
    long = _lengths_from(impacts, first)
    leading = stage(_best(_search(impacts.filter(F.col("length") >= long), uri, k, None), k), "leading")
    # At most k rows a query of the block.
    least = np.zeros(len(listed), "<i8")
    for row in leading.filter(F.col("rank") == k).select("query", "score").collect():
        least[row["query"]] = row["score"]
    files.write_arrays(f"{folder}/least.bin", {"least": least})
    rest = _search(impacts.filter(F.col("length") < long), uri, k, f"{folder}/least.bin")
    return stage(_best(leading.select("query", "doc_id", "score").unionByName(rest), k), "best")


def search(docs: DataFrame, items: DataFrame, k: int = 50, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each of ``items``.

    ``docs``: doc_id, text; ``items``: item_id, text; further columns are not looked at. A null or empty text
    has no terms: such a document is not counted, such an item has no result. Every row of ``docs`` is a document, also with an id or a
    text seen before; one without an id comes after others of its score. Rows of ``items`` of one id and one text are one item. No
    document or no item gives no row. Queries are searched in blocks of about ``BLOCK_TERMS`` terms, equal
    texts once; a block's terms, one number for each, and ``k`` scores a query pass through the driver.
    """
    spark = docs.sparkSession
    known = items.select("item_id", "text")
    queries = stage(_query_terms(known), "query-terms")
    blocks_needed = -(-(queries.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS)
    asked = known.select("item_id", F.sha2("text", 256).alias("text_key")).distinct()
    schema = f"item_id {known.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    found = None
    for block in range(blocks_needed):
        listed = queries.filter(F.pmod(F.xxhash64("text_key"), F.lit(blocks_needed)) == block).sort("text_key").collect()
        if not listed:
            continue
        places = spark.createDataFrame([(row["text_key"], i) for i, row in enumerate(listed)], "text_key string, query int")
        part = _searched(docs, listed, k, first).join(places, "query").join(asked, "text_key").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found
