"""Scores of whole texts under an interpolated modified Kneser-Ney bigram model of the corpus.

A text is its lower-cased words and one end; ``BEGIN`` stands before the first word. Counting is one
shuffle of each task's distinct bigrams, and one of what each bigram shard knows about single words.
The model is two sets of sorted hash arrays in the shared folder, which the scoring tasks map:

* ``bigrams-<i>.bin``: hash of the pair, count (one byte; larger ones in ``large-<i>.bin``);
* ``words-<i>.bin``: hash of the word, its count, its continuation count (distinct words before it)
  and its weight as a context (the mass that its bigrams pass on to the lower order).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket.llm import files, hash_arrays, kneser_ney
from pricebasket.llm.batches import released
from pricebasket.llm.words import Words, pair
from pricebasket.session import new_dir

BEGIN, END = np.uint64(0x6265_6769_6E5F_5F5F), np.uint64(0x656E_645F_5F5F_5F5F)
#: Tokens that a task gathers before it hands on its distinct bigrams.
BLOCK = 3_000_000
SPREAD = 16


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Previous and present token of every position, and where each text's positions begin."""
    found = Words(texts)
    sizes = np.diff(found.bounds) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    now = np.empty(int(starts[-1]), np.uint64)
    ends = np.zeros(now.size, bool)
    ends[starts[1:] - 1] = True
    now[ends] = END
    now[~ends] = found.hashes
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[starts[:-1]] = BEGIN
    return before, now, starts


def home(before: np.ndarray, key: np.ndarray, shards: int) -> np.ndarray:
    """A bigram's shard: near its context's, but a frequent context is spread over ``SPREAD`` shards."""
    spread = min(SPREAD, shards)
    step = shards // spread
    own = (before >> np.uint64(8)).astype(np.uint64) % np.uint64(shards)
    return ((own + (key % np.uint64(spread)) * np.uint64(step)) % np.uint64(shards)).astype(np.int64)


def _distinct(before, now, counts):
    """Distinct pairs by ascending hash, with added counts."""
    key = pair(before, now)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if key.size else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts[order], first) if key.size else counts
    place = order[first]
    return key[first], before[place], now[place], sums


def _blobs(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per shard with the columns' bytes; rows keep their order within a shard."""
    order = np.argsort(shard, kind="stable")
    used, first = np.unique(shard[order], return_index=True)
    edges = [*first.tolist(), order.size]
    spans = list(zip(edges, edges[1:]))
    ordered = {name: column[order] for name, column in columns.items()}
    return pd.DataFrame({"shard": used.astype(np.int64)} | {
        name: [column[a:b].tobytes() for a, b in spans] for name, column in ordered.items()})


def _gathered(batches: Iterator[pd.DataFrame], kinds: dict[str, str]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Each shard's columns, from rows that lie together by shard."""
    shard, parts = None, {}
    for batch in batches:
        for number, *blobs in zip(batch["shard"].tolist(), *(batch[name] for name in kinds)):
            if number != shard:
                if shard is not None:
                    yield shard, {n: np.frombuffer(b"".join(parts[n]), kinds[n]) for n in kinds}
                shard, parts = number, {name: [] for name in kinds}
            for name, blob in zip(kinds, blobs):
                parts[name].append(blob)
    if shard is not None:
        yield shard, {n: np.frombuffer(b"".join(parts[n]), kinds[n]) for n in kinds}


PAIRS = {"before": "<u8", "now": "<u8", "n": "<u4"}
SINGLE = {"word": "<u8", "n": "<u4", "n1": "<u4", "n2": "<u4", "n3": "<u4", "cont": "<u4"}


def _schema(kinds: dict[str, str]) -> str:
    return "shard long, " + ", ".join(f"{name} binary" for name in kinds)


def train(docs: DataFrame, folder: str) -> None:
    """Count all of ``docs`` (text) and write the model below ``folder``.

    Tasks send each distinct bigram once per block of text, so one frequent bigram, context or text
    costs a shard one row per block. Shards are sized by the session's shuffle partitions.
    Counts of counts (a few numbers per shard) are all that reaches the driver.
    """
    spark = docs.sparkSession
    shards = 1 << max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            texts = batch["text"].tolist()
            for at in range(0, len(texts), 256):
                before, now, _ = sequences(texts[at : at + 256])
                held.append((before, now))
                size += now.size
                if size >= BLOCK:
                    yield hand_on(held)
                    held, size = [], 0
        if size:
            yield hand_on(held)

    def hand_on(held) -> pd.DataFrame:
        before, now = (np.concatenate(each) for each in zip(*held))
        key, before, now, n = _distinct(before, now, np.ones(now.size, np.int64))
        by_context = np.argsort(before, kind="stable")  # equal contexts side by side compress better
        key, before, now, n = key[by_context], before[by_context], now[by_context], n[by_context]
        return _blobs(home(before, key, shards), {"before": before, "now": now, "n": n.astype("<u4")})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, of in _gathered(batches, PAIRS):
            key, before, now, n = _distinct(of["before"], of["now"], of["n"].astype(np.int64))
            hash_arrays.save(f"{folder}/bigrams-{shard}.bin", key, {"n": np.minimum(n, 255).astype(np.uint8)})
            large = n >= 255
            hash_arrays.save(f"{folder}/large-{shard}.bin", key[large], {"n": n[large].astype("<i8")})
            stats = _contexts(before, now, n)
            rows = _blobs(word_home(stats["word"]), stats)
            at_first = np.arange(len(rows)) == 0
            yield rows.assign(**{f"k{i}": at_first * c for i, c in enumerate(kneser_ney.count_classes(n), 1)})

    def word_home(words: np.ndarray) -> np.ndarray:
        return hash_arrays.Sharded("", shards).shard_of(words)

    # Every shard gets an empty row, so that it gets its files.
    empty = spark.range(shards).withColumnRenamed("id", "shard")
    def with_empty(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
        return rows.unionByName(empty.withColumns({name: F.lit(bytearray()) for name in kinds}))

    pairs = with_empty(docs.select("text").mapInPandas(released(count), _schema(PAIRS)), PAIRS)
    by_shard = pairs.repartition(shards, "shard").sortWithinPartitions("shard")
    singles_at = f"{folder}/singles"
    by_shard.mapInPandas(released(merge), _schema(SINGLE) + ", k1 long, k2 long, k3 long, k4 long").write.parquet(singles_at)
    singles = spark.read.parquet(singles_at)
    classes = singles.agg(*(F.sum(f"k{i}") for i in (1, 2, 3, 4))).first()
    upper = kneser_ney.discounts([int(n or 0) for n in classes])

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard, of in _gathered(batches, SINGLE):
            word, place = np.unique(of["word"], return_inverse=True)
            sums = {name: np.bincount(place, of[name], word.size).astype(np.int64) for name in SINGLE if name != "word"}
            passed = upper[0] * sums["n1"] + upper[1] * sums["n2"] + upper[2] * sums["n3"]
            total = np.where((word == END), 1, sums["n"])
            hash_arrays.save(f"{folder}/words-{shard}.bin", word, {
                "n": sums["n"].astype("<i8"), "cont": sums["cont"].astype("<i8"),
                "rest": (passed / np.maximum(total, 1)).astype("<f4"),
            })
            real = (word != BEGIN) & (sums["n"] > 0)
            followers = sums["cont"][sums["cont"] > 0]
            yield pd.DataFrame([[int(sums["n"][real].sum()), int(real.sum()), int(followers.sum()), followers.size,
                                 *kneser_ney.count_classes(followers)]], columns=list("abcdefgh"))

    sums = (
        with_empty(singles.select("shard", *SINGLE), SINGLE).repartition(shards, "shard").sortWithinPartitions("shard")
        .mapInPandas(released(words), "a long, b long, c long, d long, e long, f long, g long, h long")
        .agg(*(F.sum(name) for name in "abcdefgh")).first()
    )
    tokens, types, continuations, followed, *once = (int(n or 0) for n in sums)
    lower = kneser_ney.discounts(once)
    taken = lower[0] * once[0] + lower[1] * once[1] + lower[2] * (followed - once[0] - once[1])
    with files.writer(f"{folder}/model.json") as out:
        out.write(json.dumps({
            "shards": shards, "tokens": tokens, "types": types, "continuations": continuations, "followed": followed,
            "upper": upper, "lower": lower, "spare": taken / continuations if continuations else 1.0,
        }).encode())


def _contexts(before: np.ndarray, now: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """What distinct bigrams say about single words: counts by class as context, and continuations.

    The end is no context; its row's count is the number of texts.
    """
    word, place = np.unique(np.concatenate([before, now]), return_inverse=True)
    as_context, as_last = place[: before.size], place[before.size :]
    def added(where, values=None):
        return np.bincount(where, values, word.size).astype("<u4")
    total = added(as_context, n) + added(as_last, np.where(now == END, n, 0))
    return {"word": word, "n": total, "n1": added(as_context[n == 1]), "n2": added(as_context[n == 2]),
            "n3": added(as_context[n > 2]), "cont": added(as_last)}


class Model:
    def __init__(self, folder: str):
        self.about = json.loads(files.mapped(f"{folder}/model.json").tobytes())
        shards = self.about["shards"]
        self.words = hash_arrays.Sharded(f"{folder}/words", shards)
        self.folder, self.shards = folder, shards

    def _bigram_counts(self, before: np.ndarray, now: np.ndarray) -> np.ndarray:
        key = pair(before, now)
        shard = home(before, key, self.shards)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        counts = np.zeros(key.size, np.int64)
        for number in np.flatnonzero(np.diff(edges)).tolist():
            rows = order[edges[number] : edges[number + 1]]
            small = hash_arrays.opened(f"{self.folder}/bigrams-{number}.bin")
            at = small.find(key[rows])
            held = at >= 0
            found = np.where(held, small.of["n"][np.maximum(at, 0)] if small.keys.size else 0, 0).astype(np.int64)
            more = found == 255
            if more.any():
                large = hash_arrays.opened(f"{self.folder}/large-{number}.bin")
                found[more] = large.of["n"][large.find(key[rows][more])]
            counts[rows] = found
        return counts

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """Per text: its tokens, those known, the add-0.1 unigram score and the model's log10 probability."""
        about = self.about
        before, now, starts = sequences(texts)
        distinct, place = np.unique(np.concatenate([now, np.array([BEGIN])]), return_inverse=True)
        of = self.words.get(distinct, n=np.int64(0), cont=np.int64(0), rest=np.float64(1))
        place_now = place[:-1]
        place_before = np.empty_like(place_now)
        place_before[1:] = place_now[:-1]
        place_before[starts[:-1]] = place[-1]
        n = of["n"]
        base = np.log10((n + 0.1) / (about["tokens"] + 0.1 * (about["types"] + 1)))
        # Lower order: continuation counts, interpolated with the uniform share of types and the unknown.
        every = max(about["continuations"], 1)
        low = kneser_ney.discounted(of["cont"], about["lower"]) / every + about["spare"] / (about["followed"] + 1)
        count = self._bigram_counts(before, now)
        total = np.maximum(n[place_before], 1)
        kept = kneser_ney.discounted(count, about["upper"]) / total
        rest = np.where(n[place_before] > 0, of["rest"][place_before], 1.0)
        share = np.log10(kept + rest * low[place_now])
        edges = starts[:-1]
        return {
            "n_tokens": np.diff(starts), "n_known": np.add.reduceat((n > 0)[place_now].astype(np.int64), edges),
            "base_score": np.add.reduceat(base[place_now], edges), "score": np.add.reduceat(share, edges),
        }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 10 == 0, F.lit(False))


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and score all of ``docs`` (doc_id, text).

    Result, one row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probabilities of the whole text). A null or empty text is its end alone; a null doc_id is not
    held out; rows with a repeated doc_id are documents of their own; an empty table gives no rows, and
    texts are scored as unknown where nothing is left to learn from. Other columns are ignored.
    """
    folder = new_dir(docs.sparkSession, "lm")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    train(rows.filter(~held_out(F.col("doc_id"))), folder)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(folder)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64").array, "held_out": part["held_out"].array,
                    "train_tokens": model.about["tokens"], **model.score(part["text"].tolist()),
                })[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]]

    return rows.withColumn("held_out", held_out(F.col("doc_id"))).mapInPandas(released(scored), SCORED)
