"""Language identification by nearest centroids of TF-IDF vectors of character n-grams.

Texts become vectors of hashed 2- and 3-grams of their lower-cased letters, with one blank for all else
between words: 1 + log(count), times the n-gram's rarity, at unit length. Each language has several
centroids, from spherical k-means over a bounded sample. A text goes to the language of the nearest one;
if it is farther than almost all texts that this centroid came from, it is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.llm import batches
from pricebasket.llm.words import finalize
from pricebasket.session import stage

DIMENSIONS = 1 << 13
#: Sampled texts of a language, languages, and centroids of a language, at most.
SAMPLE, LANGUAGES, CENTROIDS = 600, 500, 3
#: Parts of a language among which its hashes are compared first.
PARTS = 16
#: A centroid takes texts up to the distance of this share of its own sample, and a margin.
REACH, MARGIN = 0.995, 0.1
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text where anything but letters is one blank, blanks at both ends."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    kept = np.where(_letters[0][points], points, 32)
    kept = np.concatenate([[32], kept, [32]])
    return kept[np.concatenate([[True], (kept[1:] != 32) | (kept[:-1] != 32)])].astype(np.uint64)


def counts(text: str | None) -> np.ndarray | None:
    """How often the text's n-grams fall into each dimension, or None without a letter."""
    points = letters(text or "")
    if points.size < 3:
        return None
    two = (points[:-1] << np.uint64(21)) | points[1:]
    three = (two[:-1] << np.uint64(21)) | points[2:]
    grams = finalize(np.concatenate([two, three | np.uint64(1 << 63)])) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)
    return np.bincount(grams.astype(np.int64), minlength=DIMENSIONS)


def unit(n: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    vector = np.where(n > 0, 1 + np.log(np.maximum(n, 1)), 0) * rarity
    length = np.sqrt((vector * vector).sum())
    return (vector / length if length else vector).astype(np.float32)


def clusters(vectors: np.ndarray, most: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart beginnings: unit centroids, and each vector's one."""
    chosen = [0]
    while len(chosen) < min(most, len(vectors)):
        near = (vectors @ vectors[chosen].T).max(axis=1)
        far = int(np.argmin(near))
        if near[far] > 0.999:
            break
        chosen.append(far)
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[own == k].sum(axis=0) if (own == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centroids.astype(np.float32), np.argmax(vectors @ centroids.T, axis=1)


class Model:
    def __init__(self, rarity: np.ndarray, rows: list[tuple[str, np.ndarray, float]]):
        rows = sorted(rows, key=lambda row: (row[0], row[2]))
        self.rarity = rarity
        self.langs = [lang for lang, *_ in rows]
        self.centroids = np.stack([c for _, c, _ in rows]) if rows else np.zeros((0, DIMENSIONS), np.float32)
        self.least = np.array([least for *_, least in rows])

    def predict(self, texts: list[str | None]) -> dict:
        langs, scores, rejected = [], [], []
        for text in texts:
            n = counts(text) if self.langs else None
            if n is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                rejected.append(True)
                continue
            near = self.centroids @ unit(n, self.rarity)
            best = int(np.argmax(near))  # of equals the first language by name
            langs.append(self.langs[best])
            scores.append(float(min(max(near[best], 0.0), 1.0)))
            rejected.append(bool(near[best] < self.least[best]))
        return {"lang_pred": langs, "score": scores, "rejected": rejected}


def least_hashes(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` least distinct ``h`` of each lang of ``rows`` (lang, h: long), in two steps.

    A task hands on no more than its own ``most`` of a lang, whatever the number of its rows and copies; their
    lang's least are among them. The second step deals them by hash value, and again only a part's least meet.
    """

    def least(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in parts:
            for lang, found in batch.groupby("lang", sort=False)["h"]:
                held[lang] = np.unique(np.concatenate([held.get(lang, found.to_numpy()[:0]), found.to_numpy()]))[:most]
        for lang, found in held.items():
            yield pd.DataFrame({"lang": lang, "h": found})

    own = rows.mapInPandas(batches.released(least), "lang string, h long").distinct()
    for group in (["lang", F.pmod("h", F.lit(PARTS))], ["lang"]):
        own = own.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy("h"))).filter(F.col("at") <= most).drop("at")
    return own


def train(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES, centroids: int = CENTROIDS) -> Model:
    """Learn from ``docs`` (text, lang).

    The rarity of n-grams is counted over all of them; centroids come from at most ``sample`` distinct texts
    (those of least hash; copies count once) of each of the ``languages`` most frequent languages. So what the driver and one task
    see is bounded: ``languages * centroids`` vectors, and a language's sample.
    """
    named = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "text is not null and lang is not null")

    def seen(some: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, texts = np.zeros(DIMENSIONS, np.int64), 0
        for batch in some:
            for text in batch["text"].tolist():
                n = counts(text)
                if n is not None:
                    total += n > 0
                    texts += 1
        yield pd.DataFrame({"at": np.arange(-1, DIMENSIONS), "n": np.concatenate([[texts], total])})

    sums = {r["at"]: r["n"] for r in named.mapInPandas(seen, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    held = np.array([sums.get(k, 0) for k in range(DIMENSIONS)])
    rarity = np.log((1 + sums.get(-1, 0)) / (1 + held)) + 1

    # The hashes of the sample first: at most sample * languages rows.
    frequent = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(languages).select("lang")
    hashes = named.select("lang", F.xxhash64("text").alias("h")).join(F.broadcast(frequent), "lang")
    chosen = stage(least_hashes(hashes, sample), "sample")
    texts = named.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        vectors = [unit(n, rarity) for n in map(counts, part.sort_values("h")["text"]) if n is not None]
        if not vectors:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []}).astype({"lang": str, "centroid": object, "least": float})
        vectors = np.stack(vectors)
        found, own = clusters(vectors, centroids)
        near = (vectors * found[own]).sum(axis=1)
        least = [float(np.quantile(near[own == k], 1 - REACH)) - MARGIN if (own == k).any() else -1.0 for k in range(len(found))]
        return pd.DataFrame({"lang": part["lang"].iat[0], "centroid": list(found), "least": least})

    rows = texts.select("lang", "h", "text").groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, least double").collect()
    return Model(rarity, [(r["lang"], np.array(r["centroid"], np.float32), r["least"]) for r in rows])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, **bounds) -> DataFrame:
    """Learn from the documents with a language that are not held out; predict for all ``docs`` (doc_id, text, lang).

    Result, one row per input row: doc_id, held_out, lang_pred (`und` for a text that is null or has no letter, or
    if nothing could be learned), score (cosine to the nearest centroid, 0 to 1), rejected (farther than
    that centroid's own texts are). Predictions see only the text. A null doc_id is not held out; rows
    with a repeated doc_id are documents of their own; of equally near languages the first by name is
    taken; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(rows.filter("not held_out"), **bounds)
    return batches.with_columns(
        rows.drop("lang"), ["text"], model.predict, "lang_pred string, score double, rejected boolean", ("text",))
