"""Quality rules: counts over words and lines, and language-specific bands of character n-gram perplexity.

The model is an interpolated modified Kneser-Ney trigram model of code points, one per language,
counted by Spark over all documents labelled good. Its n-grams lie in sorted hash arrays
in the shared folder, with their final log10 probabilities and the weights of contexts, and the
tasks that score texts map them. The bands come from the good documents too, each scored by a
model that counted the other half of them, by hash of the text: what is judged does not move them.
In a language of few good documents every text is scored by the model of the half that is not its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebasket.llm import batches, files, hash_arrays
from pricebasket.llm.words import Words, finalize, pair
from pricebasket.session import broadcast_if_small, new_dir, stage

ORDER, BITS = 3, 21
MASK = (1 << BITS) - 1
#: Code points that no text holds, for a text's beginning and end.
BEGIN, END = 0x1FFFFE, 0x1FFFFF
#: In place of a trigram: the number of texts of a language.
TEXTS = -2
#: Ends the name of a language of which one half is counted.
HALF = "\x1f"
#: A band reaches from the lower to the upper of these quantiles of the held-out scores,
SHARES = (0.05, 0.95)
#: and by this, in log10 units of the mean score, beyond both: a quarter of the perplexity up or down.
MARGIN = 0.1


def trigrams(text: str | None) -> np.ndarray:
    """Every code point and the end with the two before it, 21 bits each. Blanks of all kinds are one blank."""
    points = np.frombuffer(" ".join((text or "").split()).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    padded = np.concatenate([[np.uint64(BEGIN)] * 2, points, [np.uint64(END)]])
    return (padded[:-2] << np.uint64(2 * BITS)) | (padded[1:-1] << np.uint64(BITS)) | padded[2:]


def lang_hash(lang: str) -> np.uint64:
    return Words(["x" + lang.replace(" ", "_")]).hashes[0] if lang else np.uint64(1)


def gram_hash(lang: np.uint64, order: int, grams: np.ndarray) -> np.ndarray:
    return pair(finalize(grams * np.uint64(4) + np.uint64(order)), np.full(grams.size, lang))


def _counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct trigrams per language of a task, handed on whenever a million have gathered, and the texts as TEXTS."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    texts: dict[str, int] = {}
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in parts:
        for lang, rows in batch.groupby("lang", sort=False).indices.items():
            texts[lang] = texts.get(lang, 0) + rows.size
            for at in range(0, rows.size, 200):
                found = [trigrams(batch["text"].iat[row]) for row in rows[at : at + 200]]
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                before, counted = held.get(lang, empty)
                every, place = np.unique(np.concatenate([before, grams]), return_inverse=True)
                held[lang] = every, np.bincount(place, np.concatenate([counted, n]), every.size).astype(np.int64)
            if held[lang][0].size > 1_000_000:
                every, n = held.pop(lang)
                yield pd.DataFrame({"lang": lang, "gram": every.astype(np.int64), "n": n})
    for lang, (every, n) in held.items():
        yield pd.DataFrame({"lang": lang, "gram": every.astype(np.int64), "n": n})
    if texts:
        yield pd.DataFrame({"lang": pd.Series(list(texts), dtype=object), "gram": np.full(len(texts), TEXTS), "n": np.array(list(texts.values()), np.int64)})


def _level(grams: DataFrame, order: int, lower: DataFrame) -> DataFrame:
    """Interpolated probabilities of one order: (lang, gram, n) to (lang, gram, p, rest).

    ``rest`` is a context's share for the lower order, given to the n-gram that is the context.
    """
    mask = (1 << BITS * (order - 1)) - 1
    per_lang = ["lang"]
    classes = grams.groupBy(per_lang).agg(
        *(F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)), F.sum("n").alias("all"), F.count(F.lit(1)).alias("types"))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    known = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    d = [F.when(known, F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"), F.lit(0.05)), F.lit(float(k)))).otherwise(0.5 * k)
         for k in (1, 2, 3)]
    # A row per language: broadcast as long as a count shows that they are few, so that no n-gram is dealt by its language.
    discounts = broadcast_if_small(stage(classes.select("lang", *(x.alias(f"d{k}") for k, x in enumerate(d, 1)), "all", "types"), "discounts"))
    less = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    each = grams.join(discounts, "lang").withColumn("less", less).withColumn("context", F.shiftright("gram", BITS)).withColumn(
        "suffix", F.col("gram").bitwiseAND(F.lit(mask)))
    if order == 1:
        # The uniform share goes to the language's types and one unknown.
        mass = broadcast_if_small(stage(each.groupBy("lang").agg((F.sum("less") / F.first("all") / (F.first("types") + 1)).alias("unknown")), "unknown"))
        found = each.join(mass, "lang").select("lang", "gram", ((F.col("n") - F.col("less")) / F.col("all") + F.col("unknown")).alias("p"))
        return found.unionByName(mass.select("lang", F.lit(-1).cast("long").alias("gram"), F.col("unknown").alias("p")))
    contexts = each.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("less") / F.sum("n")).alias("rest"))
    below = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
    return each.join(contexts, ["lang", "context"]).join(below, ["lang", "suffix"]).select(
        "lang", "gram", ((F.col("n") - F.col("less")) / F.col("total") + F.col("rest") * F.col("q")).alias("p"), "context", "rest")


def train(docs: DataFrame, folder: str, least: int = 1) -> None:
    """Count all of ``docs`` (lang, text), but languages of fewer than ``least``, and write the model below ``folder``.

    A lang that ends in ``HALF`` and 0 or 1 is that half of a language: it has a model of its own, and the language one of both.

    A task sends each distinct trigram of a language once, whatever its frequency, and no text; orders 2 and 1 count
    distinct left neighbours of the order above. Only numbers per language are gathered by it.
    """
    spark = docs.sparkSession
    each = stage(
        docs.mapInPandas(batches.released(_counted), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counted")
    language = F.regexp_replace("lang", f"{HALF}[01]$", "")
    whole = stage(each.groupBy(language.alias("lang"), "gram").agg(F.sum("n").alias("n")), "whole")
    counted = whole.unionByName(each.filter(F.col("lang") != language)).withColumn("language", language)
    enough = broadcast_if_small(stage(whole.filter((F.col("gram") == TEXTS) & (F.col("n") >= least)).select(F.col("lang").alias("language")), "languages"))
    counts = {3: counted.filter(F.col("gram") != TEXTS).join(enough, "language", "left_semi").drop("language")}
    for order in (2, 1):
        part = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))
        counts[order] = stage(counts[order + 1].groupBy("lang", part.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
    levels: dict[int, DataFrame] = {}
    for order in (1, 2, 3):
        levels[order] = stage(_level(counts[order], order, levels.get(order - 1)), "levels")
    rests = [levels[k].select("lang", F.col("context").alias("gram"), "rest").distinct() for k in (2, 3)]
    one = levels[1].join(rests[0], ["lang", "gram"], "full").select("lang", "gram", F.lit(1).alias("size"), "p", "rest")
    two = levels[2].drop("rest", "context").join(rests[1], ["lang", "gram"], "full").select("lang", "gram", F.lit(2).alias("size"), "p", "rest")
    three = levels[3].select("lang", "gram", F.lit(3).alias("size"), "p", F.lit(1.0).alias("rest"))
    entries = stage(one.unionByName(two).unionByName(three), "entries")
    shards = 1 << max(0, -(-entries.count() // 500_000) - 1).bit_length()

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = hash_arrays.Sharded("", shards)
        for batch in parts:
            keys = np.zeros(len(batch), np.uint64)
            grams, sizes = batch["gram"].to_numpy().view(np.uint64), batch["size"].to_numpy()
            for lang, rows in batch.groupby("lang", sort=False).indices.items():
                for size in (1, 2, 3):
                    at = rows[sizes[rows] == size]
                    keys[at] = gram_hash(lang_hash(lang), size, grams[at])
            yield pd.DataFrame({"shard": of.shard_of(keys), "key": keys.view(np.int64), "p": batch["p"], "rest": batch["rest"]})

    def save(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, parts = None, []
        for batch in rows:
            for number, part in batch.groupby("shard", sort=False):
                if parts and number != shard:
                    yield write(shard, parts)
                    parts = []
                shard = number
                parts.append(part)
        if parts:
            yield write(shard, parts)

    def write(shard: int, parts: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(parts)
        keys = part["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        with np.errstate(divide="ignore"):
            hash_arrays.save(f"{folder}/grams-{shard}.bin", keys[order], {
                # A context that is no n-gram of its own has no probability: NaN.
                "p": np.log10(part["p"].to_numpy(np.float64))[order].astype("<f4"),
                "rest": np.log10(np.nan_to_num(part["rest"].to_numpy(np.float64), nan=1.0))[order].astype("<f4"),
            })
        return pd.DataFrame({"n": [len(part)]})

    written = entries.mapInPandas(hashed, "shard long, key long, p double, rest double").repartition(shards, "shard").sortWithinPartitions(
        "shard").mapInPandas(save, "n long").agg(F.sum("n"), F.count("n")).first()
    if shards > 1 and written[1] < shards:
        raise RuntimeError("a shard of the model got no n-gram")
    with files.writer(f"{folder}/model.json") as out:
        out.write(json.dumps({"shards": shards if written[0] else 0}).encode())


class Model:
    def __init__(self, folder: str):
        about = json.loads(files.mapped(f"{folder}/model.json").tobytes())
        self.arrays = hash_arrays.Sharded(f"{folder}/grams", about["shards"]) if about["shards"] else None

    def _find(self, lang: np.uint64, size: int, grams: np.ndarray, **defaults) -> dict[str, np.ndarray]:
        """Values of any grams, each distinct one looked up once."""
        keys, place = np.unique(gram_hash(lang, size, grams), return_inverse=True)
        return {name: column[place] for name, column in self.arrays.get(keys, **defaults).items()}

    def log10(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """log10 probabilities of distinct trigrams; NaN for a language without a model.

        A new trigram has its context's weight times the shorter n-gram's probability, and so on.
        """
        if self.arrays is None:
            return np.full(grams.size, np.nan)
        own = lang_hash(lang)
        found = self._find(own, 3, grams, p=np.nan)["p"]
        weight = np.zeros(grams.size)
        for size in (2, 1):
            new = np.flatnonzero(np.isnan(found))
            if new.size:
                mask = np.uint64((1 << BITS * size) - 1)
                weight[new] += self._find(own, size, (grams[new] >> np.uint64(BITS)) & mask, rest=0.0)["rest"]
                found[new] = self._find(own, size, grams[new] & mask, p=np.nan)["p"] + weight[new]
        new = np.isnan(found)
        if new.any():
            unknown = np.array([-1], np.int64).view(np.uint64)
            found[new] = self._find(own, 1, unknown, p=np.nan)["p"][0] + weight[new]
        return found

    def means(self, lang: str, texts: list[str | None]) -> np.ndarray:
        """The mean log10 probability of a code point of each text."""
        parts = [trigrams(text) for text in texts]
        starts = np.concatenate([[0], np.cumsum([each.size for each in parts])[:-1]])
        grams, place = np.unique(np.concatenate(parts), return_inverse=True)
        return np.add.reduceat(self.log10(lang, grams)[place], starts) / [each.size for each in parts]


BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def counts(texts: list[str | None]) -> pd.DataFrame:
    """The base counts of each text."""
    texts = [text or "" for text in texts]
    of = Words(texts, lower=False)
    n = np.diff(of.bounds)
    doc = np.repeat(np.arange(len(texts)), n)
    repeated = np.zeros(doc.size, bool)
    if doc.size > 2:
        whole = np.flatnonzero(doc[2:] == doc[:-2])
        h = of.hashes
        window = pair(pair(pair(h[whole], h[whole + 1]), h[whole + 2]), doc[whole].astype(np.uint64))
        _, place, times = np.unique(window, return_inverse=True, return_counts=True)
        again = whole[times[place] > 1]
        for step in range(3):
            repeated[again + step] = True
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip(BLANKS)]
        dup_lines.append(len(lines) - len(set(lines)))
    return pd.DataFrame({
        "n_words": n, "word_chars": [len(text) - sum(map(text.count, BLANKS)) for text in texts],
        "n_symbols": [sum(map(text.count, SYMBOLS)) for text in texts], "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(doc[repeated], minlength=len(texts)),
    })


def good_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of all documents that ``labels`` (doc_id, quality) calls good, whatever their number in a language.

    Good ids lie in sorted hash arrays that the scanning tasks look theirs up in, so at no size does a text move.
    """
    good = hash_arrays.save_ids(labels.filter("quality = 1").select("doc_id"), f"{new_dir(docs.sparkSession, 'good')}/ids")

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column("doc_id")
            there = good.has(ids.fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(there))

    known = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return known.mapInArrow(batches.released(keep), known.schema)


def judge(docs: DataFrame, reference: DataFrame, shares: tuple[float, float] = SHARES, margin: float = MARGIN, least: int = 30) -> DataFrame:
    """Count, score and judge every whole text of ``docs`` (doc_id, text, lang).

    ``reference`` (text, lang) are documents of good quality; the model of each language is counted over all of
    them. Its band reaches from one of the quantiles ``shares`` of their scores to the other, and ``margin`` beyond both; for that
    each is scored by a model of the other half, and only distinct texts that the base rules keep are taken. Perplexity is 10 ** -score: texts above
    the upper bound of perplexity are symbols, junk or another language, those below the lower one a few words over and over.

    Result, one row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score (mean log10 probability of a code point), low, high.

    A null text has no words; a null lang is a language of its own. Where the reference has fewer than
    ``least`` documents of a language, the model of all of them fits them far better than other texts, so every text is
    scored by the model of one half of them: the half that would not hold it. Without two distinct
    texts of a language there is nothing to compare, score and band are null and the base rules alone decide; they do, too, where it has none
    that they keep. Rows
    with a null or repeated doc_id are judged each on its own. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return with_verdict(rows, reference, shares, margin, least, drop=("text",)).select(
        "doc_id", *(part.split()[0] for part in COUNTS.split(", ")), "base_failed", "kept", "score", "low", "high")


def with_verdict(
    docs: DataFrame, reference: DataFrame, shares: tuple[float, float] = SHARES, margin: float = MARGIN, least: int = 30, drop: tuple[str, ...] = ()
) -> DataFrame:
    """`judge`, with all columns of ``docs`` but ``drop`` in front of the verdict's."""
    folder = new_dir(docs.sparkSession, "quality")
    language, hashed = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.xxhash64(F.col("text").cast("string"))
    named = reference.select(language.alias("language"), F.col("text").cast("string").alias("text")).withColumn("hash", hashed)
    # A row per language, as the bands: of few documents, halves meet midway between the least and the greatest hash, so that none is empty.
    least_hash, most = F.min("hash"), F.max("hash")
    known = broadcast_if_small(stage(named.groupBy(F.col("language").alias("_language")).agg(
        (F.count(F.lit(1)) < least).alias("_few"), (least_hash < most).alias("_two"),
        (F.shiftright(least_hash, 1) + F.shiftright(most, 1)).alias("_middle")), "known"), 10_000)

    def half(text_hash: Column) -> Column:
        return F.when(F.col("_few"), (text_hash > F.col("_middle")).cast("int")).otherwise(F.pmod(text_hash, F.lit(2)).cast("int"))

    halves = named.join(known, F.col("language") == F.col("_language")).filter("_two or not _few").select(
        "language", "text", "hash", half(F.col("hash")).alias("half"))
    train(halves.select(F.concat("language", F.lit(HALF), "half").alias("lang"), "text"), folder)

    def measure(texts: list[str | None], models: list[str | None]) -> dict:
        model, score = Model(folder), np.full(len(texts), np.nan)
        of = np.array(models, object)
        for name in dict.fromkeys(models):
            rows = np.flatnonzero(of == name)
            if name is not None:
                score[rows] = model.means(name, [texts[row] for row in rows.tolist()])
        return {**counts(texts), "score": score}

    def measured(rows: DataFrame, without: tuple[str, ...]) -> DataFrame:
        return batches.with_columns(rows, ["text", "_model"], measure, f"{COUNTS}, score double", (*without, "_model")).withColumn(
            "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))

    # One score a text: copies are combined before the shuffle and do not draw the quantiles together.
    crossed = halves.withColumn("_model", F.concat("language", F.lit(HALF), 1 - F.col("half"))).drop("half")
    texts = measured(crossed, ("text",)).filter("not base_failed and score is not null").groupBy("language", "hash").agg(F.first("score").alias("score"))
    ends = F.percentile_approx("score", list(shares), 10_000)
    # A row per language: broadcast as long as a count shows that they are few.
    bands = broadcast_if_small(stage(
        texts.groupBy(F.col("language").alias("_lang")).agg(ends.alias("q"))
        .select("_lang", (F.col("q")[0] - margin).alias("low"), (F.col("q")[1] + margin).alias("high")), "bands"), 10_000)
    inside = F.coalesce(F.col("score").between(F.col("low"), F.col("high")), F.lit(True))
    scored_by = F.when(~F.col("_few"), F.col("_language")).when(F.col("_two"), F.concat("_language", F.lit(HALF), 1 - half(hashed)))
    rows = docs.join(known, language == F.col("_language"), "left").withColumn("_model", scored_by).drop(*known.columns)
    return measured(rows, drop).join(bands, language == F.col("_lang"), "left").drop("_lang").withColumn(
        "kept", ~F.col("base_failed") & inside)
