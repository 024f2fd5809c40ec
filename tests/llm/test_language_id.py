"""Language identification: held-out accuracy, unknown and foreign texts, ties and bounds."""

import zlib

import numpy as np
import pytest
from pricebasket.llm import language_id as lid
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def found(docs):
    return {r["doc_id"]: r for r in lid.identify(docs).collect()}


def test_held_out_accuracy(found, docs):
    rows = docs.collect()
    assert set(found) == {r["doc_id"] for r in rows}
    right, every = 0, 0
    for r in rows:
        got = found[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= got["score"] <= 1
        if got["held_out"] and len(r["text"].split()) >= 10:
            every += 1
            right += got["lang_pred"] == r["lang"]
    assert every > 30 and right >= 0.97 * every


def test_only_texts_decide(found, docs):
    """Held-out rows get the same answer whatever their other columns say."""
    changed = docs.withColumn("lang", F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, "xx").otherwise(F.col("lang")))
    again = {r["doc_id"]: r["lang_pred"] for r in lid.identify(changed.withColumn("source", F.lit("z"))).collect()}
    assert again == {key: r["lang_pred"] for key, r in found.items()}


def test_odd_rows(spark, odd, docs):
    rows = lid.identify(odd).collect()
    assert len(rows) == odd.count()
    text = {r["text"]: r for r in odd.collect()}
    und = sum(1 for r in rows if r["lang_pred"] == "und")
    assert und == sum(1 for r in odd.collect() if not any(c.isalpha() for c in r["text"] or "")) and text
    assert lid.identify(docs.limit(0)).collect() == []
    nothing = lid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_foreign_texts_are_rejected(spark, docs):
    foreign = spark.createDataFrame([(3 * 10**6 + i, "κάθε λέξη είναι ξένη εδώ " * 5, None) for i in range(5)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(foreign)
    got = lid.identify(both).collect()
    strange = [r["rejected"] for r in got if r["doc_id"] >= 3 * 10**6]
    known = [r["rejected"] for r in got if r["doc_id"] < 3 * 10**6]
    assert all(strange) and np.mean(known) < 0.15


def test_clusters_of_unlike_vectors():
    vectors = np.repeat(np.eye(4, dtype=np.float32), 5, axis=0)
    centroids, own = lid.clusters(vectors, 3)
    assert len(centroids) == 3 and len(set(own[:5])) == 1
    centroids, own = lid.clusters(vectors[:5], 3)
    assert len(centroids) == 1


def test_scores_are_cosines_of_plain_vectors(docs):
    """Scores and languages from dictionaries of n-grams, with the model's own centroids and plain counts of texts."""
    rows = docs.select("text", "lang").limit(120).collect()
    some = docs.sparkSession.createDataFrame(rows, "text string, lang string")
    model = lid.train(some)

    def grams(text):
        flat = "".join(c if c.isalpha() else " " for c in text.lower())
        flat = f" {' '.join(flat.split())} "
        n = {}
        for size in (2, 3):
            for at in range(len(flat) - size + 1):
                code = 0
                for c in flat[at : at + size]:
                    code = code << 21 | ord(c)
                hashed = lid.finalize(np.array([code | (1 << 63 if size == 3 else 0)], np.uint64))[0]
                place = int(hashed) * lid.DIMENSIONS >> 64
                n[place] = n.get(place, 0) + 1
        return n

    texts = [r["text"] for r in rows if r["text"] and any(c.isalpha() for c in r["text"]) and len(r["text"]) < 3000]
    held = {}
    every = [r["text"] for r in rows if r["lang"] is not None and r["text"] and any(c.isalpha() for c in r["text"])]
    for text in every:
        for place in grams(text):
            held[place] = held.get(place, 0) + 1
    rarity = [np.log((1 + len(every)) / (1 + held.get(k, 0))) + 1 for k in range(lid.DIMENSIONS)]
    got = model.predict(texts[:40])
    for text, lang, score in zip(texts, got["lang_pred"], got["score"]):
        vector = {k: (1 + np.log(n)) * rarity[k] for k, n in grams(text).items()}
        length = sum(x * x for x in vector.values()) ** 0.5
        near = [sum(x * float(centroid[k]) for k, x in vector.items()) / length for centroid in model.centroids]
        assert score == pytest.approx(max(near), abs=1e-4) and near[model.langs.index(lang)] <= max(near)
        assert max(x for x, own in zip(near, model.langs) if own == lang) == pytest.approx(max(near), abs=1e-5)


def test_copies_do_not_use_up_the_sample(spark):
    """One text a thousand times is one of a language's hashes; each language has its own least ones."""
    rows = [("en", -99)] * 1000 + [("en", k * 7 % 101) for k in range(101)] + [("de", 3), ("de", 3), ("de", -5)]
    hashes = spark.createDataFrame(rows, "lang string, h long").repartition(5)
    got = lid.least_hashes(hashes, 4).collect()
    assert sorted(map(tuple, got)) == [("de", -5), ("de", 3), ("en", -99), ("en", 0), ("en", 1), ("en", 2)]
    assert lid.least_hashes(hashes.limit(0), 4).collect() == []


def test_letters():
    assert "".join(map(chr, lid.letters("A1b--c Ç"))) == " a b c ç "
    assert lid.counts("1 2 ?") is None and lid.counts(None) is None
