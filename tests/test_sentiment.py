"""Lexicon scores with modifiers on written-out cases; learned opinions; stream and batch alike."""

import json

from pricebasket.operators import sentiment
from pricebasket.session import stage
from pricebasket.streaming import jobs

DOCS = "doc_id LONG, text STRING"


def lexicon(spark):
    rows = [("good", "opinion", 0.6), ("bad", "opinion", -0.8), ("not", "negation", 0.0), ("very", "intensifier", 1.5), ("twice", "intensifier", 2.0)]
    return stage(spark.createDataFrame(rows, sentiment.LEXICON), "lexicon")


CASES = {
    "good": (1, 0.6), "Good, bad!": (2, -0.1), "not good": (1, -0.3), "not at all good": (1, -0.3), "not one of all good": (1, 0.6),
    "very good": (1, 0.9), "very very good": (1, 0.9), "not very bad": (1, 0.6), "very, so good": (1, 0.6), "twice bad": (1, -1.0),
    "good not": (1, 0.6), "": (0, 0.0), "plain": (0, 0.0), "not good bad": (2, 0.05),
}


def test_written_out_cases(spark):
    docs = spark.createDataFrame([*enumerate(CASES), (99, None)], DOCS)
    got = {r["doc_id"]: (r["opinions"], r["sentiment"]) for r in sentiment.lexicon_scores(docs, lexicon(spark)).collect()}
    assert got == {**dict(enumerate(CASES.values())), 99: (0, None)}
    assert sentiment.lexicon_scores(docs.limit(0), lexicon(spark)).collect() == []


def test_learned_opinions(spark):
    docs = spark.createDataFrame([(i, "fine fine day" if i < 6 else "poor day") for i in range(9)] + [(20, "fine unlabelled"), (21, None)], DOCS)
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(9)] + [(21, 1), (22, None)], "doc_id LONG, quality INT")
    got = {r["word"]: r["value"] for r in sentiment.learned_opinions(docs, labels, least=3).collect()}
    assert got == {"fine": 1.0, "poor": -1.0, "day": 0.0}
    assert sentiment.learned_opinions(docs, labels.filter("quality = 1"), least=1).collect() == []
    both = sentiment.lexicon_of(sentiment.learned_opinions(docs, labels, least=3), spark.createDataFrame([("fine", "intensifier", 2.0)], sentiment.LEXICON))
    assert {(r["word"], r["kind"]) for r in both.collect()} == {("fine", "intensifier"), ("poor", "opinion"), ("day", "opinion")}


def test_the_stream_equals_the_batch(spark, tmp_path):
    inbox, words = tmp_path / "in", lexicon(spark)
    inbox.mkdir()
    for i, text in enumerate(CASES):
        (inbox / f"{i % 4}.json").open("a").write(json.dumps({"doc_id": i, "text": text}) + "\n")
    source = spark.readStream.schema(DOCS).option("maxFilesPerTrigger", 1).json(str(inbox))
    jobs.append_batches(source, lambda batch: sentiment.lexicon_scores(batch, words), str(tmp_path / "t"), str(tmp_path / "log")).awaitTermination()
    got = {r["doc_id"]: (r["opinions"], r["sentiment"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == dict(enumerate(CASES.values()))
