"""Sentiment by a lexicon table whose opinion words are turned by negations and strengthened by intensifiers.

A lexicon has ``word``, ``kind`` (opinion, negation or intensifier) and ``value``: an opinion's polarity, an intensifier's factor. Only
tokens that the lexicon knows leave the scan; what stands before an opinion word is looked up in windows over places in the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricebasket import constants
from pricebasket.functions import text as texts
from pricebasket.session import broadcast_if_small

LEXICON = "word STRING, kind STRING, value DOUBLE"


def modifiers(spark: SparkSession) -> DataFrame:
    """The fixed negations and intensifiers as a lexicon."""
    rows = [(word, "negation", 0.0) for word in constants.NEGATIONS] + [(word, "intensifier", value) for word, value in constants.INTENSIFIERS.items()]
    return spark.createDataFrame(rows, LEXICON)


def learned_opinions(docs: DataFrame, labels: DataFrame, least: int = 5) -> DataFrame:
    """Opinion words from labelled texts: how much more often a word stands in good ones than in bad ones, from -1 to 1.

    ``docs``: doc_id, text; ``labels``: doc_id, quality (1 good, 0 bad). Each text counts a word once; words of fewer than ``least`` labelled texts
    are left out. Without good or without bad texts there is no opinion. All labelled texts are counted, by map-side combines.
    """
    quality = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    sizes = quality.join(docs.filter(F.col("text").isNotNull()).select("doc_id"), "doc_id").agg(
        F.count_if(F.col("quality") == 1).alias("goods"), F.count_if(F.col("quality") == 0).alias("bads"))
    words = docs.select("doc_id", F.explode(F.array_distinct(texts.search_tokens(F.col("text")))).alias("word"))
    counts = words.join(quality, "doc_id").groupBy("word").agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).filter(F.col("good") + F.col("bad") >= least)
    # The sizes are one row of an aggregate.
    goods, bads = sizes.first()
    good, bad = F.col("good").cast("double") * float(bads), F.col("bad").cast("double") * float(goods)
    return counts.filter(F.lit(bool(goods and bads))).select(
        "word", F.lit("opinion").alias("kind"), F.round((good - bad) / (good + bad), 6).alias("value"))


def lexicon_of(opinions: DataFrame, turned: DataFrame) -> DataFrame:
    """Opinions and modifiers as one lexicon; a word that modifies is no opinion."""
    return opinions.join(turned.select("word"), "word", "left_anti").select(turned.columns).unionByName(turned)


def opinions_in(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, pos, word, score: every opinion word of every text, as it stands there.

    An intensifier just before it multiplies its value; a negation among the ``NEGATION_REACH`` tokens before it
    multiplies it by ``NEGATED``; the score stays within -1 and 1. A text's known words are one window's rows.
    """
    tokens = docs.select(key, F.posexplode(texts.search_tokens(F.col("text"))).alias("pos", "word"))
    known = tokens.join(broadcast_if_small(lexicon), "word")
    line = Window.partitionBy(key).orderBy("pos")
    negated = F.max(F.when(F.col("kind") == "negation", 1)).over(line.rangeBetween(-constants.NEGATION_REACH, -1))
    factor = F.max(F.when(F.col("kind") == "intensifier", F.col("value"))).over(line.rangeBetween(-1, -1))
    turned = F.col("value") * F.coalesce(factor, F.lit(1.0)) * F.when(negated == 1, constants.NEGATED).otherwise(1.0)
    return known.withColumn("score", F.greatest(F.least(turned, F.lit(1.0)), F.lit(-1.0))).filter("kind = 'opinion'").select(key, "pos", "word", "score")


def lexicon_scores(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, opinions, sentiment (the opinion words' mean score; 0 without any, null for a null text). ``key`` is unique; ``lexicon`` is stored."""
    found = opinions_in(docs, lexicon, key).groupBy(key).agg(F.count(F.lit(1)).alias("opinions"), F.round(F.avg("score"), 6).alias("sentiment"))
    return docs.select(key, F.col("text").isNotNull().alias("there")).join(found, key, "left").select(
        key, F.coalesce("opinions", F.lit(0)).alias("opinions"), F.when(F.col("there"), F.coalesce("sentiment", F.lit(0.0))).alias("sentiment"))
