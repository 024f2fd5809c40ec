"""Texts within a few edits of each other, by the rarest of their q-grams.

A text padded at both ends has a bag of q-grams, of which one edit changes at most q. So of two texts within d
edits, the q * d + 1 grams of each that come first in any common order share one; rare grams come
first, so a gram that many texts have joins hardly anything. Texts too short for that many
grams meet by what is left of them after deleting up to d characters, which two texts within d edits always share.
Pairs that meet are confirmed with a bounded edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.session import stage

PAD = "\u0001"


def _shortened(value: Column, edits: int) -> Column:
    """What is left of a short text after deleting up to ``edits`` characters."""

    def less_one(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))

    found = F.array(value)
    for _ in range(edits):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, less_one))))
    return found


def _grams(texts: DataFrame, q: int) -> DataFrame:
    """side, text, gram: each text's bag of q-grams, repeated grams told apart by number."""
    padded = F.concat(F.lit(PAD * (q - 1)), F.col("text"), F.lit(PAD * (q - 1)))
    count = F.length("text") + F.lit(q - 1)
    listed = texts.filter(F.length("text") > 0).select("side", "text", F.explode(F.transform(
        F.sequence(F.lit(1), count), lambda i: F.substring(padded, i, F.lit(q)))).alias("piece"))
    repeat = F.row_number().over(Window.partitionBy("side", "text", "piece").orderBy(F.lit(1)))
    return listed.select("side", "text", F.concat_ws(PAD, "piece", repeat).alias("gram"))


def similar_pairs(asked: DataFrame, known: DataFrame, max_edits: int = 2, q: int = 3) -> DataFrame:
    """asked, known, edits: all pairs of distinct texts within ``max_edits`` edits, equal texts included.

    ``asked`` and ``known`` have one column of texts; null is near nothing. No pair is lost: the grams only decide which pairs are compared.
    """
    texts = stage(
        asked.toDF("text").select(F.lit(0).alias("side"), "text").unionByName(known.toDF("text").select(F.lit(1).alias("side"), "text"))
        .filter(F.col("text").isNotNull()).distinct(), "texts")
    grams = stage(_grams(texts, q), "grams")
    uses = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    rarest = F.row_number().over(Window.partitionBy("side", "text").orderBy("uses", "gram"))
    leading = grams.join(uses, "gram").withColumn("place", rarest).filter(F.col("place") <= q * max_edits + 1).select("side", "text", F.col("gram").alias("token"))
    # A text of fewer grams may share none; whatever is near it is at most so much longer.
    longest = max(q * max_edits - q + 1 + max_edits, 0)
    short = texts.filter(F.length("text") <= longest).select(
        "side", "text", F.explode(_shortened(F.col("text"), max_edits)).alias("rest")).select("side", "text", F.concat(F.lit(PAD * (q + 1)), "rest").alias("token"))
    tokens = stage(leading.unionByName(short), "tokens")
    left = tokens.filter("side = 0").select("token", F.col("text").alias("asked"))
    right = tokens.filter("side = 1").select("token", F.col("text").alias("known"))
    near = F.abs(F.length("asked") - F.length("known")) <= max_edits
    pairs = left.join(right, "token").filter(near).select("asked", "known").distinct()
    return pairs.withColumn("edits", F.levenshtein("asked", "known", max_edits)).filter(F.col("edits") >= 0)
