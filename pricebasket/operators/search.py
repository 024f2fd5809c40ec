"""Relevance search: each request text to its best catalogue product.

score(q, p) = popularity(p) * sum over words t of q: idf(t) * tf_norm(t, p)

with popularity = chains_count + 0.1 * stores_count and BM25's idf and tf_norm; a request
that is one indexed word gets that word's score once more for products whose name starts
with it. Scores compare after rounding to 6 decimals; the smaller name wins a tie.

The sum is over per-word contributions ``weight(t, q) * impact(t, p)`` with
``impact = tf_norm * popularity``. The best contribution any product can get from a word
bounds what the word can add, so most products need not be scored:

* round 1 scores, per request, the products holding its strongest word (largest bound);
* a word can be skipped when it and all weaker words together cannot reach the best score
  found. Round 2 scores products that hold one of the remaining words.

The result equals scoring every product with a common word, but a word half the catalogue
shares only costs work for requests that it can decide. A product's impacts travel in its
postings, so a candidate is scored where it is joined, without a further shuffle, and
each request keeps one best candidate per task before the shuffle to the final winner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricebasket import constants
from pricebasket.functions import text
from pricebasket.session import broadcast_if_small, spread, stage

# Scores compare after rounding to this many decimals.
DECIMALS = 6

# Postings up to this number are broadcast; each carries one product's impacts.
INDEX_BROADCAST_ROWS = 200_000

# Marks the posting of a name's first word.
FIRST = "^"


def popularity(chains_count: Column, stores_count: Column) -> Column:
    """A missing count adds nothing."""
    return F.coalesce(chains_count, F.lit(0)) * F.lit(constants.CHAINS_WEIGHT) + F.coalesce(
        stores_count, F.lit(0)
    ) * F.lit(constants.STORES_WEIGHT)


def tf_norm(tf: Column, length: Column, mean_length: float) -> Column:
    k1, b = constants.BM25_K1, constants.BM25_B
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.lit(mean_length)))


def postings(products: DataFrame) -> tuple[DataFrame, int]:
    """Inverted index over product names, and the number of products indexed.

    A row per (term, product): the term's impact, and the product's impacts of all its terms,
    whose number the name's length bounds.
    """
    named = (
        products.select("name", "chains_count", "stores_count", text.search_tokens(F.col("name")).alias("tokens"))
        .filter(F.size("tokens") > 0)
    )
    totals = named.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("tokens")).alias("mean_length")).first()
    mean_length = float(totals["mean_length"] or 1.0)
    rank = popularity(F.col("chains_count"), F.col("stores_count"))
    length = F.size("tokens")

    def impact_of(term: Column) -> Column:
        count = F.size(F.filter("tokens", lambda token: token == term)).cast("double")
        return tf_norm(count, length, mean_length) * rank

    # Optimised plans may build the map before dropping names without a token: no null keys.
    first = F.struct(
        F.concat(F.lit(FIRST), F.coalesce(F.get("tokens", F.lit(0)), F.lit(""))).alias("term"),
        (tf_norm(F.lit(1.0), length, mean_length) * rank).alias("impact"),
    )
    terms = F.transform(
        F.array_distinct("tokens"), lambda term: F.struct(term.alias("term"), impact_of(term).alias("impact"))
    )
    return (
        named.select("name", F.map_from_entries(F.concat(terms, F.array(first))).alias("impacts"))
        .select("name", "impacts", F.explode("impacts").alias("term", "impact")),
        int(totals["n"]),
    )


def term_table(index: DataFrame, n_products: int) -> DataFrame:
    """Per term: idf, and the largest impact it has on any product."""
    n = F.count(F.lit(1))
    return index.groupBy("term").agg(
        F.log(1 + (F.lit(n_products) - n + 0.5) / (n + 0.5)).alias("idf"),
        F.max("impact").alias("max_impact"),
    )


def request_terms(requests: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per request with its known terms, strongest first: term, weight, bound, reach.

    ``bound`` is the most any product can score by the term, ``reach`` the sum of the bounds
    of this and all weaker terms of the request. A request's own length bounds the array.
    """
    tokens = text.search_tokens(F.col("request"))
    counted = F.transform(
        F.array_distinct("tokens"),
        lambda term: F.struct(
            term.alias("term"),
            term.alias("base"),
            F.size(F.filter("tokens", lambda token: token == term)).alias("times"),
        ),
    )
    one_word = (F.size("tokens") == 1) & (F.get("tokens", F.lit(0)) == F.col("request"))
    bonus = F.array(
        F.struct(F.concat(F.lit(FIRST), F.col("request")).alias("term"), F.col("request").alias("base"), F.lit(1).alias("times"))
    )
    # At equal bounds a word counts as stronger than a bonus: the strongest term must be one
    # whose bound some product attains.
    word = F.col("term") == F.col("base")
    rising = Window.partitionBy("request").orderBy("bound", word, "term")
    return (
        requests.withColumn("tokens", tokens)
        .withColumn("t", F.explode(F.when(one_word, F.concat(counted, bonus)).otherwise(counted)))
        .select("request", "t.*")
        # The first-word bonus has the idf of the word itself, and no larger an impact.
        .join(terms.withColumnRenamed("term", "base"), "base")
        .withColumn("weight", F.col("idf") * F.col("times"))
        .withColumn("bound", F.col("weight") * F.col("max_impact"))
        .withColumn("reach", F.sum("bound").over(rising))
        .withColumn("strength", F.row_number().over(rising))
        .groupBy("request")
        .agg(F.sort_array(F.collect_list(F.struct("strength", "term", "weight", "bound", "reach")), asc=False).alias("terms"))
    )


def _best(candidates: DataFrame) -> DataFrame:
    """The best-scored product of each request among its candidates."""
    score = F.aggregate(
        "terms",
        F.lit(0.0),
        lambda total, entry: total + entry["weight"] * F.coalesce(F.element_at("impacts", entry["term"]), F.lit(0.0)),
    )
    return (
        candidates.select("request", "name", score.alias("score"))
        .filter(F.col("score") > 0)
        .withColumn("score", F.round("score", DECIMALS))
        .transform(_winner)
    )


def _winner(scored: DataFrame) -> DataFrame:
    """Per request the highest score, the smaller name on a tie."""
    top = F.min(F.struct((-F.col("score")).alias("rank"), "name")).alias("top")
    return scored.groupBy("request").agg(top).select(
        "request", F.col("top.name").alias("name"), (-F.col("top.rank")).alias("score")
    )


def _within_reach(bound: Column, score: Column) -> Column:
    """Whether a product scoring at most ``bound`` could still match ``score`` once rounded.

    The margins cover the rounding of both and the order in which bounds were summed.
    """
    return bound >= score * (1 - 1e-9) - 2 * 10.0**-DECIMALS


def product_search(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Best product per distinct request text: (request, name, score).

    ``requests`` has a ``request`` column, repeats allowed; ``products`` one row per name with
    ``chains_count`` and ``stores_count``. Requests without a common word have no row.
    """
    index, n_products = postings(products)
    index = stage(index, "search-index")
    distinct = requests.select("request").filter(F.col("request").isNotNull()).distinct()
    asked = stage(request_terms(distinct, term_table(index, n_products)), "search-requests")
    index = broadcast_if_small(index, INDEX_BROADCAST_ROWS)
    # A request meets as many products as share its word.
    asked = spread(asked, "request")

    strongest = F.get("terms", F.lit(0))
    round1 = (
        asked.select("request", "terms", strongest.alias("own"))
        .withColumn("term", F.col("own.term"))
        .join(index, "term")
        # The strongest word's best product alone scores ``bound``; weaker words can lift a
        # product by no more than the rest of ``reach``.
        .filter(
            _within_reach(
                F.col("own.reach") - F.col("own.bound") + F.col("own.weight") * F.col("impact"), F.col("own.bound")
            )
        )
    )
    first = stage(_best(round1), "search-first")

    open_terms = F.filter(
        F.slice("terms", 2, F.greatest(F.size("terms") - 1, F.lit(0))),
        lambda entry: _within_reach(entry["reach"], F.col("reached")),
    )
    round2 = (
        asked.join(first.select("request", F.col("score").alias("reached")), "request")
        .select("request", "terms", "reached", F.explode(open_terms).alias("own"))
        .withColumn("term", F.col("own.term"))
        .join(index, "term")
        # This product scores at most what all terms can reach less what it misses on this one.
        .filter(
            _within_reach(
                F.get("terms", F.lit(0))["reach"] - F.col("own.bound") + F.col("own.weight") * F.col("impact"),
                F.col("reached"),
            )
        )
    )
    return _winner(first.unionByName(_best(round2)))
