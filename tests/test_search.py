"""Pruned search against scoring every product."""

import math
import random
import re

import pytest
from pricebasket.operators import search


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def brute_force(products, requests):
    indexed = [(name, c, s, tokens(name)) for name, c, s in products if name and tokens(name)]
    n = len(indexed)
    mean = sum(len(t) for *_, t in indexed) / n
    df = {}
    for *_, t in indexed:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    idf = {term: math.log(1 + (n - d + 0.5) / (d + 0.5)) for term, d in df.items()}

    def norm(tf, length):
        return tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))

    found = {}
    for request in set(requests):
        asked = tokens(request)
        best = None
        for name, c, s, t in indexed:
            score = sum(idf[term] * norm(t.count(term), len(t)) for term in asked if term in t)
            if asked == [request] and t[0] == request:
                score += idf[request] * norm(1, len(t))
            score = round(score * (c + 0.1 * s), 6)
            if score > 0 and (best is None or (-score, name) < best):
                best = (-score, name)
        if best:
            found[request] = (best[1], -best[0])
    return found


def run(spark, products, requests):
    catalog = spark.createDataFrame(products, "name STRING, chains_count INT, stores_count INT")
    asked = spark.createDataFrame([(r,) for r in requests], "request STRING")
    return {r["request"]: (r["name"], r["score"]) for r in search.product_search(asked, catalog).collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for request, (name, score) in want.items():
        assert got[request][0] == name, request
        assert got[request][1] == pytest.approx(score, abs=2e-6)


@pytest.mark.parametrize("seed", range(6))
def test_random_catalogues(spark, seed):
    rng = random.Random(seed)
    # A few words are in most names, as in a real catalogue.
    words = [f"w{i}" for i in range(12)]
    weights = [1 / (i + 1) for i in range(12)]
    names = {" ".join(rng.choices(words, weights, k=rng.randint(1, 5))) for _ in range(120)}
    products = [(name, rng.randint(1, 3), rng.randint(1, 45)) for name in sorted(names)]
    requests = [" ".join(rng.choices(words + ["zz"], weights + [0.2], k=rng.randint(1, 4))) for _ in range(80)] + words
    same(run(spark, products, requests), brute_force(products, requests))


def test_one_product_for_all(spark):
    products = [("milk", 1, 1)]
    same(run(spark, products, ["milk", "MILK", "milk milk", "tea"]), brute_force(products, ["milk", "MILK", "milk milk", "tea"]))


def test_first_word_bonus_needs_the_raw_token(spark):
    products = [("corn can", 1, 10), ("can corn", 1, 10), ("sweet corn", 1, 10)]
    got = run(spark, products, ["corn", "Corn", "corn can"])
    # "corn" as typed lifts names that start with it; "Corn" is not an indexed form.
    assert got["corn"][0] == "corn can"
    assert got["Corn"][0] == "can corn"
    same(got, brute_force(products, ["corn", "Corn", "corn can"]))


def test_popularity_can_outweigh_a_better_text_match(spark):
    products = [("rye bread", 1, 1), ("white bread sliced", 3, 40), ("oat bread", 2, 3)]
    requests = ["rye bread", "bread", "white rye"]
    same(run(spark, products, requests), brute_force(products, requests))


def test_equal_scores_go_to_the_smaller_name(spark):
    products = [("b tea", 1, 1), ("a tea", 1, 1), ("c tea", 1, 1)]
    assert run(spark, products, ["tea"])["tea"][0] == "a tea"


def test_other_scripts_and_empty_requests(spark):
    products = [("חלב תנובה", 2, 5), ("לחם אחיד", 3, 9), (None, 3, 9), ("--", 1, 1)]
    got = run(spark, products, ["חלב", "", "??", None])
    assert set(got) == {"חלב"}
    assert got["חלב"][0] == "חלב תנובה"


def test_a_missing_count_adds_nothing(spark):
    products = [("tea a", None, 10), ("tea b", 1, None), ("tea c", None, None)]
    assert run(spark, products, ["tea"])["tea"][0] == "tea a"
